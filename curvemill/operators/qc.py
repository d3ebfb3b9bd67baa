"""Quality control of curves and maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.functions import arrays as A
from curvemill.functions.percentiles import median
from curvemill.operators.aggregate import same_keys
from curvemill.sources.curves import subjects


def cnr(curves: DataFrame, *, values: str = "values", baseline: int = 5) -> DataFrame:
    """Contrast to noise: (max - baseline mean) over the baseline's population sd; 0 where that is not finite."""
    base = A.span(F.col(values), 0, baseline)
    ratio = A.let(base, lambda b: (F.array_max(values) - A.mean(b)) / F.when(A.std_pop(b) != 0, A.std_pop(b)))
    return curves.withColumn("cnr", F.coalesce(A.finite(ratio), F.lit(0.0)))


def cnr_summary(with_cnr: DataFrame, *, by: list[str], threshold: float = 2.0) -> DataFrame:
    v = A.finite(F.col("cnr"))
    low = F.avg((v < threshold).cast("double"))
    shares = with_cnr.groupBy(*by).agg(low.alias("low_share"), F.count(v).alias("n"), F.when(F.count(v) == 0, "warn").when(low > 0.5, "warn").otherwise("pass").alias("status"))
    return same_keys(shares, median(with_cnr, by=by, column="cnr"), by).select(*by, "median", "low_share", "n", "status")


def range_check(maps: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each map's median against its range; a map without finite values warns, one without a range passes."""
    by = [*subjects(maps), "map"]
    joined = median(maps, by=by).join(ranges, "map", "left")
    outside = (F.col("median") < F.col("lo")) | (F.col("median") > F.col("hi"))
    return joined.select(*by, "median", F.when(F.col("median").isNull(), "warn").when(F.coalesce(outside, F.lit(False)), "warn").otherwise("pass").alias("status"))


def cnr_gate(with_cnr: DataFrame, threshold: float) -> DataFrame:
    return with_cnr.where(F.col("cnr") >= threshold)


def conversion_summary(curves: DataFrame, *, by: list[str], conc: str = "conc", baseline: int = 10, most: float = 20.0) -> DataFrame:
    """Voxels, those over ``most`` mM, the median baseline and T1, and the frame at which the mean curve peaks."""
    from curvemill.operators.aggregate import mean_curve

    over = F.exists(conc, lambda v: v > most).cast("long")
    counts = curves.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(over).alias("n_over"))
    early = median(curves.withColumn("_b", A.mean(A.span(F.col(conc), 0, baseline))), by=by, column="_b", name="baseline")
    t1 = median(curves, by=by, column="t1_ms", name="t1_ms")
    peak = mean_curve(curves.select(*by, F.col(conc).alias("values")), by=by).select(*by, A.argmax(F.col("values")).alias("peak_frame"))
    return same_keys(same_keys(same_keys(counts, early, by), t1, by), peak, by)


def fit_quality(curves: DataFrame, *, values: str = "values", predicted: str = "predicted") -> DataFrame:
    """R2 of a model's reconstruction; null for a flat curve."""
    sse = A.total(F.zip_with(values, predicted, lambda a, b: (a - b) * (a - b)))
    sst = A.let(A.mean(F.col(values)), lambda m: A.total(F.transform(values, lambda v: (v - m) * (v - m))))
    return curves.withColumn("r2", 1 - sse / F.when(sst > 0, sst))


def overall_status(checks: DataFrame, *, by: list[str]) -> DataFrame:
    """fail over warn over pass."""
    rank = F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0)
    return checks.groupBy(*by).agg(F.element_at(F.array(F.lit("pass"), F.lit("warn"), F.lit("fail")), F.max(rank) + 1).alias("status"))
