"""Selection of the shared input curve."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from curvemill.functions import arrays as A
from curvemill.functions.percentiles import median, percentiles
from curvemill.functions.tables import checkpointed, small
from curvemill.operators.aggregate import same_keys
from curvemill.operators.labels import binary_close, component_of, connected_components, fill_holes, mask_shell, otsu_threshold, strongest_component, with_threshold
from curvemill.sources.curves import subjects, to_curves, to_long


def peak_over_baseline(a: Column, baseline: int = 5) -> Column:
    """max(frames from baseline on) - mean(frames before)."""
    return F.array_max(A.span(a, baseline, F.size(a))) - A.mean(A.span(a, 0, baseline))


def top_peak(curves: DataFrame, *, by: list[str], n: int = 32, baseline: int = 5, masked: bool = False, band: tuple[float, float] | None = None, n_slices: int | None = None) -> DataFrame:
    """voxel_id, peak and rank of the n voxels with the highest peaks, for each of ``by``; the least id wins a tie.

    ``masked``: only voxels whose mean exceeds the subject's Otsu threshold. ``band``: only slices from and to these shares of
    ``n_slices``, in subjects (or groups) where that leaves n voxels.
    """
    groups = [*dict.fromkeys([*subjects(curves), *by])]
    peaked = curves.withColumn("peak", peak_over_baseline(F.col("values"), baseline))
    if masked:
        peaked = peaked.withColumn("_mean", A.mean(F.col("values")))
        threshold = otsu_threshold(peaked, column="_mean", by=subjects(curves))
        peaked = with_threshold(peaked, threshold, subjects(curves)).where(F.col("_mean") > F.col("threshold")).drop("_mean", "threshold")
    if band:
        if not n_slices:
            raise ValueError("a band of slices needs n_slices")
        inside = F.col("z").between(math.floor(band[0] * n_slices), math.ceil(band[1] * n_slices) - 1)
        counts = peaked.groupBy(*groups).agg(F.count_if(inside).alias("_inside"))
        peaked = with_threshold(peaked, counts, groups).where(inside | (F.col("_inside") < n)).drop("_inside")
    if not groups:  # a sort with a limit: no task holds all voxels
        peaked = peaked.orderBy(F.desc("peak"), "voxel_id").limit(n)
    rank = F.row_number().over(Window.partitionBy(*(groups or [F.lit(0)])).orderBy(F.desc("peak"), "voxel_id"))
    return peaked.withColumn("rank", rank).where(F.col("rank") <= n)


def curve_from_members(curves: DataFrame, members: DataFrame, *, by: list[str], method: str = "mean") -> DataFrame:
    """The per-frame mean, median or largest value of the member voxels' curves.

    ``adaptive_max`` is the largest value over members without a missing value, over all of them where there is no such one.
    """
    if method not in ("mean", "median", "max", "adaptive_max"):
        raise ValueError("method must be mean, median, max or adaptive_max")
    subject = subjects(curves, members)
    groups = [*dict.fromkeys([*subject, *by])]
    chosen = curves.join(members, [*subject, "voxel_id"], "left_semi")
    if method == "median":
        return to_curves(median(to_long(chosen, *groups), by=[*groups, "frame"], name="value"), groups)
    v = A.finite(F.col("value"))
    if method == "adaptive_max":
        whole = F.forall("values", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        each = chosen.select(*groups, whole.alias("_whole"), F.posexplode("values").alias("frame", "value"))
        best = F.coalesce(F.max(F.when(F.col("_whole"), v)), F.max(v))
        return to_curves(each.groupBy(*groups, "frame").agg(best.alias("value")), groups)
    how = F.avg(v) if method == "mean" else F.max(v)
    return to_curves(to_long(chosen, *groups).groupBy(*groups, "frame").agg(how.alias("value")), groups)


def max_voxel(curves: DataFrame, *, by: list[str], baseline: int = 5, conc: str | None = None, ceiling: float = 0.0) -> DataFrame:
    """The voxel with the highest baseline-corrected peak of ``values``, of those without a missing value.

    With ``conc``, the returned curve is that column's, and with a ``ceiling`` voxels whose concentration exceeds it are passed
    over; where all do, the one that exceeds it least is taken.
    """
    groups = [*dict.fromkeys([*subjects(curves), *by])]
    clean = curves.where(F.forall("values", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))))
    top = F.array_max(A.finite_values(F.col(conc))) if conc else F.lit(0.0)
    over = F.lit(bool(conc) and ceiling > 0) & F.coalesce(top > ceiling, F.lit(True))
    peak = peak_over_baseline(F.col("values"), baseline)
    score = F.when(over, -F.coalesce(top, F.lit(float("inf")))).otherwise(peak)
    keyed = clean.select(*groups, F.struct((~over).alias("within"), score.alias("score"), (-F.col("voxel_id")).alias("k"), peak.alias("peak"), F.col("voxel_id").alias("voxel_id"), F.col(conc or "values").alias("values")).alias("s"))
    best = keyed.groupBy(*groups).agg(F.max("s").alias("s"))
    return best.select(*groups, "s.voxel_id", "s.peak", "s.values")


def max_prior_over_roi(priors: DataFrame, members: DataFrame, *, roi: str = "roi") -> DataFrame:
    """priors (voxel_id, m0, ...) of the members (voxel_id, roi) with each m0 replaced by the largest finite positive one of its region."""
    by = subjects(priors, members)
    inside = priors.join(members.select(*by, "voxel_id", roi), [*by, "voxel_id"])
    best = inside.where(A.finite(F.col("m0")) > 0).groupBy(*by, roi).agg(F.max("m0").alias("_best"))
    return inside.join(best, [*by, roi], "left").withColumn("m0", F.coalesce("_best", "m0")).drop("_best")


def select_slices(scores: DataFrame, *, thresholds: list[float], top: int = 3) -> DataFrame:
    """Best frame of each slice, then each subject's slices at the first threshold that any of them reaches, best first."""
    by = subjects(scores)
    best = scores.groupBy(*by, "slice").agg(F.max(F.struct("score", (-F.col("frame")).alias("k"))).alias("s")).select(*by, "slice", F.col("s.score").alias("score"), (-F.col("s.k")).alias("frame"))
    level = F.lit(len(thresholds))
    for i, t in reversed(list(enumerate(thresholds))):
        level = F.when(F.col("score") >= t, i).otherwise(level)
    # One row a slice: a subject's are few.
    least = F.min("level").over(Window.partitionBy(*by))
    chosen = best.withColumn("level", level).withColumn("least", least).where((F.col("level") <= F.col("least")) & (F.col("score") > 0))
    ranked = chosen.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "slice"))).where(F.col("rank") <= top)
    return ranked.select(*by, "slice", "frame", "score", "rank")


def temporal_features(curves: DataFrame, *, baseline: int = 5) -> DataFrame:
    """ttp, ttp_frac, arrival (first above a tenth of the peak), washout and early_late of every curve of 6 frames or more."""

    def of(x: Column) -> Column:
        c = A.let(A.mean(A.span(x, 0, baseline)), lambda m: F.transform(x, lambda v: v - m))

        def features(c: Column) -> Column:
            n, peak, at = F.size(c), F.array_max(c), A.argmax(c)
            half = F.floor(n / 2).cast("int")
            early, late = F.array_max(F.slice(c, F.lit(1), half)), F.array_max(F.slice(c, half + 1, n))
            tail = A.mean(F.slice(c, F.floor(n * 0.8).cast("int") + 1, n))
            return F.struct(
                at.alias("ttp"),
                (at / F.greatest(n - 1, F.lit(1))).alias("ttp_frac"),
                A.first_index(c, lambda v: v > 0.1 * peak).alias("arrival"),
                F.when(peak > 0, (peak - tail) / peak).alias("washout"),
                F.when(peak > 0, early / F.greatest(late, 0.05 * peak)).alias("early_late"),
            )

        return A.let(c, features)

    found = curves.where(F.size("values") >= 6).withColumn("_f", A.let(F.col("values"), of))
    return found.select(*curves.columns, "_f.*")


def classify_curve(features: DataFrame) -> DataFrame:
    vessel = (F.col("early_late") >= 1.5) & (F.col("ttp_frac") <= 0.55)
    return features.withColumn("kind", F.when(F.col("early_late").isNull(), "none").when(vessel, "vessel").otherwise("mucosa"))


def max_projection(curves: DataFrame) -> DataFrame:
    return curves.withColumn("projection", F.coalesce(F.array_max(A.finite_values(F.col("values"))), F.lit(0.0)))


def curve_metrics(curves: DataFrame, *, dt: float, baseline: int = 5) -> DataFrame:
    """Seven measures of a bolus, null for curves of fewer than 5 frames or without a positive peak.

    On the smoothed curve: peak, arrival (frame and seconds of the first tenth of it), fwhm (frames and seconds between the ends of the
    first pass above half) and auc_peak (area up to the peak over it); on the raw one: tail_cv behind the peak, base_sd and roughness.
    """

    def of(x: Column) -> Column:
        def metrics(s: Column) -> Column:
            n, peak, at = F.size(s), F.array_max(s), A.argmax(s)
            low = F.transform(s, lambda v: v < peak / 2)
            left = F.coalesce(F.array_max(F.transform(F.slice(low, F.lit(1), at), lambda b, i: F.when(b, i))), F.lit(0))
            right = F.coalesce(F.array_min(F.transform(low, lambda b, i: F.when(b & (i > at), i))), n - 1)
            width = right - left
            arrival = A.first_index(s, lambda v: v >= 0.1 * peak)
            tail = F.when(at + 1 < n, F.slice(x, at + 2, n)).otherwise(F.slice(x, n - F.greatest(F.lit(1), F.floor(n / 3).cast("int")) + 1, n))
            cv = A.let(A.mean(tail), lambda m: F.when(m != 0, A.std_pop(tail) / F.abs(m)).otherwise(float("inf")))
            ok = (F.size(x) >= 5) & (peak > 0)
            found = {
                "peak": peak, "arrival": arrival, "arrival_s": arrival * dt, "fwhm_frames": width, "fwhm_s": width * dt,
                "auc_peak": A.total(F.transform(F.slice(s, F.lit(1), at + 1), lambda v: F.greatest(v, F.lit(0.0)))) * dt / peak,
                "tail_cv": cv, "base_sd": A.std_pop(A.span(x, 0, baseline)), "roughness": A.mean(F.transform(A.differences(x), lambda d: F.abs(d))) / peak,
                "_raw": F.get(x, at), "_first_pass": F.array_max(F.slice(x, F.lit(1), at + 1)),
            }
            return F.struct(*[F.when(ok, c).alias(k) for k, c in found.items()])

        return A.let(A.smooth3(x), metrics)

    return curves.withColumn("_m", A.let(F.col("values"), of)).select(*curves.columns, "_m.*")


def spike_veto(curves: DataFrame, *, dt: float = 1.0, baseline: int = 5) -> DataFrame:
    """curve_metrics with vetoed: less than 2.5 frames wide, an apex over 1.5 or a first pass over 1.6 times the smoothed peak, or no measures."""
    spike = (F.col("fwhm_frames") < 2.5) | (F.col("_raw") > 1.5 * F.col("peak")) | (F.col("_first_pass") > 1.6 * F.col("peak"))
    return curve_metrics(curves, dt=dt, baseline=baseline).withColumn("vetoed", F.coalesce(spike, F.lit(True))).drop("_raw", "_first_pass")


#: Fixed values: (measure, weight, whether more is better) of the ranking.
RANKING = (
    ("peak", 0.7, True),
    ("arrival_s", 0.5, False),
    ("fwhm_s", 0.6, False),
    ("auc_peak", 0.7, False),
    ("tail_cv", 1.5, False),
    ("base_sd", 0.7, False),
    ("roughness", 2.0, False),
)


def rank_candidates(metrics: DataFrame, *, by: list[str], name: str = "voxel_id", parent: str | None = None) -> DataFrame:
    """score, vetoed and rank of candidates (spike_veto's columns): measures scaled to 0-1 within ``by``, turned so that more is better, and weighted.

    A measure that is not finite, or the same for all, counts 0.5, or 0 if it is finite and less is better. With ``parent``, the
    name of the candidate that another one derives from, a vetoed parent vetoes it. Vetoed ones come last, those without measures at
    the very end without a score.
    """
    groups = [*dict.fromkeys([*subjects(metrics), *by])]
    if parent:
        vetoes = metrics.where("vetoed").select(*groups, F.col(name).alias(parent), F.lit(True).alias("_veto")).distinct()
        metrics = metrics.join(vetoes, [*groups, parent], "left").withColumn("vetoed", F.col("vetoed") | F.coalesce("_veto", F.lit(False))).drop("_veto")
    valid = F.col("peak").isNotNull()
    ends = [f(F.when(valid, A.finite(F.col(m).cast("double")))).alias(f"_{e}_{m}") for m, _, _ in RANKING for e, f in (("lo", F.min), ("hi", F.max))]
    limits = metrics.groupBy(*groups).agg(*ends)
    joined = same_keys(metrics, small(limits), groups)
    score = F.lit(0.0)
    for metric, weight, more in RANKING:
        v, lo, hi = A.finite(F.col(metric).cast("double")), F.col(f"_lo_{metric}"), F.col(f"_hi_{metric}")
        unit = (v - lo) / F.when(hi > lo, hi - lo)
        flat = F.when(v.isNotNull() & F.lit(not more), 0.0).otherwise(0.5)
        score = score + weight * F.coalesce(unit if more else 1 - unit, flat)
    scored = joined.withColumn("score", F.when(valid, score / sum(w for _, w, _ in RANKING)))
    order = [F.col("vetoed"), F.desc_nulls_last(F.round("score", 9)), F.col(name)]
    return ranked(scored, groups, order).select(*groups, name, "score", "vetoed", "rank")


def ranked(rows: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """rows with rank (from 1) within ``by`` in an order, by one range-partitioned sort: no task holds a whole group.

    A group that spans partitions continues the rank of the partitions before, whose counts are a few rows.
    """
    placed = checkpointed(rows.orderBy(*by, *order).withColumns({"_p": F.spark_partition_id(), "_i": F.monotonically_increasing_id()}))
    counts = placed.groupBy(*by, "_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(*by, "_p", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy(*by, "_p").orderBy("_i"))
    return same_keys(placed.withColumn("_w", within), starts, [*by, "_p"]).withColumn("rank", (F.col("_before") + F.col("_w")).cast("long")).drop("_p", "_i", "_w", "_before")


def washout_flag(curves: DataFrame, *, dose_mmol_kg: str | None = None, blood_ml_kg: float = 72.0, hematocrit: float = 0.45) -> DataFrame:
    """tail_ratio, the median of the last fifth (3 frames at least) over the peak, flagged from 0.6 on; 12 finite frames or more.

    With the column of a dose, mixed_mm is the concentration of the fully mixed dose (null for none) and over_mixed tells whether
    the tail of a flagged curve lies at or above it.
    """
    x = A.finite_values(F.col("values"))

    def of(c: Column) -> Column:
        n, peak = F.size(c), F.array_max(c)
        tail = A.median(F.slice(c, n - F.greatest(F.lit(3), F.floor(n / 5).cast("int")) + 1, n))
        return F.when((n >= 12) & (peak > 0), F.struct(tail.alias("tail"), (tail / peak).alias("ratio")))

    found = curves.withColumn("_w", A.let(x, of)).withColumn("tail_ratio", F.col("_w.ratio"))
    found = found.withColumn("flagged", F.coalesce(F.col("tail_ratio") >= 0.6, F.lit(False)))
    if dose_mmol_kg:
        mixed = F.when(F.col(dose_mmol_kg) > 0, F.col(dose_mmol_kg) / (blood_ml_kg / 1000 * max(1e-6, 1 - hematocrit)))
        found = found.withColumn("mixed_mm", mixed).withColumn("over_mixed", F.when(mixed.isNotNull(), F.col("flagged") & (F.col("_w.tail") >= mixed)))
    return found.drop("_w")


def input_saturation(curves: DataFrame, members: DataFrame, ceilings: DataFrame, *, values: str = "signal", baseline: int = 5) -> DataFrame:
    """share_over of each subject: members whose peak over their baseline median exceeds the ceiling (saturation_report's)."""
    by = subjects(curves, members)
    chosen = curves.join(members.select(*by, "voxel_id"), [*by, "voxel_id"], "left_semi")
    s0 = A.median(A.finite_values(A.span(F.col(values), 0, baseline)))
    peaks = chosen.select(*by, (F.array_max(A.finite_values(F.col(values))) / F.when(s0 > 0, s0)).alias("_peak")).where("_peak is not null")
    joined = with_threshold(peaks, ceilings.select(*[c for c in by if c in ceilings.columns], "ceiling"), [c for c in by if c in ceilings.columns])
    return joined.groupBy(*by).agg(F.avg((F.col("_peak") > F.col("ceiling")).cast("double")).alias("share_over"))


def clipped_share(a: Column, *, tolerance: float = 1e-3) -> Column:
    """The share of a curve's finite values within a thousandth of its range of the top; 0 for flat ones and fewer than 4."""

    def of(x: Column) -> Column:
        hi, span = F.array_max(x), F.array_max(x) - F.array_min(x)
        top = F.size(F.filter(x, lambda v: v >= hi - tolerance * span)) / F.size(x)
        return F.when((F.size(x) >= 4) & (span > 0), top).otherwise(0.0)

    return A.let(A.finite_values(a), of)


def vesselness(curves: DataFrame, *, by: list[str], baseline: int = 5, percent: float = 0.85) -> DataFrame:
    """Early maximum over late maximum (a 20th of the peak at least); 0 unless the peak is in the top share of its group."""
    groups = [*dict.fromkeys([*subjects(curves), *by])]
    c = A.let(A.mean(A.span(F.col("values"), 0, baseline)), lambda m: F.transform("values", lambda v: v - m))
    half = F.floor(F.size("values") / 2).cast("int")
    found = curves.withColumn("_c", c).withColumns({"_e": F.array_max(F.slice("_c", F.lit(1), half)), "_l": F.array_max(F.slice("_c", half + 1, F.size("_c"))), "_p": F.array_max("_c")})
    limit = percentiles(found, by=groups, column="_p", at={"_limit": percent})
    score = F.when((F.col("_p") > F.col("_limit")) & (F.col("_p") > 0), F.col("_e") / F.greatest("_l", 0.05 * F.col("_p"))).otherwise(0.0)
    return with_threshold(found, limit, groups).withColumn("vesselness", score).drop("_c", "_e", "_l", "_p", "_limit")


def vessel_candidates(curves: DataFrame, *, score: str = "vesselness", percent: float = 0.96, least: int = 8, baseline: int = 5) -> DataFrame:
    """Connected regions of high vesselness: component, n_voxels, centroid (x, y, z), and the features and kind of the voxel that peaks highest.

    The threshold is a percentile of the subject's positive scores.
    """
    by = subjects(curves)
    limit = percentiles(curves.where(F.col(score) > 0), by=by, column=score, at={"_limit": percent})
    high = with_threshold(curves, limit, by).where(F.col(score) >= F.greatest(F.col("_limit"), F.lit(1e-6))).drop("_limit")
    parts = connected_components(high)
    inside = high.join(parts, [*by, "voxel_id"])
    group = [*by, "component"]
    shape = inside.groupBy(*group).agg(F.count(F.lit(1)).alias("n_voxels"), *[F.avg(c).alias(c) for c in "xyz"]).where(F.col("n_voxels") >= least)
    brightest = max_voxel(inside, by=group, baseline=baseline).select(*group, "voxel_id", "values")
    found = classify_curve(temporal_features(shape.join(brightest, group), baseline=baseline))
    return found.drop("values")


def label_vessels(candidates: DataFrame, projection: DataFrame, *, n_slices: int) -> DataFrame:
    """The vein and then the artery of each subject: candidates of kind vessel with role and role_score.

    projection is (voxel_id, x, y, z, projection). Tissue is above its 60th percentile; the midline is its columns' median x, the
    extent its range of y. The vein is far back, near the midline and large; the artery, of the rest, low, central and early.
    """
    by = subjects(candidates, projection)
    tissue = with_threshold(projection, percentiles(projection, by=by, column="projection", at={"_p": 0.6}), by).where(F.col("projection") > F.col("_p"))
    columns = tissue.select(*by, "x", "y").distinct()
    frame = same_keys(columns.groupBy(*by).agg(F.min("y").alias("_front"), F.max("y").alias("_back")), percentiles(columns, by=by, column="x", at={"_mid": 0.5}), by)
    vessels = with_threshold(candidates.where(F.col("kind") == "vessel"), frame, by)
    largest = vessels.groupBy(*by).agg(F.max("n_voxels").alias("_big"), F.greatest(F.max("arrival"), F.lit(1)).alias("_late"))
    vessels = with_threshold(vessels, largest, by)
    span = F.greatest(F.col("_back") - F.col("_front"), F.lit(1))
    central = 1 - F.least(F.lit(1.0), F.abs(F.col("x") - F.col("_mid")) / (0.5 * span))
    vein = 0.5 * (F.col("_back") - F.col("y")) / span + 0.3 * central + 0.2 * F.col("n_voxels") / F.col("_big")
    artery = 0.4 * (1 - F.col("z") / max(1, n_slices - 1)) + 0.35 * central + 0.25 * (1 - F.coalesce("arrival", F.lit(0)) / F.col("_late"))
    # One row a candidate: a subject has few.
    each = Window.partitionBy(*(by or [F.lit(0)]))
    scored = vessels.withColumns({"_v": vein, "_a": artery, "_n": F.count(F.lit(1)).over(each)})
    scored = scored.withColumn("_rv", F.row_number().over(each.orderBy(F.desc("_v"), "component")))
    scored = scored.withColumn("_left", (F.col("_rv") > 1) | (F.col("_n") == 1))
    scored = scored.withColumn("_ra", F.row_number().over(each.orderBy(F.desc("_left"), F.desc("_a"), "component")))
    roles = scored.withColumn("role", F.array_compact(F.array(F.when(F.col("_rv") == 1, "vein"), F.when(F.col("_left") & (F.col("_ra") == 1), "artery"))))
    chosen = roles.select("*", F.explode("role").alias("_role")).withColumn("role", F.col("_role"))
    return chosen.select(*by, "component", "role", F.when(F.col("role") == "vein", F.col("_v")).otherwise(F.col("_a")).alias("role_score"), "n_voxels", "x", "y", "z")


def grow_region(peaks: DataFrame, seeds: DataFrame, *, margin: int = 6, low_share: float = 0.20, smooth: bool = True) -> DataFrame:
    """The voxels of each subject's vessel, grown from a seed (voxel_id) over peaks (voxel_id, x, y, z, value).

    In the box of the seeds, widened by ``margin`` and half their extent, the component of the brightest seed at or above a low
    threshold counts if it reaches a high one; both come from the box's Otsu threshold and the peak. A component that fills
    over 0.8 of the box is taken at higher thresholds (0.35, 0.5, 0.65 of the peak). With ``smooth``, gaps are closed (twice) and holes
    filled slice by slice, within the box.
    """
    by = subjects(peaks, seeds)
    marked = peaks.join(seeds.select(*by, "voxel_id"), [*by, "voxel_id"], "left_semi")
    top = marked.groupBy(*by).agg(F.max(F.struct("value", (-F.col("voxel_id")).alias("k"))).alias("_s"), *[F.min(c).alias(f"_lo{c}") for c in "xyz"], *[F.max(c).alias(f"_hi{c}") for c in "xyz"])
    extent = F.greatest(*[F.col(f"_hi{c}") - F.col(f"_lo{c}") for c in "xyz"])
    wide = F.greatest(F.lit(margin), F.floor(extent / 2).cast("int") + 2)
    top = checkpointed(top.select(*by, F.col("_s.value").alias("_peak"), (-F.col("_s.k")).alias("_seed"), wide.alias("_w"), *[f"_lo{c}" for c in "xyz"], *[f"_hi{c}" for c in "xyz"]))
    inside = F.lit(True)
    for c in "xyz":
        inside = inside & F.col(c).between(F.col(f"_lo{c}") - F.col("_w"), F.col(f"_hi{c}") + F.col("_w"))
    box = checkpointed(with_threshold(peaks, top, by).where(inside).select(*by, "voxel_id", "x", "y", "z", "value", "_peak", "_seed"))
    edge = otsu_threshold(box, by=by)
    box = with_threshold(box, edge, by).withColumns({"_lo": F.greatest(0.8 * F.col("threshold"), low_share * F.col("_peak")), "_hi": F.greatest(1.3 * F.col("threshold"), 0.5 * F.col("_peak"))})
    box = checkpointed(box)
    sizes = box.groupBy(*by).agg(F.count(F.lit(1)).alias("_box"))
    found, pending = None, box
    for share in (0.0, 0.35, 0.50, 0.65):
        low = F.greatest(F.col("_lo"), share * F.col("_peak"))
        bright = pending.where((F.col("value") >= low) & (F.col("_peak") > 0))
        grown = component_of(bright.select(*by, "voxel_id", "x", "y", "z"), pending.select(*by, F.col("_seed").alias("voxel_id")).distinct())
        grown = pending.join(grown, [*by, "voxel_id"], "left_semi")
        state = same_keys(grown.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.max((F.col("value") >= F.col("_hi")).cast("int")).alias("_reached")), sizes, by)
        state = checkpointed(state.withColumn("_full", F.col("_n") > 0.8 * F.col("_box")))
        last = share == 0.65
        kept = with_threshold(grown, state.select(*by, "_reached", "_full"), by).where((F.col("_reached") == 1) & (F.lit(last) | ~F.col("_full"))).select(*by, "voxel_id")
        found = checkpointed(kept if found is None else found.unionByName(kept))
        again = state.where("_full").select(*by, F.lit(True).alias("_again"))
        if last or not again.limit(1).count():
            break
        pending = checkpointed(with_threshold(pending, again, by).where("_again").drop("_again"))
    if not smooth:
        return found
    place = [*by, "x", "y", "z"]
    closed = binary_close(box.join(found, [*by, "voxel_id"], "left_semi"), times=2, planar=True, inside=box)
    return box.join(fill_holes(closed, planar=True), place, "left_semi").select(*by, "voxel_id")


def grow_box(field: DataFrame, seed_box: dict[str, tuple[int, int]], *, share: float = 0.5) -> DataFrame:
    """The voxels in a box (c: (first, last) for x, y, z) at or above a share of its largest value, connected to that voxel."""
    by = subjects(field)
    inside = field
    for c, (a, b) in seed_box.items():
        inside = inside.where(F.col(c).between(a, b))
    top = inside.groupBy(*by).agg(F.max(F.struct("value", (-F.col("voxel_id")).alias("k"))).alias("_s")).select(*by, F.col("_s.value").alias("_peak"), (-F.col("_s.k")).alias("_seed"))
    bright = with_threshold(inside, top, by).where((F.col("_peak") > 0) & (F.col("value") >= share * F.col("_peak")))
    return component_of(bright.select(*by, "voxel_id", "x", "y", "z"), top.select(*by, F.col("_seed").alias("voxel_id")))


def auto_vessel(
    curves: DataFrame, *, dt: float, baseline: int = 6, floor: float = 0.60, early_s: float = 45.0, share: float = 0.05, least: int = 15, most: int = 250, trim: float = 0.10,
    least_peak: float = 0.05, clip: float = 19.0, late: float = 1.3, aggregate: str = "trimmed_mean", align: bool = True, hematocrit: float = 0.0,
) -> tuple[DataFrame, DataFrame]:
    """(members, input curves) of the voxels with the sharpest early boluses, from their shapes alone.

    curves carry ``values`` (concentration) and perhaps ``signal``. Candidates have a baseline signal above a percentile. The
    subject's bolus arrives where their mean curve exceeds a fifth of its peak, at the latest one frame past the baseline; peak, its
    frame and its width at half height are read in a window from there. Four gates, each laxer, are tried until one leaves ``least``
    voxels; the rank is peak over rise time times width. The curves of a share of them, between ``least`` and ``most``, are moved
    onto their median peak frame and averaged frame by frame.
    """
    if aggregate not in ("trimmed_mean", "median", "mean"):
        raise ValueError("aggregate must be trimmed_mean, median or mean")
    by = subjects(curves)
    base = A.mean(A.finite_values(A.span(F.col("signal" if "signal" in curves.columns else "values"), 0, baseline)))
    whole = F.forall("values", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    each = curves.select(*by, "voxel_id", "values", base.alias("_base")).where(whole)
    if floor > 0:
        each = with_threshold(each, percentiles(each, by=by, column="_base", at={"_floor": floor}), by).where(F.col("_base") > F.col("_floor")).drop("_floor")
    each = checkpointed(each)
    mean = to_curves(to_long(each, *by).groupBy(*by, "frame").agg(F.avg("value").alias("value")), by or ["_one"]) if by else to_curves(to_long(each.withColumn("_one", F.lit(1)), "_one").groupBy("_one", "frame").agg(F.avg("value").alias("value")), ["_one"])
    height = F.array_max("values")
    arrival = F.when(height > 0, F.coalesce(A.first_index(F.col("values"), lambda v: v > 0.2 * height), F.lit(0))).otherwise(baseline)
    starts = mean.select(*by, F.least(arrival, F.lit(baseline + 1)).alias("bat"))
    window = max(3, math.ceil(early_s / dt))
    placed = with_threshold(each, starts, by)

    def shape(x: Column) -> Column:
        inside = F.slice(x, F.col("bat") + 1, F.lit(window + 1))

        def of(w: Column) -> Column:
            peak, at = F.array_max(w), A.argmax(w) + F.col("bat")
            low = F.transform(x, lambda v: v <= peak / 2)
            left = F.coalesce(F.array_max(F.transform(F.slice(low, F.lit(1), at), lambda b, i: F.when(b, i))), F.lit(-1))
            right = F.coalesce(F.array_min(F.transform(low, lambda b, i: F.when(b & (i > at), i))), F.size(x))
            after = F.slice(x, F.col("bat") + window + 2, F.size(x))
            return F.struct(
                peak.alias("peak"), at.alias("ttp"), (F.greatest(right - left - 1, F.lit(1)) * dt).alias("fwhm"),
                F.coalesce(F.array_max(after) / F.greatest(peak, F.lit(1e-6)), F.lit(0.0)).alias("late"), (F.array_max(F.transform(x, F.abs)) >= 0.95 * clip).alias("clipped"),
            )

        return A.let(inside, of)

    shaped = placed.withColumn("_s", A.let(F.col("values"), shape)).select(*by, "voxel_id", "values", "bat", "_s.*")
    ok = (F.col("peak") > least_peak) & F.col("ttp").between(F.col("bat"), F.col("bat") + window)
    gates = [ok & ~F.col("clipped") & (F.col("late") <= late), ok & (F.col("late") <= late), ok, F.col("peak") > least_peak]
    gated = checkpointed(shaped.withColumn("_g", F.array(*gates)))
    counts = gated.groupBy(*by).agg(*[F.count_if(F.get("_g", F.lit(i))).alias(f"_n{i}") for i in range(4)])
    which = F.lit(3)
    for i in (2, 1, 0):
        which = F.when(F.col(f"_n{i}") >= least, i).otherwise(which)
    counts = counts.withColumn("_gate", which)
    taken = F.floor(share * F.greatest(F.get(F.array(*[f"_n{i}" for i in range(4)]), F.col("_gate")), F.lit(1)))
    counts = counts.select(*by, "_gate", F.greatest(F.least(taken, F.lit(most)), F.lit(least)).alias("_take"))
    score = F.col("peak") / (F.greatest((F.col("ttp") - F.col("bat") + 1) * dt, F.lit(dt)) * F.greatest(F.col("fwhm"), F.lit(dt)))
    survivors = with_threshold(gated, counts, by).where(F.get("_g", F.col("_gate"))).withColumn("score", score)
    # A rank with a fixed upper bound: Spark keeps the first ``most`` rows of a subject in each task before it shuffles.
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("score"), "voxel_id")
    members = survivors.withColumn("rank", F.row_number().over(order)).where((F.col("rank") <= most) & (F.col("rank") <= F.col("_take")))
    members = checkpointed(members.select(*by, "voxel_id", "values", "ttp", "score", "rank"))
    aligned = members
    if align:
        middle = median(members, by=by, column="ttp", name="_to")
        k = F.floor("_to").cast("int") - F.col("ttp")
        n = F.size("values")
        zeros = lambda m: F.array_repeat(F.lit(0.0), m)
        later = F.concat(zeros(k), F.slice("values", F.lit(1), n - k))
        sooner = F.concat(F.slice("values", 1 - k, n + k), zeros(-k))
        aligned = with_threshold(members, middle, by).withColumn("values", F.when(k > 0, later).when(k < 0, sooner).otherwise(F.col("values")))
    long = to_long(aligned, *by)
    if aggregate == "trimmed_mean":
        ends = percentiles(long, by=[*by, "frame"], at={"_lo": trim, "_hi": 1 - trim})
        long = long.join(ends, [*by, "frame"]).where(F.col("value").between(F.col("_lo"), F.col("_hi")))
    middle = median(long, by=[*by, "frame"], name="value") if aggregate == "median" else long.groupBy(*by, "frame").agg(F.avg("value").alias("value"))
    scale = 1 / (1 - hematocrit) if hematocrit > 0 else 1.0
    curve = to_curves(middle.withColumns({"_one": F.lit(1), "value": F.col("value") * scale}), [*by, "_one"])
    axis = F.transform("values", lambda v, i: i * F.lit(float(dt)))
    return members.drop("values"), curve.select(*by, F.col("values").alias("c_a"), axis.alias("t_s"))


def pca_vessel(
    curves: DataFrame, *, n: int = 20, components: int = 6, baseline: int = 5, floor: float = 0.60, percent: float = 0.97, early: float = 0.45, border: tuple[int, int, int] = (1, 1, 1), shape: tuple[int, int, int] | None = None,
    mask: DataFrame | None = None, shell_mm: float = 1.5, voxel_mm: tuple[float, float, float] = (1.0, 1.0, 1.0)
) -> tuple[DataFrame, DataFrame]:
    """(members, input curves): the best-connected voxels along the principal component of curves that peaks early and rises most sharply.

    Voxels off the faces of the volume (``shape``) by ``border`` and with a baseline above a percentile, that peak no later than
    the subject's mean curve, are centred; their covariance over frames (T x T sums) is all that leaves the tasks.
    With a ``mask`` (subject_id, voxel_id), the voxels within ``shell_mm`` of its surface take the place of those with a high
    baseline; a subject without a voxel in its mask goes by the baseline.
    """
    by = subjects(curves)
    shell = None
    if mask is not None:
        own = subjects(curves, mask)
        shell = mask_shell(curves, mask, limit=shell_mm, mm=voxel_mm).select(*own, "voxel_id", F.lit(True).alias("_near"))
        there = curves.select(*own, "voxel_id").join(mask.select(*own, "voxel_id"), [*own, "voxel_id"], "left_semi").groupBy(*own).agg((F.count(F.lit(1)) > 0).alias("_masked")).where("_masked")
    if shape:
        for c, k, m in zip("xyz", border, shape):
            k = min(k, (m - 1) // 2)
            curves = curves.where(F.col(c).between(k, m - 1 - k))
    base = A.mean(A.finite_values(A.span(F.col("values"), 0, baseline)))
    each = curves.select(*by, "voxel_id", "x", "y", "z", "values", base.alias("_base")).where("_base is not null")
    region = with_threshold(each, percentiles(each, by=by, column="_base", at={"_floor": floor}), by)
    high = F.col("_base") > F.col("_floor")
    if shell is not None:
        region = with_threshold(region.join(shell, [*own, "voxel_id"], "left"), there, own)
        high = F.when(F.col("_masked"), F.coalesce("_near", F.lit(False))).otherwise(high)
    region = region.where(high)
    less = region.withColumn("values", F.transform("values", lambda v: F.coalesce(A.finite(v), F.lit(0.0)) - F.col("_base"))).select(*by, "voxel_id", "x", "y", "z", "values")
    less = checkpointed(less.withColumn("ttp", A.argmax(A.smooth3(F.col("values")))))
    mean = to_curves(to_long(less.withColumn("_one", F.lit(1)), *by, "_one").groupBy(*by, "_one", "frame").agg(F.avg("value").alias("value")), [*by, "_one"])
    reference = mean.select(*by, A.argmax(F.col("values")).alias("_ref"))
    soon = percentiles(less, by=by, column="ttp", at={"_soon": 0.25})
    joined = with_threshold(with_threshold(less, reference, by), soon, by)
    few = joined.groupBy(*by).agg((F.count_if(F.col("ttp") <= F.col("_ref")) < max(8, n)).alias("_few"))
    limit = F.when(F.col("_few"), F.greatest(F.col("_ref"), F.floor("_soon"))).otherwise(F.col("_ref"))
    eligible = checkpointed(with_threshold(joined, few, by).where(F.col("ttp") <= limit).select(*by, "voxel_id", "x", "y", "z", "values"))
    directions = _bolus_directions(eligible, by, components, early)
    scored = with_threshold(eligible, directions, by)
    centred = A.let(A.mean(F.col("values")), lambda m: F.transform("values", lambda v: v - m))
    scored = scored.withColumn("score", F.coalesce(A.total(F.zip_with(centred, "_axis", lambda v, a: v * a)), F.array_max("values"))).drop("_axis")
    scored = checkpointed(scored)
    hot = with_threshold(scored, percentiles(scored, by=by, column="score", at={"_hot": percent}), by).where(F.col("score") >= F.col("_hot"))
    best = strongest_component(hot)
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.desc("score"), "voxel_id")
    members = checkpointed(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n))
    return members, to_curves(
        to_long(scored.withColumn("_one", F.lit(1)).join(members.select(*by, "voxel_id"), [*by, "voxel_id"], "left_semi"), *by, "_one").groupBy(*by, "_one", "frame").agg(F.avg("value").alias("value")), [*by, "_one"]
    ).drop("_one").withColumnRenamed("values", "c_a")


def _bolus_directions(curves: DataFrame, by: list[str], components: int, early: float) -> DataFrame:
    """_axis of each subject: of the first principal directions of its centred curves, the one that peaks early and rises most sharply, null for none.

    Tasks add up T x T products; their sums by cell are combined before the shuffle, and a subject's T x T cells meet in one task.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for b in batches:
            who = list(zip(*[b.column(i).to_pylist() for i in range(len(by))])) if by else [()] * b.num_rows
            values = np.array(b.column(len(by)).to_pylist(), float)
            for key in dict.fromkeys(who):
                v = values[[w == key for w in who]]
                v = v - v.mean(1, keepdims=True)
                mine = np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
                sums[key] = sums.get(key, 0.0) + mine
        for key, mine in sums.items():
            columns = [pa.array([k] * len(mine), t) for k, t in zip(key, types)]
            yield pa.record_batch([*columns, pa.array(np.arange(len(mine))), pa.array(mine)], [*by, "cell", "v"])

    def direction(cells: pd.DataFrame) -> pd.DataFrame:
        v = cells.sort_values("cell")["v"].to_numpy()
        t = (math.isqrt(4 * len(v) - 3) - 1) // 2  # 1 + t + t * t cells
        cov = v[1 + t :].reshape(t, t) - np.outer(v[1 : 1 + t], v[1 : 1 + t]) / v[0]
        best, sharpest = None, -np.inf
        for a in np.linalg.eigh(cov)[1][:, ::-1][:, :components].T:
            a = a if abs(a.max()) >= abs(a.min()) else -a
            at = int(a.argmax())
            if 0 < at <= max(3, int(early * t)) and (a[at] - a[:at].min()) / at > sharpest:
                best, sharpest = a, (a[at] - a[:at].min()) / at
        return pd.DataFrame([[*cells[by].iloc[0], None if best is None else best.tolist()]], columns=[*by, "_axis"])

    types = [to_arrow_type(curves.schema[c].dataType) for c in by]
    key_types = [f"`{c}` {curves.schema[c].dataType.simpleString()}" for c in by]
    partial = curves.select(*by, "values").mapInArrow(moments, ", ".join([*key_types, "cell long, v double"]))
    return partial.groupBy(*by, "cell").agg(F.sum("v").alias("v")).groupBy(*by).applyInPandas(direction, ", ".join([*key_types, "_axis array<double>"]))


def find_top_peaks(a: Column, *, most: int = 2, radius: int = 10) -> Column:
    """Frames of the highest values above 0, each blanking ``radius`` frames around it, in order of time."""

    def of(x: Column) -> Column:
        points = F.transform(x, lambda v, i: F.struct(v.alias("height"), i.alias("frame")))
        high = F.filter(points, lambda p: F.coalesce(p["height"] > 0, F.lit(False)) & ~F.isnan(p["height"]))
        ordered = F.array_sort(high, lambda p, q: F.when(p["height"] > q["height"], -1).when(p["height"] < q["height"], 1).otherwise(p["frame"] - q["frame"]))
        free = lambda s, p: F.forall(s, lambda k: F.abs(k - p["frame"]) > radius)
        kept = F.aggregate(ordered, F.array().cast("array<int>"), lambda s, p: F.when((F.size(s) < most) & free(s, p), F.concat(s, F.array(p["frame"]))).otherwise(s))
        return F.array_sort(kept)

    return A.let(a, of)


def align_to_reference(pairs: DataFrame, *, dt: float, most: int = 2, radius: int = 10, most_shift_s: float = 20.0, rescale: bool = False) -> DataFrame:
    """pairs (vein, artery: arrays) with ``aligned``, shift_s and scale: the vein moved so that its peaks land on the artery's.

    Peaks of the smoothed, baseline-free curves are paired in order of time; the shift is minus the median offset, within bounds. With
    ``rescale`` the vein is raised by the median ratio of heights, never lowered.
    """
    from curvemill.operators.filters import by_length, shift_rows

    n = F.least(F.size("vein"), F.size("artery"))
    cut = pairs.withColumns({c: F.slice(c, F.lit(1), n) for c in ("vein", "artery")})

    def smooth(c: str) -> Column:
        return A.smooth3(A.let(A.median(A.finite_values(A.span(F.col(c), 0, 8))), lambda m: F.transform(c, lambda v: v - m)))

    def place(x: Column, at: Column) -> Column:
        b, v, a = F.get(x, at - 1), F.get(x, at), F.get(x, at + 1)
        den = b - 2 * v + a
        inner = (at > 0) & (at < F.size(x) - 1) & (den != 0)
        return (at + F.coalesce(F.when(inner, A.clip(0.5 * (b - a) / F.when(den != 0, den), -1.0, 1.0)), F.lit(0.0))) * dt

    found = cut.withColumns({"_v": smooth("vein"), "_a": smooth("artery")}).withColumns({f"_p{c}": find_top_peaks(F.col(f"_{c}"), most=most, radius=radius) for c in "va"})
    k = F.least(F.size("_pv"), F.size("_pa"))
    pairs_of = F.arrays_zip(F.slice("_pv", F.lit(1), k).alias("v"), F.slice("_pa", F.lit(1), k).alias("a"))
    found = found.withColumn("_pairs", pairs_of)
    offset = A.median(F.transform("_pairs", lambda p: place(F.col("_v"), p["v"]) - place(F.col("_a"), p["a"])))
    heights = F.transform("_pairs", lambda p: F.when(F.abs(F.get("_v", p["v"])) > 1e-8, F.get("_a", p["a"]) / F.get("_v", p["v"])))
    ratio = A.median(F.filter(heights, lambda r: r.isNotNull()))
    scale = F.when(F.lit(rescale) & (ratio >= 1), ratio).otherwise(1.0)
    found = found.withColumns({"shift_s": F.coalesce(A.clip(-offset, -most_shift_s, most_shift_s), F.lit(0.0)), "scale": F.coalesce(scale, F.lit(1.0))})
    found = found.drop("_v", "_a", "_pv", "_pa", "_pairs")
    names, at = found.columns, found.columns.index("vein")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list = [[] for _ in range(b.num_rows)]
            shift, scale = (b.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("shift_s", "scale"))
            for rows, v in by_length(b.column(at)):
                move = (shift[rows] != 0) & (v.shape[1] > 2)
                if move.any():
                    v[move] = shift_rows(v[move], np.arange(v.shape[1]) * dt, shift[rows[move]])
                for r, x in zip(rows, v * scale[rows, None]):
                    out[r] = x
            yield pa.record_batch([*b.columns, pa.array(out, pa.list_(pa.float64()))], [*names, "aligned"])

    return found.mapInArrow(run, StructType([*found.schema.fields, StructField("aligned", ArrayType(DoubleType()))]))
