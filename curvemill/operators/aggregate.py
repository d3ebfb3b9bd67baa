"""Reductions of maps and curves by voxel, label, region and slice. Percentiles are exact, whatever a group's size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.functions import arrays as A
from curvemill.functions.percentiles import median, percentiles
from curvemill.functions.tables import checkpointed, small
from curvemill.sources.curves import subjects, to_curves, to_long


def unpivot(maps: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Wide maps to (keys, map, value)."""
    return maps.select(*keys, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(keys, names, "map", "value")


def same_keys(a: DataFrame, b: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """a with b's columns by keys; null keys are equal."""
    right = b.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in b.columns if c not in keys])
    condition = F.lit(True)
    for i, k in enumerate(keys):
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return a.join(right, condition, how).drop(*[f"_k{i}" for i in range(len(keys))]) if keys else a.crossJoin(F.broadcast(b))


def voxelwise(maps: DataFrame, *, keys: list[str]) -> DataFrame:
    """n_finite and the 5th, 50th and 95th percentiles of each map."""
    counts = maps.groupBy(*keys).agg(F.count(A.finite(F.col("value"))).alias("n_finite"))
    return same_keys(counts, percentiles(maps, by=keys, at={"p5": 0.05, "p50": 0.5, "p95": 0.95}), keys)


def _summary(maps: DataFrame, by: list[str]) -> DataFrame:
    """mean, sample sd (0 for one value), n and median of the finite values of every group."""
    v = A.finite(F.col("value"))
    moments = maps.groupBy(*by).agg(F.avg(v).alias("mean"), F.when(F.count(v) > 0, F.coalesce(F.stddev_samp(v), F.lit(0.0))).alias("sd"), F.count(v).alias("n"))
    return same_keys(moments, median(maps, by=by), by).select(*by, "mean", "median", "sd", "n")


def by_label(maps: DataFrame, *, keys: list[str], label: str = "label", labels: DataFrame | None = None) -> DataFrame:
    """mean, median, sample sd (0 for one value) and n of every label above 0.

    Labels of ``labels`` (label) that no voxel has come out with n = 0, for every set of keys. Keys without any label above 0
    get one row of label 0 over all their voxels, as has a table without a label column.
    """
    whole = maps if label in maps.columns else maps.withColumn(label, F.lit(None).cast("int"))
    inside = whole.where(F.col(label) > 0)
    unlabelled = whole.join(inside.select(*keys).distinct(), keys, "left_anti") if keys else whole.where(F.lit(not inside.limit(1).count()))
    found = _summary(inside, [*keys, label]).unionByName(_summary(unlabelled.withColumn(label, F.lit(0).cast(whole.schema[label].dataType)), [*keys, label]))
    if labels is None:
        return found
    every = inside.select(*keys).distinct().crossJoin(small(labels.select(label).distinct()))
    missing = every.join(found.select(*keys, label), [*keys, label], "left_anti")
    return found.unionByName(missing.select(*keys, label, *[F.lit(None).cast("double").alias(c) for c in ("mean", "median", "sd")], F.lit(0).cast("long").alias("n")))


def by_region(maps: DataFrame, region_map: DataFrame, *, label: str = "label", keys: list[str] | None = None) -> DataFrame:
    """The same over the union of a region's labels; a label may be in several regions, a region without voxels has n = 0."""
    keys = subjects(maps) if keys is None else keys
    bridge = region_map.select("region", F.col(label))
    if not keys:
        return _summary(bridge.join(maps.select(label, "value"), label, "left"), ["region"])
    every = maps.select(*keys).distinct().crossJoin(small(region_map.select("region").distinct()))
    found = _summary(maps.select(*keys, label, "value").join(bridge, label), [*keys, "region"])
    return every.join(found, [*keys, "region"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def by_slice(maps: DataFrame, *, axis: str, n_slices: int, keys: list[str] | None = None) -> DataFrame:
    """mean, median, quartiles and n of every slice, empty ones too."""
    keys = subjects(maps) if keys is None else keys
    by = [*keys, "slice"]
    sliced = maps.select(*keys, F.col(axis).alias("slice"), "value")
    found = same_keys(_summary(sliced, by), percentiles(sliced, by=by, at={"p25": 0.25, "p75": 0.75}), by)
    every = maps.sparkSession.range(n_slices).select(F.col("id").cast("int").alias("slice"))
    every = maps.select(*keys).distinct().crossJoin(F.broadcast(every)) if keys else every
    return every.join(found, by, "left").select(*by, "mean", "median", "p25", "p75", F.coalesce("n", F.lit(0)).alias("n"))


#: Percentiles of ``by_levels`` beside the median.
SPREAD = {"p5": 0.05, "p25": 0.25, "p75": 0.75, "p95": 0.95}


def by_levels(maps: DataFrame, region_map: DataFrame, *, keys: list[str], label: str = "label", axis: str | None = None, n_slices: int = 0, group_rows: int | None = None) -> DataFrame:
    """The whole, every label above 0, every region and every slice of each set of keys, in two passes over the maps.

    (keys, level, unit, mean, median, sd, n, p5, p25, p75, p95) with level whole, label, region or slice and unit its name, null for
    the whole. Each is as in voxelwise, by_label, by_region and by_slice: moments of the finite values, sd 0 for one value, exact
    percentiles. Regions and slices without voxels have n = 0; slices beyond ``n_slices`` are left out.

    One pass counts and adds up all levels, combined before its shuffle; its counts tell percentiles which groups are large.
    """
    unit = lambda level, name: F.struct(F.lit(level).alias("level"), name.cast("string").alias("unit"))
    none = F.array().cast("array<struct<level:string,unit:string>>")
    regions = region_map.select(F.col(label), "region").where("region is not null").groupBy(label).agg(F.array_sort(F.collect_set("region")).alias("_regions"))  # a label's
    columns = [*keys, F.col(label), F.col("value").cast("double").alias("value"), *([F.col(axis).alias("_slice")] if axis else [])]
    placed = maps.select(*columns).join(small(regions), label, "left")
    units = [F.array(unit("whole", F.lit(None))), F.when(F.col(label) > 0, F.array(unit("label", F.col(label)))).otherwise(none)]
    units.append(F.coalesce(F.transform("_regions", lambda r: unit("region", r)), none))
    if axis:
        units.append(F.when(F.col("_slice").between(0, n_slices - 1), F.array(unit("slice", F.col("_slice")))).otherwise(none))
    each = placed.select(*keys, F.inline(F.concat(*units)), "value")
    by, v = [*keys, "level", "unit"], A.finite(F.col("value"))
    sd = F.when(F.count(v) > 0, F.coalesce(F.stddev_samp(v), F.lit(0.0)))
    moments = checkpointed(each.groupBy(*by).agg(F.avg(v).alias("mean"), sd.alias("sd"), F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi")))
    ranks = percentiles(each, by=by, at={"median": 0.5, **SPREAD}, sizes=moments, group_rows=group_rows)
    found = same_keys(moments, ranks, by).select(*by, "mean", "median", "sd", F.col("_n").alias("n"), *SPREAD)
    names = region_map.where("region is not null").select(unit("region", F.col("region")).alias("_u")).distinct()
    if axis:
        names = names.unionByName(maps.sparkSession.range(n_slices).select(unit("slice", F.col("id")).alias("_u")))
    sets = moments.where("level = 'whole'").select(*keys)
    every = sets.crossJoin(small(names)).select(*keys, "_u.*")
    missing = same_keys(every, moments.select(*by, F.lit(True).alias("_there")), by).where("_there is null").drop("_there")
    empty = missing.select(*by, *[F.lit(None).cast("double").alias(c) for c in ("mean", "median", "sd")], F.lit(0).cast("long").alias("n"), *[F.lit(None).cast("double").alias(c) for c in SPREAD])
    return found.unionByName(empty)


def group_median_curve(curves: DataFrame, *, by: list[str], least: int = 50) -> DataFrame:
    """Per-frame median curve of every group with at least ``least`` curves."""
    big = curves.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(*by)
    long = to_long(curves.join(big, by, "left_semi"), *by)
    return to_curves(median(long, by=[*by, "frame"], name="value"), by)


def mean_curve(curves: DataFrame, *, by: list[str]) -> DataFrame:
    """Per-frame mean over the voxels of every group, NaN left out."""
    return to_curves(to_long(curves, *by).groupBy(*by, "frame").agg(F.avg(A.finite(F.col("value"))).alias("value")), by)


def median_nonzero(maps: DataFrame, *, keys: list[str]) -> DataFrame:
    return median(maps.withColumn("value", F.when(F.col("value") != 0, F.col("value"))), by=keys)


def paint_back(maps: DataFrame, *, label: str = "label", voxel: str = "voxel_id") -> DataFrame:
    """The label's median on each of its voxels; voxels of no label are null."""
    by = [*subjects(maps), label]
    medians = median(maps.where(F.col(label) > 0), by=by, name="painted")
    return maps.select(*subjects(maps), voxel, label).join(medians, by, "left")


def representative_voxel(maps: DataFrame, *, by: str, voxel: str = "voxel_id") -> DataFrame:
    """The voxel of each group nearest its median, the least id on a tie."""
    groups = [*subjects(maps), by]
    near = maps.join(median(maps, by=groups, name="_m"), groups).where(A.finite(F.col("value")).isNotNull())
    best = near.groupBy(*groups).agg(F.min(F.struct(F.abs(F.col("value") - F.col("_m")).alias("d"), F.col(voxel).alias("v"), F.col("value").alias("x"))).alias("b"))
    return best.select(*groups, F.col("b.v").alias(voxel), F.col("b.x").alias("value"))


def label_slice_median_curve(curves: DataFrame, region_map: DataFrame, *, least: int = 3, shifted: bool = False) -> DataFrame:
    """Region curves: the median across slices of per-slice median curves (slices with at least ``least`` curves), and n_slices.

    With ``shifted``, each slice's curve starts at its own onset and at zero before it enters the region's median.
    """
    from curvemill.operators.preprocess import onset_walk, shift_to_zero

    subject = subjects(curves)
    members = curves.where(F.exists("values", lambda v: v != 0) & F.forall("values", lambda v: ~F.isnan(v))).join(region_map, "label")
    at = [*subject, "region", "z"]
    slices = members.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(*at)
    per_slice = median(to_long(members.join(slices, at, "left_semi"), *at), by=[*at, "frame"], name="value")
    if shifted:
        whole = to_curves(per_slice, at)
        per_slice = to_long(whole.withColumn("values", shift_to_zero(F.col("values"), onset_walk(F.col("values")), always=True)), *at)
    curve = to_curves(median(per_slice, by=[*subject, "region", "frame"], name="value"), [*subject, "region"])
    return curve.join(slices.groupBy(*subject, "region").agg(F.count(F.lit(1)).alias("n_slices")), [*subject, "region"])


def region_curve_fit(curves: DataFrame, region_map: DataFrame, inputs: DataFrame, *, model: str = "patlak", least: int = 3, shifted: bool = True, **options) -> DataFrame:
    """A model's fit of every region's median curve."""
    from curvemill.operators.fitting import fit_model

    found = label_slice_median_curve(curves, region_map, least=least, shifted=shifted)
    keys = [*subjects(found), "region"]
    return fit_model(found, inputs, model, keys=[*keys, "n_slices"], **options)


def unit_metadata(maps: DataFrame, units: DataFrame) -> DataFrame:
    """maps with the unit of each map, null where none is known."""
    return maps.join(units, "map", "left")


def first_by(rows: DataFrame, partition: list[str], order: list[Column], n: int = 1) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).where(F.col("_r") <= n).drop("_r")
