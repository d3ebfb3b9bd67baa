"""Cohort bookkeeping: scans, runs and what is left to do. subject_id is a key like any other, so one job does all."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.functions.tables import checkpointed, small

#: What each stage needs, directly.
STAGES: dict[str, tuple[str, ...]] = {
    "load": (),
    "t1_m0": ("load",),
    "signal_to_conc": ("load", "t1_m0"),
    "tissue_roi": ("load",),
    "aif": ("load", "t1_m0", "signal_to_conc"),
    "normalisation": ("load", "signal_to_conc", "aif"),
    "kinetic": ("load", "normalisation", "tissue_roi"),
    "diffusion": ("load", "tissue_roi"),
    "aggregation": ("kinetic", "tissue_roi"),
}


def needed_by(stages: dict[str, tuple[str, ...]]) -> list[tuple[str, str]]:
    """(stage, needed) pairs, the stage itself and what its needs need included."""
    found = {s: {s} for s in stages}
    for _ in stages:
        for s, needs in stages.items():
            for n in needs:
                found[s] |= found.get(n, {n})
    return sorted((s, n) for s, ns in found.items() for n in ns)


def pending_work(subjects: DataFrame, runs: DataFrame, stages: dict[str, tuple[str, ...]] | list[str], *, force: bool = False) -> DataFrame:
    """(subject_id, stage) to run: stages whose latest run did not pass or warn, and all that need one of them.

    ``stages`` gives what each stage needs; in a list, each needs those before it.
    """
    if not isinstance(stages, dict):
        stages = {s: tuple(stages[:i]) for i, s in enumerate(stages)}
    spark = subjects.sparkSession
    wanted = subjects.select("subject_id").distinct().crossJoin(F.broadcast(spark.createDataFrame([(s,) for s in stages], "stage string")))
    if force:
        return wanted
    last = runs.groupBy("subject_id", "stage").agg(F.max_by("status", F.struct("finished_at", F.when(F.col("status").isin("pass", "warn"), 0).otherwise(1))).alias("status"))
    done = last.where(F.col("status").isin("pass", "warn")).select("subject_id", "stage")
    open_ = wanted.join(done, ["subject_id", "stage"], "left_anti")
    needs = F.broadcast(spark.createDataFrame(needed_by(stages), "later string, stage string"))
    return open_.join(needs, "stage").select("subject_id", F.col("later").alias("stage")).distinct()


def scan_roles(scans: DataFrame) -> DataFrame:
    """scans (subject_id, scan_id, protocol, technique, n_reps, n_slices, flip_deg, voxels, geom) with ``role``.

    dynamic: of several repetitions, the most, then the most voxels. flip: gradient echoes of one repetition and one
    geometry with two flip angles or more, on the dynamic scan's geometry where it has such ones, else on the one with most
    scans. anatomical: the spin echo with most voxels. angiography: the first with TOF in its protocol or FC in its technique.
    Localizers and the rest are other. Ties go to the least scan id.
    """
    name, technique = F.upper(F.coalesce("protocol", F.lit(""))), F.upper(F.coalesce("technique", F.lit("")))
    usable = ~name.rlike("LOCALI[SZ]ER|TRIPILOT|SCOUT")
    dynamic = usable & (F.col("n_reps") > 1)
    spin = usable & technique.rlike("RARE|TURBORARE|MSME|SPIN")
    gradient = usable & technique.rlike("FLASH|GRE|GEFC|FISP|FFE") & (F.col("n_reps") <= 1) & F.col("flip_deg").isNotNull() & ~F.isnan("flip_deg")
    angio = usable & (F.contains(name, F.lit("TOF")) | F.contains(technique, F.lit("FC")))
    # A subject has few scans: its windows are small.
    w = Window.partitionBy("subject_id")
    first = lambda ok, *order: F.row_number().over(w.orderBy(F.desc(ok), *order, "scan_id")) == 1
    marked = scans.withColumns({"_gradient": gradient, "_dynamic": dynamic & first(dynamic, F.desc("n_reps"), F.desc("voxels"))})
    marked = marked.withColumns({"_anatomical": spin & first(spin, F.desc("voxels")), "_angio": angio & first(angio), "_geom": F.max(F.when(F.col("_dynamic"), F.col("geom"))).over(w)})
    groups = marked.where("_gradient").groupBy("subject_id", "geom").agg(F.count(F.lit(1)).alias("_scans"), F.countDistinct("flip_deg").alias("_angles"), F.first("_geom").alias("_geom"))
    order = Window.partitionBy("subject_id").orderBy(F.desc(F.col("geom").eqNullSafe(F.col("_geom"))), F.desc("_scans"), "geom")
    chosen = groups.where("_angles >= 2").withColumn("_r", F.row_number().over(order)).where("_r = 1").select("subject_id", "geom", F.lit(True).alias("_set"))
    joined = marked.join(chosen, ["subject_id", "geom"], "left")
    role = F.when(F.col("_dynamic"), "dynamic").when(F.col("_gradient") & F.coalesce("_set", F.lit(False)), "flip").when(F.col("_anatomical"), "anatomical").when(F.col("_angio"), "angiography").otherwise("other")
    return joined.select(*[F.col(c) for c in scans.columns], role.alias("role"))


#: Parts of protocol names by which roles are told, in lower case.
PERFUSION, LABELLED = ("hperf", "perf"), ("pcasl", "qflow", "pold", "casl", "asl")
VOLUME, LOOSE_VOLUME, CONTRAST = ("3di", "3d_tfe", "t1w_3d", "3dt1"), ("3d", "tfe"), "gd"
REFORMATS, REFORMAT_STARTS = ("vwip", "reformat", "recon -"), ("ax ", "ax_", "sag ", "cor ", "reg -")


def protocol_roles(scans: DataFrame) -> DataFrame:
    """scans (subject_id, scan_id, protocol, n_slices) with ``role`` by the names of protocols, letters of either case.

    dynamic: the first scan named as perfusion, without labelled-spin and flow scans unless it carries the full name. anatomical:
    of the scans named as a three-dimensional T1 without contrast, the one with most slices: original ones with a strict name, else
    reformats with one, else originals with a loose name, else reformats with one. Ties go to the least scan id, the rest are
    other; a null protocol is other, a null number of slices counts as 0.
    """
    name = F.lower(F.coalesce("protocol", F.lit("")))
    has = lambda parts: F.array_max(F.array(*[F.contains(name, F.lit(p)) for p in parts]))
    full, part = PERFUSION
    dynamic = has([full]) | (has([part]) & ~has(LABELLED))
    strict = has(VOLUME)
    anatomical = ~has([CONTRAST]) & (strict | (has(["t1"]) & has(LOOSE_VOLUME)))
    reformat = has(REFORMATS) | F.array_max(F.array(*[F.startswith(F.btrim(name), F.lit(p)) for p in REFORMAT_STARTS]))
    grade = F.when(strict, 0).otherwise(2) + F.when(reformat, 1).otherwise(0)
    best = F.struct(grade.alias("grade"), (-F.coalesce(F.col("n_slices"), F.lit(0))).alias("slices"), "scan_id")
    # One aggregate a subject, whatever the number of its scans.
    chosen = scans.groupBy("subject_id").agg(F.min(F.when(dynamic, F.struct("scan_id"))).alias("_d"), F.min(F.when(anatomical, best)).alias("_a"))
    chosen = chosen.select(F.col("subject_id").alias("_s"), F.col("_d.scan_id").alias("_dynamic"), F.col("_a.scan_id").alias("_anatomical"))
    joined = scans.join(chosen, F.col("subject_id").eqNullSafe(F.col("_s")))
    role = F.when(F.col("scan_id") == F.col("_dynamic"), "dynamic").when(F.col("scan_id") == F.col("_anatomical"), "anatomical").otherwise("other")
    return joined.select(*[F.col(c) for c in scans.columns], role.alias("role"))


def exclude_subjects(rows: DataFrame, excluded: DataFrame) -> DataFrame:
    return rows.join(excluded, "subject_id", "left_anti").where(~F.col("subject_id").cast("string").startswith("."))


def completeness_report(present: DataFrame, expected: list[int]) -> DataFrame:
    """n_have, missing and complete of each subject against the expected axis values."""
    wanted = F.array(*[F.lit(x) for x in sorted(expected)])
    have = present.where(F.col("ti").isin(expected)).groupBy("subject_id").agg(F.collect_set("ti").alias("have"))
    every = present.select("subject_id").distinct().join(have, "subject_id", "left")
    have = F.coalesce("have", F.array().cast("array<int>"))
    missing = F.array_sort(F.array_except(wanted, have))
    return every.select("subject_id", F.size(have).alias("n_have"), missing.alias("missing"), (F.size(missing) == 0).alias("complete"))


def assemble_series(scans: DataFrame, *, least: int = 3, expected: int = 7, dynamic_index: int = 1) -> DataFrame:
    """Curves over the inversion time in the scans' names (TI_120 and the like), with n and complete (``expected`` or more).

    Phase, real and imaginary images are left out; the preferred source wins an inversion time. Where scans carry several dynamics
    (``values``), one is taken; where they carry their grid (``geom``), those unlike the subject's first are dropped.
    """
    ti = F.regexp_extract("name", r"TI[_\- ]?(\d{3,5})", 1)
    named = scans.where((ti != "") & ~F.lower("name").rlike(r"imag|phase|real|_ph\b")).withColumn("ti", ti.cast("int"))
    if "values" in scans.columns:
        named = named.withColumn("value", F.get("values", F.greatest(F.least(F.lit(dynamic_index), F.size("values") - 1), F.lit(0))))
    return _assemble(named, "ti", ["preference", "name"], least, expected).withColumn("axis_s", F.transform("axis", lambda t: t / 1000)).drop("axis")


def assemble_flip_series(scans: DataFrame, *, least: int = 2) -> DataFrame:
    """Curves over the flip angle of scans of one geometry (subject_id, voxel_id, flip_deg, geom, value), two angles or more."""
    return _assemble(scans.where(F.col("flip_deg").isNotNull()), "flip_deg", ["name"] if "name" in scans.columns else ["value"], least, least).withColumnRenamed("axis", "axis_deg").drop("complete")


def _assemble(named: DataFrame, axis: str, order: list[str], least: int, expected: int) -> DataFrame:
    """One value of each place on the axis, the first in order; grids unlike that of a subject's first place are dropped."""
    if "geom" in named.columns:
        first = named.groupBy("subject_id").agg(F.min_by("geom", F.struct(axis, *order)).alias("_geom"))
        named = named.join(small(first), "subject_id").where(F.col("geom").eqNullSafe(F.col("_geom")))
    one = named.groupBy("subject_id", "voxel_id", axis).agg(F.min_by("value", F.struct(*order)).alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct(F.col(axis).alias("at"), "value")))  # a place on the axis each
    found = one.groupBy("subject_id", "voxel_id").agg(ordered.alias("s"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return found.select("subject_id", "voxel_id", F.transform("s", lambda s: s["at"]).alias("axis"), F.transform("s", lambda s: s["value"]).alias("values"), "n", (F.col("n") >= expected).alias("complete"))


class CohortRun(NamedTuple):
    """What a cohort's run gives: summaries of maps, and how every subject fared."""

    maps: DataFrame
    report: DataFrame


def run_cohort(curves: DataFrame, priors: DataFrame, parcellation: DataFrame, region_map: DataFrame, *, flip_deg: float, tr_s: float, models: list[str], exclude: DataFrame | None = None, n_input: int = 32, window: int = 5) -> CohortRun:
    """All subjects from signal to region summaries in one job.

    curves (subject_id, voxel_id, signal, t_s), priors (t1_ms, m0), parcellation (label). Signals are converted, each
    subject's input curve is the mean of its voxels that peak highest, every model is fitted to every curve, and maps are
    reduced by region: ``maps`` has (subject_id, model, map, region, mean, median, sd, n).

    What fails fails alone. ``report`` has (subject_id, model, status, n_curves, n_failed, error) of every subject and model:
    status is ok, partial (some curves could not be fitted) or failed (none could, or none was left to fit), error
    one of the reasons. A failed subject's summaries have no numbers; those of the others are what they would be without it.
    Converted curves, input curves and fits are each computed once, in checkpoints.
    """
    from curvemill.operators import aggregate, aif, concentration
    from curvemill.operators.fitting import MODELS, fit_model

    key = ["subject_id", "voxel_id"]
    wanted = exclude_subjects(curves, exclude) if exclude is not None else curves
    converted = concentration.spgr_ratio(wanted.join(priors.select(*key, "t1_ms", "m0"), key), flip_deg=flip_deg, tr_s=tr_s).withColumn("values", F.col("conc")).drop("conc", "signal")
    labelled = checkpointed(converted.join(parcellation.select(*key, "label"), key))
    top = aif.top_peak(labelled, by=[], n=n_input, baseline=window)
    axis = labelled.groupBy("subject_id").agg(F.first("t_s").alias("t_s"))
    inputs = checkpointed(aif.curve_from_members(labelled, top.select(*key), by=[]).join(axis, "subject_id").select("subject_id", F.col("values").alias("c_a"), "t_s"))
    fits = None
    for model in models:
        numbers = F.array(*[F.struct(F.lit(n).alias("map"), F.col(n).cast("double").alias("value")) for n in MODELS[model].outputs])
        some = fit_model(labelled, inputs, model, keys=[*key, "label"], errors=True).select("subject_id", "label", F.lit(model).alias("model"), "error", numbers.alias("maps"))
        fits = some if fits is None else fits.unionByName(some)
    fits = checkpointed(fits)
    maps = aggregate.by_region(fits.select("subject_id", "label", "model", F.inline("maps")), region_map, keys=["subject_id", "model", "map"])
    asked = wanted.select("subject_id").distinct().crossJoin(F.broadcast(curves.sparkSession.createDataFrame([(m,) for m in models], "model string")))
    found = fits.groupBy("subject_id", "model").agg(F.count(F.lit(1)).alias("n_curves"), F.count("error").alias("n_failed"), F.min("error").alias("error"))
    n, failed = F.coalesce("n_curves", F.lit(0)), F.coalesce("n_failed", F.lit(0))
    status = F.when(failed == n, "failed").when(failed > 0, "partial").otherwise("ok")
    error = F.when(n == 0, "no curves left to fit").otherwise(F.col("error"))
    report = asked.join(found, ["subject_id", "model"], "left").select("subject_id", "model", status.alias("status"), n.alias("n_curves"), failed.alias("n_failed"), error.alias("error"))
    return CohortRun(maps.select("subject_id", "model", "map", "region", "mean", "median", "sd", "n"), report)
