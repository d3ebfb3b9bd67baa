"""Headers of series: axes, gradients, priors and parcellations as columns."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curvemill.functions.tables import checkpointed

#: Keys of header files that tell a series' axis.
HEADER = "n int, InversionTimes array<double>, FlipAngles array<double>, RepetitionTime double, RepetitionTimeExcitation double, TimePoints array<double>, dt double"


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """One row a JSON header file, with the keys that tell its axis and the file's path."""
    return spark.read.schema(HEADER).option("multiLine", True).json(path).withColumn("path", F.input_file_name())


def axis_of(headers: DataFrame) -> DataFrame:
    """axis_kind and axis of a series with n and any of the columns of HEADER (null or missing where absent).

    One value is static; then inversion times, flip angles, and a repetition time, which makes it time: the time points, else frame
    numbers. Without any of these it is time too. An axis of time that starts at 0 is i * dt where dt is positive.
    """
    has = lambda c, t: F.col(c) if c in headers.columns else F.lit(None).cast(t)
    ti, fa, points = (has(c, "array<double>") for c in ("InversionTimes", "FlipAngles", "TimePoints"))
    dt = F.coalesce(has("dt", "double"), F.lit(0.0))
    frames = F.transform(F.sequence(F.lit(0), F.greatest(F.col("n"), F.lit(1)) - 1), lambda i: i.cast("double"))
    kind = F.when(F.col("n") <= 1, "static").when(ti.isNotNull(), "ti").when(fa.isNotNull(), "fa").otherwise("time")
    given = F.coalesce(points, frames)
    timed = F.when((F.get(given, F.lit(0)) == 0) & (dt > 0), F.transform(given, lambda v, i: i * dt)).otherwise(given)
    axis = F.when(kind == "static", F.array(F.lit(0.0))).when(kind == "ti", ti).when(kind == "fa", fa).otherwise(timed)
    return headers.withColumns({"axis_kind": kind, "axis": axis})


def unit_gradients(gradients: DataFrame) -> DataFrame:
    """Directions of length 1; near-zero ones stay as they are."""
    norm = F.sqrt(F.col("gx") ** 2 + F.col("gy") ** 2 + F.col("gz") ** 2)
    length = F.when(norm < 1e-12, F.lit(1.0)).otherwise(norm)
    return gradients.withColumns({c: F.col(c) / length for c in ("gx", "gy", "gz")})


def read_gradients(bvals: DataFrame, bvecs: DataFrame, *, frames: DataFrame | None = None) -> DataFrame:
    """(subject_id, dir, bval, gx, gy, gz) of unit length from bvals (subject_id, values) and bvecs (subject_id, rows: 3 x N or N x 3).

    Subjects whose lengths differ, or differ from their series' ``frames`` (subject_id, n), are left out.
    """
    n, inner = F.size("values"), F.size(F.get("rows", F.lit(0)))
    across = (F.size("rows") == 3) & (inner == n)
    joined = bvals.join(bvecs, "subject_id").where(across | ((F.size("rows") == n) & (inner == 3)))
    if frames is not None:
        joined = joined.join(frames, "subject_id").where(F.col("n") == n)
    part = lambda k: F.when(across, F.get(F.get("rows", F.lit(k)), F.col("dir"))).otherwise(F.get(F.get("rows", F.col("dir")), F.lit(k)))
    each = joined.select("subject_id", "rows", "values", F.posexplode("values").alias("dir", "bval"))
    return unit_gradients(each.select("subject_id", "dir", "bval", *[part(k).alias(f"g{a}") for k, a in enumerate("xyz")]))


class GradientFiles(NamedTuple):
    """Gradient tables read from files, and the files that gave none."""

    gradients: DataFrame
    rejects: DataFrame


#: The subject and the kind of a gradient file, from its path: <subject>.bval and <subject>.bvec, also with an s.
GRADIENT_FILE = r"([^/]+)\.(bval|bvec)s?$"


#: What opening a file counts as, in bytes, where files hold a few numbers each; Spark's 4 MB make tasks of a few files.
OPEN_BYTES = 1 << 16


@contextmanager
def _small_files(spark: SparkSession) -> Iterator[None]:
    """Folders listed and scans planned inside take many of them a task."""
    conf = {"spark.sql.files.openCostInBytes": OPEN_BYTES, "spark.sql.sources.parallelPartitionDiscovery.parallelism": 4 * spark.sparkContext.defaultParallelism}
    kept = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, str(v))
        yield
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def read_gradient_files(spark: SparkSession, path: str | list[str], *, pattern: str = GRADIENT_FILE, frames: DataFrame | None = None) -> GradientFiles:
    """Gradients (subject_id, dir, bval, gx, gy, gz) of pairs of text files of b-values and directions, and (path, subject_id, reason) of rejected ones.

    ``pattern`` finds the subject (group 1) and bval or bvec (group 2) in a file's path. Numbers stand apart by blanks or
    commas; b-values are one row or one column, directions 3 x N or N x 3 (3 x 3 is read by rows as x, y, z). A file is rejected that
    is named otherwise, is empty, has something that is no number or rows of unequal length, has no partner or more than one, or
    differs in length from its partner or from the series' ``frames`` (subject_id, n). Other subjects are read all the same.
    A folder is listed with all folders below it, by the executors where there are many; a pattern like ``*/*.bval`` is resolved
    by the driver, one folder after another.
    """
    with _small_files(spark):
        read = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    texts = read.select(F.col("_metadata.file_path").alias("path"), "value")
    lines = F.filter(F.transform(F.split("value", r"\r\n|\r|\n"), lambda x: F.btrim(x)), lambda x: x != "")
    rows = F.transform(lines, lambda x: F.transform(F.split(x, r"[\s,]+"), lambda y: y.try_cast("double")))
    files = texts.select("path", F.regexp_extract("path", pattern, 1).alias("subject_id"), F.regexp_extract("path", pattern, 2).alias("kind"), rows.alias("rows"))
    flat = F.flatten("rows")
    ragged = F.exists("rows", lambda r: F.size(r) != F.size(F.get("rows", F.lit(0))))
    wrong = F.when(F.col("kind") == "", "not a gradient file's name").when(F.size("rows") == 0, "empty").when(F.exists(flat, lambda v: v.isNull() | F.isnan(v)), "not a number").when(ragged, "rows of unequal length")
    with _small_files(spark):
        files = checkpointed(files.withColumn("reason", wrong))
    good = files.where("reason is null")
    # Few files a subject: partners are counted before they are joined.
    pairs = good.groupBy("subject_id").agg(
        F.count_if(F.col("kind") == "bval").alias("_b"), F.count_if(F.col("kind") == "bvec").alias("_v"), F.max(F.when(F.col("kind") == "bval", F.flatten("rows"))).alias("values"), F.max(F.when(F.col("kind") == "bvec", F.col("rows"))).alias("rows")
    )
    n, inner = F.size("values"), F.size(F.get("rows", F.lit(0)))
    fits = ((F.size("rows") == 3) & (inner == n)) | ((F.size("rows") == n) & (inner == 3))
    why = F.when((F.col("_b") == 0) | (F.col("_v") == 0), "no partner").when((F.col("_b") > 1) | (F.col("_v") > 1), "more than one partner").when(~fits, "lengths differ")
    if frames is not None:
        pairs = pairs.join(frames.select("subject_id", F.col("n").alias("_n")), "subject_id", "left")
        why = why.when(F.col("_n").isNull() | (F.col("_n") != n), "not as long as the series")
    pairs = pairs.withColumn("why", why)
    whole = pairs.where("why is null")
    gradients = read_gradients(whole.select("subject_id", "values"), whole.select("subject_id", "rows"))
    unpaired = good.select("path", "subject_id").join(pairs.where("why is not null").select("subject_id", F.col("why").alias("reason")), "subject_id").select("path", "subject_id", "reason")
    return GradientFiles(gradients, files.where("reason is not null").select("path", "subject_id", "reason").unionByName(unpaired))


def shells(gradients: DataFrame) -> DataFrame:
    """n_b0 and the distinct b-values, rounded to tens, of each subject."""
    return gradients.groupBy("subject_id").agg(F.count_if(F.col("bval") <= 50).alias("n_b0"), F.array_sort(F.collect_set(F.bround("bval", -1))).alias("shells"))


def prior_ms(t1: Column, unit: Column) -> Column:
    """T1 in milliseconds."""
    return F.when(F.lower(unit).isin("s", "sec", "seconds"), t1 * 1000).otherwise(t1)


def read_parcellation(voxels: DataFrame, names: DataFrame, *, include: list[int] | None = None) -> DataFrame:
    """voxels (voxel_id, label) with labels outside ``include`` set to 0, and each label's name, label_<id> where it has none."""
    from curvemill.operators.labels import label_names, restrict_labels

    return label_names(restrict_labels(voxels, include), names)


def read_input_curve(inputs: DataFrame) -> DataFrame:
    """inputs (c_a, t_s) cut to their common length."""
    n = F.least(F.size("c_a"), F.size("t_s"))
    return inputs.withColumns({c: F.slice(c, F.lit(1), n) for c in ("c_a", "t_s")})
