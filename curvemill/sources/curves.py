"""Curve tables: one row a curve, (subject_id, voxel_id, ..., values ARRAY<DOUBLE>)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DT = 2.463


def subjects(*tables: DataFrame) -> list[str]:
    """The column that tells subjects apart, where all the tables have it: voxel and label ids are a subject's own."""
    return ["subject_id"] if all("subject_id" in t.columns for t in tables) else []


def read_curves(spark: SparkSession, path: str, *, values: str = "values") -> DataFrame:
    """Parquet curves; a scalar column becomes a curve of one value."""
    df = spark.read.parquet(path)
    kind = df.schema[values].dataType.simpleString()
    return df.withColumn(values, F.col(values).cast("array<double>") if kind.startswith("array") else F.array(F.col(values).cast("double")))


def from_dense(volumes: DataFrame, nx: int, ny: int) -> DataFrame:
    """One row a volume (subject_id, frames ARRAY<ARRAY<DOUBLE>>: a frame's voxels in x, y, z order) -> one row a voxel."""
    each = volumes.select("subject_id", F.posexplode(F.arrays_zip(*[F.col("frames")])).alias("frame", "f"))
    long = each.select("subject_id", "frame", F.posexplode("f.frames").alias("voxel_id", "value"))
    v = F.col("voxel_id")
    return to_curves(long, ["subject_id", "voxel_id"]).withColumns({"x": v % nx, "y": F.floor(v / nx).cast("int") % ny, "z": F.floor(v / (nx * ny)).cast("int")})


def to_long(curves: DataFrame, *keys: str, values: str = "values") -> DataFrame:
    """(keys, frame, value), for operators that group over voxels frame by frame."""
    return curves.select(*keys, F.posexplode(values).alias("frame", "value"))


def to_curves(long: DataFrame, keys: list[str]) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("frame", "value")))
    return long.groupBy(*keys).agg(F.transform(ordered, lambda s: s["value"]).alias("values"))


def embedding_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's embeddings as curves: voxel_id, x, y, z, label (1-10), values, signal (positive), t1_ms, m0."""
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    v = F.col("vec_id")
    return e.select(
        v.alias("voxel_id"),
        (v % 16).cast("int").alias("x"),
        (F.floor(v / 16) % 16).cast("int").alias("y"),
        F.floor(v / 256).cast("int").alias("z"),
        (F.col("label") + 1).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("values"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: 100 * (1 + x)).alias("signal"),
        (800 + 10 * (v % 100)).cast("double").alias("t1_ms"),
        (1000 + v % 50).cast("double").alias("m0"),
    )


def cohort_curves(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    """The same curves dealt to n subjects, whose voxel ids are their own and overlap."""
    c = embedding_curves(spark, sf_dir)
    v = F.col("voxel_id")
    place = {"subject_id": F.concat(F.lit("s"), (v % n).cast("string")), "voxel_id": F.floor(v / n)}
    own = c.withColumns(place)
    return own.withColumns({"x": (F.col("voxel_id") % 8).cast("int"), "y": (F.floor(F.col("voxel_id") / 8) % 8).cast("int"), "z": F.floor(F.col("voxel_id") / 64).cast("int")})


def input_curve(curves: DataFrame) -> DataFrame:
    """c_a, 1 + the mean curve of all voxels, and its time axis t_s: one row, or one a subject."""
    by = subjects(curves)
    mean = to_long(curves, *by).groupBy(*by, "frame").agg((1 + F.avg("value")).alias("value"))
    row = to_curves(mean.withColumn("one", F.lit(1)), [*by, "one"])
    return row.select(*by, F.col("values").alias("c_a"), F.transform("values", lambda v, i: i * F.lit(DT)).alias("t_s"))
