"""Frames cut from their lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a frame of a few numbers a row is broadcast.
FEW = 100_000
#: Estimated bytes from which an estimate says nothing; one that is not known is less by one.
MOST_BYTES = 1 << 63


def checkpointed(df: DataFrame) -> DataFrame:
    """df cut from its lineage in the folder that spark.checkpoint.dir names; a temporary one only with a local master (tests)."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='curvemill-')}")
    held = df.checkpoint()
    # A checkpoint keeps the estimate of the plan that made it, and joins multiply estimates: over rounds the digits of the
    # number would double until they fill the driver. Beyond what any table can have, the rows are taken without it.
    plan = held._jdf.queryExecution().analyzed()
    if plan.stats().sizeInBytes() < MOST_BYTES:
        return held
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(plan.rdd(), plan.schema(), False), spark)


def small(df: DataFrame) -> DataFrame:
    """df computed once, in a checkpoint, and counted there: to be broadcast up to FEW rows, else joined as it is."""
    held = checkpointed(df)
    return F.broadcast(held) if held.count() <= FEW else held


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that spark.checkpoint.dir names, whose files go when the application ends; a temporary one only with a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{(folder or 'file://' + tempfile.gettempdir()).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(there)
    return path
