"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one where it is unset and the master is local (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + os.path.join(tempfile.gettempdir(), "curvemill-checkpoints")
    return path.rstrip("/")


#: Paths of the tables written inside a scope, by application and scope.
_SCOPED: dict[tuple[str, str], list[str]] = {}
_scope: ContextVar[str | None] = ContextVar("scope", default=None)
#: After so many tables of a scope the driver's garbage is collected.
TIDY_EVERY = 6
_tables: dict[tuple[str, str], int] = {}


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage.

    A row of short jobs leaves plans, broadcasts and shuffles that are done. The driver's heap grows with them and is given
    back only by a full collection; Spark's cleaner waits for collections too.
    """
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def scope(name: str) -> Iterator[None]:
    """Tables written inside belong to the scope, until ``release`` removes them."""
    token = _scope.set(name)
    try:
        yield
    finally:
        _scope.reset(token)


def release(name: str, *needed: DataFrame) -> None:
    """Remove the scope's tables that none of the frames still reads."""
    for df in needed:
        spark = df.sparkSession
        paths = _SCOPED.get((spark.sparkContext.applicationId, name), [])
        read = {f.rsplit("/", 2)[-2] for f in df.inputFiles()} if paths else set()
        for path in [p for p in paths if p.rsplit("/", 1)[-1] not in read]:
            hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
            hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
            paths.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back.

    It cuts lineage, survives the loss of executors and is computed once however often it is used.
    The files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scope.get():
        mine = (spark.sparkContext.applicationId, _scope.get())
        _SCOPED.setdefault(mine, []).append(path)
        _tables[mine] = _tables.get(mine, 0) + 1
        if _tables[mine] % TIDY_EVERY == 0:
            tidy(spark)
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return spark.read.schema(df.schema).parquet(path)
