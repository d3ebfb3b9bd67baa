"""Sinks: maps at every level, and run records. A job that is repeated leaves its rows once.

Rows are written by partition, and a job replaces the partitions that it writes, when it commits: what it wrote before
goes, other partitions stay, and a job that dies half-way changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _replace(rows: DataFrame, path: str, by: list[str], fmt: str) -> None:
    # Rebalancing brings a partition's rows together and splits those of large partitions among tasks.
    balanced = rows.hint("rebalance", *[F.col(c) for c in by])
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(fmt).save(path)


def write_maps(maps: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """(subject_id, model, level, ...) maps, partitioned by the three; those that are there already are replaced."""
    _replace(maps, path, ["subject_id", "model", "level"], fmt)


def write_run_records(runs: DataFrame, path: str, *, run_id: str) -> None:
    """Records of one run, options and outputs as JSON, partitioned by stage and run; the same run's records of a stage are replaced."""
    wide = [f.name for f in runs.schema if f.dataType.typeName() in ("map", "struct", "array")]
    _replace(runs.withColumns({c: F.to_json(c) for c in wide}).withColumn("run_id", F.lit(run_id)), path, ["stage", "run_id"], "parquet")
