"""Incremental ingest: new curve files are converted once, as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def convert_new(spark: SparkSession, source: str, target: str, checkpoint: str, convert: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Run ``convert`` over the Parquet curve files in ``source`` that earlier runs have not seen, and append to ``target``.

    All that is there is processed in one go (available now); the checkpoint folder must be one that all executors share.
    """
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)
    return convert(stream).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
