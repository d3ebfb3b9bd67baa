"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded shuffle, repeated up to ``max_repeats`` times. A copy's
virtual finish time is the number of tokens its queue has served up to its end, divided by the source's
weight. Serving copies by finish time and stopping at the total budget gives each source its share by weight;
a source whose copies run out leaves its share to the others, again by weight.

``mix`` range-sorts the copies by finish time and ends them at the budget. ``mix_plan`` needs only the last finish
time served: finish times are counted in ranges, and the range where the budget ends is the one that is sorted. Blocks of a
source and ranges of time grow with the rows, so no task sorts more than a set number of them.

Defined results: a null text has size 0 and is never taken; a null source is a source of its own, last in
order; rows that are equal in all columns are interchangeable; an empty table gives an empty result. Extra
columns are carried by ``mix`` and ignored by ``mix_plan``; working columns carry the prefix ``_wfq_``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curvemill.llm import text as T
from curvemill.llm.scratch import written

#: Ranges of finish time up to the expected end, at least; later ones are ranges of its logarithm.
RANGES = 4096
#: Rows of a block of a source's queue, or of a range of finish times, on average at most.
BLOCK_ROWS = 100_000


def _key(source: Column) -> Column:
    """A source as a string that is never null; 't...' < 'u' keeps the null source last."""
    return F.when(source.isNull(), F.lit("u")).otherwise(F.concat(F.lit("t"), source.cast("string")))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int, share: float) -> DataFrame:
    """Target tokens of each source: shares by weight, at most max_repeats times the source's own size.

    ``sizes`` has one row a source (_wfq_key, source_size). Sources are filled together in proportion to
    their weights; the level at which the budget is used up is found in closed form over the sources
    in the order in which they reach their cap.
    """
    by_name = Window.orderBy("_wfq_key")
    w = F.array(*[F.lit(float(x)) for x in weights])
    rows = (
        sizes.withColumn("_wfq_n", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(w, ((F.col("_wfq_n") - 1) % len(weights) + 1).cast("int")))
        .withColumn("_wfq_cap", F.col("source_size") * float(max_repeats))
        .withColumn("_wfq_full", F.col("_wfq_cap") / F.col("weight"))
    )
    order = Window.orderBy("_wfq_full", "_wfq_key")
    everything = Window.partitionBy()
    filled = rows.withColumn("_wfq_total", F.sum("source_size").over(everything) * float(share)).withColumn(
        "_wfq_level",
        (F.col("_wfq_total") - F.coalesce(F.sum("_wfq_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
    )
    level = F.min(F.when(F.col("_wfq_level") <= F.col("_wfq_full"), F.struct("_wfq_full", "_wfq_key", "_wfq_level"))).over(everything)
    return filled.withColumn("level", F.coalesce(level["_wfq_level"], F.lit(float("inf")))).select(
        "_wfq_key", "source_size", "weight", "level", F.least("_wfq_cap", F.col("weight") * F.col("level")).alias("target")
    )


def _shuffle_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def _finish(repeat: Column | int) -> Column:
    return (repeat * F.col("source_size") + F.col("_wfq_cum")) / F.col("weight")


def _cutoff(queued: DataFrame, budget: float, level: float, max_repeats: int, ranges_upto: int = RANGES) -> float:
    """The last finish time served: copies up to it, ties included, hold at most the budget.

    Finish times are dealt into ranges; the running total over the ranges shows the one where the budget
    ends, and only that range is sorted.
    """
    served = (
        queued.where("size > 0")
        .select("size", "source_size", "weight", "_wfq_cum", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("_wfq_e"))
        .select("size", _finish(F.col("_wfq_e")).alias("f"))
    )
    x = F.col("f") / F.lit(level)
    served = served.withColumn("r", F.when(x <= 1, F.floor(x * ranges_upto)).otherwise(ranges_upto + F.floor(F.log2(x) * ranges_upto / 4)).cast("long"))
    ranges = served.groupBy("r").agg(F.sum("size").alias("n"))
    up_to = ranges.select("r", "n", F.sum("n").over(Window.orderBy("r")).alias("upto"))
    last = up_to.where(F.col("upto") > budget).agg(F.min(F.struct("r", (F.col("upto") - F.col("n")).alias("before"))).alias("x")).first()["x"]
    if last is None:
        return float("inf")
    inside = served.where(F.col("r") == last["r"]).select("f", F.sum("size").over(Window.partitionBy("r").orderBy("f")).alias("upto"))
    end = inside.where(F.col("upto") + last["before"] <= budget).agg(F.max("f")).first()[0]
    if end is not None:
        return end
    return served.where(F.col("r") < last["r"]).agg(F.coalesce(F.max("f"), F.lit(-1.0))).first()[0]


def mix_plan(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    max_repeats: int = 3,
    share: float = 1.0,
    seed: int = 42,
    keep: Sequence[str] = ("doc_id",),
    key: bool = False,
) -> DataFrame:
    """One row for each document: what the mix takes of it.

    Columns: those in ``keep``, size, source_size, weight, target (its source's), repeats (whole copies taken),
    taken (repeats * size) and first_finish (virtual finish time of the first copy); with ``key``, also the shuffle
    key and the source's key. Sources are ordered by
    code point, null last, and get ``weights`` in turn. The order within a source is that of a seeded hash of
    the document's id and text, so reruns agree. A source that holds most rows is dealt over blocks of that
    hash: blocks are summed first, then each block runs its own total.
    """
    keep = list(keep)
    base = docs.select(
        *[F.col(c).alias(f"_wfq_k{i}") for i, c in enumerate(keep)],
        _key(F.col("source")).alias("_wfq_key"),
        T.n_words(F.col("text")).alias("size"),
        _shuffle_key(seed).alias("_wfq_r"),
    )
    base = written(base, "mix-sizes")
    n = base.count()
    bits = min(30, max(10, (n // BLOCK_ROWS).bit_length()))
    base = base.withColumn("_wfq_b", F.shiftright("_wfq_r", 64 - bits))
    blocks = base.groupBy("_wfq_key", "_wfq_b").agg(F.sum("size").alias("_wfq_block"))
    targets = source_targets(blocks.groupBy("_wfq_key").agg(F.sum("_wfq_block").alias("source_size")), weights, max_repeats, share)
    targets = written(targets, "mix-targets")
    totals = targets.agg(F.sum("source_size").alias("n"), F.max("level").alias("level")).first()
    before = Window.partitionBy("_wfq_key").orderBy("_wfq_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("_wfq_key", "_wfq_b", F.coalesce(F.sum("_wfq_block").over(before), F.lit(0)).alias("_wfq_start")).join(targets, "_wfq_key")
    within = Window.partitionBy("_wfq_key", "_wfq_b").orderBy("_wfq_r", *[f"_wfq_k{i}" for i in range(len(keep))]).rowsBetween(Window.unboundedPreceding, 0)
    queued = base.join(starts, ["_wfq_key", "_wfq_b"]).withColumn("_wfq_cum", F.col("_wfq_start") + F.sum("size").over(within))
    queued = written(queued, "mix-queues")
    total = (totals["n"] or 0) * share
    end = _cutoff(queued, total, totals["level"], max_repeats, max(RANGES, n * max_repeats // BLOCK_ROWS)) if total > 0 else -1.0
    repeats = sum((F.when(_finish(e) <= F.lit(end), 1).otherwise(0) for e in range(max_repeats)), F.lit(0))
    return queued.withColumn("repeats", F.when(F.col("size") > 0, repeats).otherwise(0)).select(
        *[F.col(f"_wfq_k{i}").alias(c) for i, c in enumerate(keep)],
        "size",
        "source_size",
        "weight",
        "target",
        "repeats",
        (F.col("repeats") * F.col("size")).cast("long").alias("taken"),
        _finish(0).alias("first_finish"),
        *[c for c in ("_wfq_r", "_wfq_key") if key],
    )


def mix(docs: DataFrame, *, seed: int = 42, max_repeats: int = 3, **options) -> DataFrame:
    """The mix itself: a row for each copy served, range-sorted by virtual finish time, with the columns of docs.

    The plan is made of ids and sizes only; texts move once to meet it and once in the final sort.
    """
    columns = docs.columns
    plan = mix_plan(docs, seed=seed, max_repeats=max_repeats, keep=("doc_id",), key=True, **options)
    same = Window.partitionBy("_wfq_id", "_wfq_r")
    chosen = plan.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_wfq_id"), "_wfq_r", "_wfq_key", "repeats", "first_finish",
        (F.col("source_size") / F.col("weight")).alias("_wfq_round"),
    ).withColumn("_wfq_n", F.row_number().over(same.orderBy("_wfq_key", "first_finish"))).where("repeats > 0")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_wfq_id"), _shuffle_key(seed).alias("_wfq_r"), _key(F.col("source")).alias("_wfq_key"), *columns
    ).withColumn("_wfq_n", F.row_number().over(same.orderBy("_wfq_key")))
    copies = rows.join(chosen.drop("_wfq_key"), ["_wfq_id", "_wfq_r", "_wfq_n"]).withColumn("_wfq_e", F.explode(F.sequence(F.lit(0), F.col("repeats") - 1)))
    copies = copies.withColumn("_wfq_f", F.col("first_finish") + F.col("_wfq_e") * F.col("_wfq_round"))
    return copies.orderBy("_wfq_f", "_wfq_key", "_wfq_id", "_wfq_e").select(*columns)


def op3_weighted_fair_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken")
