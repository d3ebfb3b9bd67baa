"""Exact percentiles of groups of any size.

A group's percentile by Spark's aggregate keeps all its distinct values in one task. Groups are counted first; those of up to
``GROUP_ROWS`` rows go that way. In larger ones a percentile's rank is searched: a histogram between the group's ends finds the
bin that holds the rank, the bin's own ends are the next histogram's, and once few rows are left in it they are sorted.
Histograms are combined before every shuffle, so no task holds more than bins or ``GROUP_ROWS`` values of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curvemill.functions.arrays import finite
from curvemill.functions.tables import FEW

GROUP_ROWS = 1_000_000
BINS = 4096
#: Each round divides a rank's range of values by BINS, so that doubles of any size are told apart long before.
MOST_ROUNDS = 200


def percentiles(df: DataFrame, *, by: Sequence[str], column: str = "value", at: dict[str, float], group_rows: int | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """by, and for each name in ``at`` the linearly interpolated percentile (0-1) of the finite values of column; null if there are none.

    ``sizes`` (by, _n, _lo, _hi: the number, least and greatest of a group's finite values) saves the pass that counts.
    """
    limit = GROUP_ROWS if group_rows is None else group_rows
    by = list(by)
    v = finite(F.col(column).cast("double"))
    values = df.select(*by, v.alias("_v"))
    if sizes is None:
        sizes = values.groupBy(*by).agg(F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    big = sizes.select(*by, "_n", "_lo", "_hi").where(F.col("_n") > limit)
    names, shares = list(at), [float(x) for x in at.values()]

    def plain(rows: DataFrame) -> DataFrame:
        found = rows.groupBy(*by).agg(F.percentile("_v", F.array(*[F.lit(x) for x in shares])).alias("_p"))
        return found.select(*by, *[F.get("_p", F.lit(i)).alias(n) for i, n in enumerate(names)])

    if not big.limit(1).count():
        return plain(values)
    # What is joined from here on has at most two rows for a large group and share.
    big = _kept(big)
    few = 2 * len(shares) * big.count() <= FEW
    inside = _meet(values.where("_v is not null"), big, by, few)
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(q) * (F.col("_n") - 1)).alias("at")) for i, q in enumerate(shares)])
    ends = big.select(*by, "_n", "_lo", "_hi", F.explode(ranks).alias("_r"))
    ends = ends.select(*by, "_lo", "_hi", "_n", F.col("_r.i").alias("_i"), F.col("_r.at").alias("_at"), F.explode(F.array_distinct(F.array(F.floor("_r.at"), F.ceil("_r.at")))).alias("_k"))
    wanted = _kept(ends.select(*by, "_k", "_lo", "_hi", F.col("_k").alias("_left"), F.col("_n").alias("_m")).distinct())
    for _ in range(MOST_ROUNDS):
        if not wanted.where((F.col("_m") > limit) & (F.col("_lo") < F.col("_hi"))).limit(1).count():
            break
        wanted = _kept(_narrowed(inside.select(*by, "_v"), wanted, by, limit, few))
    else:
        raise RuntimeError("ranks did not settle")
    open_ = wanted.where("_lo < _hi")
    rows = _meet(inside.select(*by, "_v"), open_, by, few).where("_v between _lo and _hi")
    found = rows.groupBy(*by, "_k", "_left").agg(F.sort_array(F.collect_list("_v")).alias("_s")).select(*by, "_k", F.get("_s", F.col("_left").cast("int")).alias("_x"))
    found = found.unionByName(wanted.where("_lo = _hi").select(*by, "_k", F.col("_lo").alias("_x")))
    points = _meet(found, ends.select(*by, F.col("_k").alias("_kk"), "_i", "_at"), by, few).where("_k = _kk")
    each = points.groupBy(*by, "_i", "_at").agg(F.min(F.struct("_k", "_x")).alias("a"), F.max(F.struct("_k", "_x")).alias("b"))
    each = each.select(*by, "_i", (F.col("a._x") + (F.col("b._x") - F.col("a._x")) * (F.col("_at") - F.col("a._k"))).alias("_p"))
    large = each.groupBy(*by).agg(*[F.max(F.when(F.col("_i") == i, F.col("_p"))).alias(n) for i, n in enumerate(names)])
    return plain(_meet(values, big, by, few, "left_anti")).unionByName(large) if by else large


def _meet(rows: DataFrame, ranks: DataFrame, by: list[str], few: bool, how: str = "inner") -> DataFrame:
    """rows joined on by (nulls are equal) with the rows of large groups, which are broadcast where they are few, or without those of large groups."""
    condition = F.lit(True)
    for c in by:
        condition = condition & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    other = (F.broadcast(ranks) if few else ranks).alias("b")
    both = rows.alias("a").join(other, condition, how) if by else rows.alias("a").crossJoin(other)  # without by, one group
    return both if how == "left_anti" else both.select("a.*", *[F.col(f"b.{c}") for c in ranks.columns if c not in by])


def _narrowed(values: DataFrame, wanted: DataFrame, by: list[str], limit: int, few: bool) -> DataFrame:
    """The wanted ranks with the ends, the remaining rank and the size of the bin that holds them."""
    done = (F.col("_m") <= limit) | (F.col("_lo") >= F.col("_hi"))
    rows = _meet(values, wanted.where(~done), by, few).where("_v between _lo and _hi")
    # Half of each end, so that the width of the widest range is still a number.
    share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
    bins = rows.withColumn("_bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
    counted = bins.groupBy(*by, "_k", "_left", "_bin").agg(F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    before = F.coalesce(F.sum("_m").over(Window.partitionBy(*by, "_k").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = counted.withColumn("_before", before).where((F.col("_left") >= F.col("_before")) & (F.col("_left") < F.col("_before") + F.col("_m")))
    return held.select(*by, "_k", "_lo", "_hi", (F.col("_left") - F.col("_before")).alias("_left"), "_m").unionByName(wanted.where(done).select(*by, "_k", "_lo", "_hi", "_left", "_m"))


def _kept(df: DataFrame) -> DataFrame:
    from curvemill.operators.labels import checkpointed

    return checkpointed(df)


def median(df: DataFrame, *, by: Sequence[str], column: str = "value", name: str = "median", group_rows: int | None = None) -> DataFrame:
    return percentiles(df, by=by, column=column, at={name: 0.5}, group_rows=group_rows)
