"""Connected components as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curvemill.llm.scratch import written

#: Rounds after which something must be wrong: they grow with the logarithm of the longest path.
MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _unsettled(edges: DataFrame) -> int:
    """How many nodes of the edges (u > v) have two smaller neighbours, or smaller and larger ones.

    If none has, the v of every u is the least node of its component.
    """
    ends = F.array(*[F.struct(F.col(x).alias("node"), F.lit(x == "u").cast("long").alias("down"), F.lit(x == "v").alias("up")) for x in "uv"])
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.agg(F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & F.col("up")))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected edges (u, v); component is the least node reachable.

    Alternates large-star and small-star rounds, each written to the shared folder, until the edges are stars around
    least nodes; edges that are so from the start take no round. Every round combines before it shuffles and joins a
    node's edges to one row of its own, so a node with very many edges is a skewed equi-join that adaptive execution
    splits. Nodes of any orderable type; null ends and loops are ignored; no edges give an empty result.
    """
    known = edges.where("u is not null and v is not null and u <> v")
    edges = written(known.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-edges")
    rounds = 0
    while _unsettled(edges):
        if rounds == MAX_ROUNDS:
            raise RuntimeError("components did not settle")
        edges = written(_small_star(_large_star(edges)), "cc-round")
        rounds += 1
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
