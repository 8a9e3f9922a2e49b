"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridspark.llm.common import materialize, release


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(node, root)`` for every node of an edge; root is the smallest node reached.

    Each step is a grouped minimum (combined on the map side) and an equi-join that AQE can split, so a node with
    very many neighbours is no task of its own. The loop ends when a round changes nothing; what is collected is
    two numbers a round. Self-loops and repeated edges are allowed; a null end drops the edge.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.join(low, "a")
        if large:
            out = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def tally(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())

    now = materialize(edges.select("a", "b").dropna().where("a <> b").distinct(), "edges")
    nodes = now.select(F.col("a").alias("node")).unionByName(now.select(F.col("b").alias("node")))
    first, seen = now, tally(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        nxt = materialize(star(star(now, True), False), "edges")
        if now is not first:
            release(now)
        now, new = nxt, tally(nxt)
        if new == seen:
            break
        seen = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
