"""Connected components of a link table, by alternating large-star and small-star steps.

Each step reduces by partial aggregation and one join whose skewed side adaptive execution can
split; a node with very many links is never gathered. Every few steps the links are written to the
shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the smallest of its neighbours and
    itself. Small star: the node and its smaller neighbours are."""
    if large:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    linked = both.join(lowest, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """``edges(src, dst)`` to ``node, root``: every node that has a link, with the smallest node
    of its component."""
    now = edges.where("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct()
    before = None
    for _ in range(max_steps):
        now = stored(_star(_star(now, large=True), large=False), "components")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)
