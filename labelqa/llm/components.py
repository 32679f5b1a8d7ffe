"""Connected components of an edge table, by alternating star contractions.

Each round points every node's larger neighbours at the smallest one, first
over all neighbours and then over the smaller ones only, until nothing moves.
Rounds grow with the logarithm of the longest path. Every round is written to
the shared folder, so its lineage is one read. Hubs are met by partial
aggregates and a join whose large side Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


def _nearest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        far = both.join(_nearest(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = both.where("b < a")
        far = down.join(_nearest(down), "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return far.where("a <> b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(a, b)`` of comparable ids, null-free -> ``(node, root)`` for each
    node that has an edge; root is the smallest id of the component."""
    now = store(edges.select("a", "b").where("a <> b").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if not mark["n"] or mark == seen:
            break
        seen = mark
        now = store(_star(_star(now, large=True), large=False), "edges")
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())
