"""Connected components over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Star contraction: in turn every node hangs its larger neighbours, then its smaller ones, on
    its smallest neighbour; the number of rounds grows with the logarithm of the longest chain.
    Each round is written to the shared folder. Edges with a null end are no edges.
    An empty table gives an empty table.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut_lineage(now)
    seen = None
    for _ in range(most_rounds):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = large.union(low.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        down = kept.groupBy("a").agg(F.min("b").alias("m"))
        small = kept.join(down, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = cut_lineage(small.union(down.select("a", F.col("m").alias("b"))).distinct())
        stamp = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if stamp == seen:
            break
        seen = stamp
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    down = now.groupBy("a").agg(F.min("b").alias("component"))
    roots = down.select("component").distinct().select(F.col("component").alias("node"), "component")
    return down.select(F.col("a").alias("node"), "component").union(roots)
