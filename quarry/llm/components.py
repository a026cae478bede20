"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import join_counted
from quarry.session import materialize


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the smallest node reachable.

    Alternating large-star and small-star steps: each node's neighbours are tied to the least one, so
    the links stay as many and paths shrink by half a round.  Each step is one sum, written, and one join by
    node, in which the links of hot nodes do not shuffle.  Ends when no link changes.
    """
    links = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for k in range(rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("k"))
                            .select("a", F.least("a", "m").alias("m"), "k"), f"least-{k}")
        # Large star: larger neighbours go to the least of the neighbourhood.
        large = join_counted(both.filter("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.filter("a <> b").distinct(), f"large-stars-{k}")
        # Small star: smaller neighbours and the node itself go to the least of them.
        small = materialize(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("k")), f"small-stars-{k}")
        joined = join_counted(large, small, ["a"])
        star = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        links = materialize(star.filter("a <> b").distinct(), f"stars-{k}")
        # Equal numbers and equal sums of a hash of the links: nothing has changed.
        now = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == before or not now["n"]:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
