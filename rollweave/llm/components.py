"""Connected components by alternating large-star and small-star steps, all as joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Scratch, deal_join

MOST_ROUNDS = 50


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """edges: (a, b) of any sortable type. Returns (node, root), one row for each node of an edge; root is the least node it reaches.

    The joins are told to merge: in a loop, a broadcast for each join of each round would fill the driver. Their sides are dealt anew, so that a hub's edges can be
    split. Every round is written to the shared folder; the number of rounds is logarithmic in the longest chain. Null nodes aren't supported; repeated edges and loops don't matter.
    """
    now = scratch.put(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    sign = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    before = now.agg(F.count("*"), sign).first()
    for k in range(1, MOST_ROUNDS + 1):
        if not before[0]:
            break
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = deal_join(both.where("y > x"), least, ["x"]).select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = deal_join(large, low, ["u"])
        small = small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        after_table = scratch.put(small, f"{name}-{k}")
        after = after_table.agg(F.count("*"), sign).first()
        scratch.drop(f"{name}-{k - 1}")
        now = after_table
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components didn't settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
