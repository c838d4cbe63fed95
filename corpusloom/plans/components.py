"""Connected components by alternating large-star and small-star rounds.

Each round is two aggregations and joins, after each of which the edges are written to the shared folder. A node with very
many neighbours (a component's root) goes by a broadcast join of at most a thousand such nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.plans.keys import join_per_key
from corpusloom.plans.shared import save, unsave


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, m, n): the least of u and its v, and how many there are."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(u, v) pairs of bigint -> (node, root) for every node of an edge; root is the least node reachable."""
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = save(e, "edges")
    state = _state(e)
    for _ in range(rounds if state[0] else 0):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = join_per_key(both, _least(both), "u", "n", 2 * state[0]).filter("v > u")
        large = save(large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "star")
        least = _least(large)
        small = join_per_key(large, least, "u", "n", large.count()).select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, save(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct(), "edges")
        unsave(before)
        unsave(large)
        now = _state(e)
        if now == state:
            break
        state = now
    else:
        if state[0]:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
