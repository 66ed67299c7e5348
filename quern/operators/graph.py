"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


#: A vertex with more neighbours than this, and than a 10,000th of all edges, is joined by broadcast.
HUB = 1_000


def _with_low(rows: DataFrame, low: DataFrame, edges: int) -> DataFrame:
    """rows(u, v) with the m of their u. The rows of a hub would make one task large; there are fewer than 10,000 hubs,
    so what is known of them is broadcast and their rows stay where they are."""
    hub = F.col("n") > max(HUB, edges // 10_000)
    hubs = F.broadcast(low.where(hub).select("u", "m"))
    return rows.join(hubs, "u").unionByName(rows.join(hubs.select("u"), "u", "left_anti").join(low.where(~hub).select("u", "m"), "u"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges(a, b); component is the smallest id reachable.

    Every round is two aggregations (pre-summed before their shuffle, so a hub with many neighbours is no hot key)
    and two joins; rounds grow with the logarithm of the longest path and go on until nothing changes. Each round is a
    staged table.
    """
    e = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before, now = None, _state(e)
    while now[0] and now != before:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = _with_low(both.where("v > u"), low, 2 * now[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.union(low.where("u <> m").select("u", "m")).distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = _with_low(large, low, 2 * now[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e = stage(small.distinct(), "edges")
        before, now = now, _state(e)
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
