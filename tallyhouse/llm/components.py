"""Connected components of an edge table, distributed.

Alternating large-star and small-star steps: every step replaces edges by
edges to the smallest known neighbour until nothing changes. Each step is
grouped minima and joins on a node, so a node of any degree is reduced
before it is moved, and only the table of one step is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import saved


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    pairs = _both_ways(edges)
    found = pairs.join(_smallest(pairs), "u").where("v > u")
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of all nodes of ``edges`` that have a neighbour;
    the component is its smallest node. Nodes are longs, not null."""
    now = saved(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges")

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return row[0], row[1]

    before, now_state = None, state(now)
    while now_state != before:
        now = saved(_small_star(_large_star(now)), "stars")
        before, now_state = now_state, state(now)
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
