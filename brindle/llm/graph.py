"""Connected components over an edge table, without ever gathering it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_join, written


def _star(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """One star step on edges (u > v): neighbours move to their hub's smallest neighbour.

    The large star rehangs larger neighbours, the small star smaller ones and the hub
    itself.  Minima are aggregated before the shuffle, and the join back deals the
    neighbours of a hot hub over many tasks.
    """
    sides = edges.select(F.col("u").alias("hub"), F.col("v").alias("x"))
    if large:
        sides = sides.unionByName(edges.select(F.col("v").alias("hub"), F.col("u").alias("x")))
    low = sides.groupBy("hub").agg(F.min("x").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("m", "hub"))
    moved = hot_join(sides, low, "hub", "n", total)
    if large:
        out = moved.where(F.col("x") > F.col("hub")).select(F.col("x").alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(F.col("x").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("hub").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node on an edge of ``edges(u, v)``; root is the smallest node reachable.

    Alternates large-star and small-star steps until only stars are left, each around
    its smallest node; every step is written to the shared folder, so a lost executor
    costs one step at most.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        if _only_stars(now):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        total = now.count()
        now = written(_star(written(_star(now, True, 2 * total)), False, total))
    raise RuntimeError(f"edges still change after {max_rounds} rounds")


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node that hangs on another is on no further edge (u > v)."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("hangs")), F.struct(F.col("v").alias("node"), F.lit(0).alias("hangs")))))
    return ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.count("*").alias("n")).where("hangs > 0 AND n > 1").isEmpty()
