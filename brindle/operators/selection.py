"""Choosing among competing candidates, deduplication and ranked retrieval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def select_by_priority(df: DataFrame, keys: list[str], order: list[Column], top: int = 1) -> DataFrame:
    """The first rows of each key in a total order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= top).drop("_r")


def conflicts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose non-blank candidates disagree, with the number of distinct values."""
    return df.where(F.col(value).isNotNull() & (F.col(value).cast("string") != "")).groupBy(*keys).agg(F.countDistinct(value).alias("n_values")).where("n_values > 1")


def scoped_select(df: DataFrame, keys: list[str], scope: str, scopes: tuple[str, str], value: str, glue: str = "; ") -> DataFrame:
    """Keys all of whose candidates are scoped and that have both scopes: the smallest value of each, joined."""
    known = F.col(scope).isin(*scopes)
    a, b = (F.min(F.when(F.col(scope) == s, F.col(value))) for s in scopes)
    out = df.groupBy(*keys).agg(F.bool_and(F.coalesce(known, F.lit(False))).alias("_all"), a.alias("_a"), b.alias("_b"))
    return out.where("_all AND _a IS NOT NULL AND _b IS NOT NULL").select(*keys, F.concat_ws(glue, F.concat(F.lit(scopes[0] + "="), F.col("_a").cast("string")), F.concat(F.lit(scopes[1] + "="), F.col("_b").cast("string"))).alias("selected"))


def budget_select(df: DataFrame, keys: list[str], order: list, length: Column, budget: int) -> DataFrame:
    """The leading rows of each key whose lengths together stay within the budget."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("used", F.sum(length).over(w).cast("long")).where(F.col("used") <= budget)


def budget_fold(items: Column, budget: int, cap: int, least_tail: int, most: int) -> Column:
    """Items in order under a shared budget: each capped; one that does not fit is cut if enough room is left, and ends the list."""

    def step(a: Column, x: Column) -> Column:
        capped = F.left(x, F.lit(cap))
        room = F.lit(budget) - a["used"]
        fits = F.length(capped) <= room
        takes = ~a["done"] & (F.size(a["out"]) < most) & (fits | (room >= least_tail))
        kept = F.when(fits, capped).otherwise(F.left(capped, F.greatest(room, F.lit(0))))
        return F.struct(
            F.when(takes, F.array_append(a["out"], kept)).otherwise(a["out"]).alias("out"),
            F.when(takes, a["used"] + F.length(kept)).otherwise(a["used"]).alias("used"),
            (a["done"] | ~(takes & fits)).alias("done"),
        )

    return F.aggregate(items, F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("used"), F.lit(False).alias("done")), step, lambda a: a["out"])


def quota_reserve(df: DataFrame, key: list[str], section: str, quotas: dict | int, total: int, order: list[Column]) -> DataFrame:
    """First each section's quota (one for all, or by section), then the best of the rest up to ``total`` rows a key.

    Every section's own window comes first and drops what is beyond its quota and ``total``, so the final rank of a
    key sees ``total`` rows of each section at most.
    """
    inside = F.row_number().over(Window.partitionBy(*key, section).orderBy(*order))
    quota = F.lit(quotas) if isinstance(quotas, int) else F.coalesce(*[F.when(F.col(section).eqNullSafe(F.lit(k)), F.lit(v)) for k, v in quotas.items()], F.lit(0))
    local = df.withColumn("_r", inside).where(F.col("_r") <= F.greatest(F.lit(total), quota))
    reserved = local.withColumn("reserved", F.col("_r") <= quota).drop("_r")
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("reserved"), *order))
    return reserved.withColumn("rank", rank).where(F.col("rank") <= total)


def exact_dedupe(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key, with the number of rows it stands for."""
    first = F.min(F.struct(*[F.col(c) for c in order])).alias("_f")
    return df.groupBy(*keys).agg(first, F.count("*").alias("n_copies")).select(*keys, *[F.col(f"_f.{c}").alias(c) for c in order], "n_copies")


def containment_fold(items: Column, least: int) -> Column:
    """Items kept in order: one equal to, inside or around a kept one (both of ``least`` characters) is dropped.

    Greedy against what is kept, not transitive.
    """
    long = lambda a, b: (F.length(a) >= least) & (F.length(b) >= least)
    same = lambda a, b: (a == b) | (long(a, b) & (a.contains(b) | b.contains(a)))
    return F.aggregate(items, F.array().cast("array<string>"), lambda acc, x: F.when(F.exists(acc, lambda y: same(x, y)), acc).otherwise(F.array_append(acc, x)))
