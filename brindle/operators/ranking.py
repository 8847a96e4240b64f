"""Ranked picks: best per topic, top items in reading order, counts of the leading tier, weight columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def best_per_topic(df: DataFrame, keys: Sequence[str], topic: str, rank: Column, tie: str, limit: int) -> DataFrame:
    """The lowest-ranked row of every topic, of which the ``limit`` lowest of each key stay.

    Topics are aggregated before the shuffle; only one row a topic reaches the window.
    Rows without a rank take no part.
    """
    best = df.withColumn("rank", rank).where("rank IS NOT NULL").groupBy(*keys, topic).agg(F.min(F.struct("rank", tie)).alias("b"))
    rows = best.select(*keys, topic, f"b.{tie}", "b.rank")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("rank", topic))
    return rows.withColumn("_place", place).where(F.col("_place") <= limit).drop("_place")


def top_in_order(items: Column, weight, limit: int) -> Column:
    """The ``limit`` heaviest items of an array, ties to the earlier one, in their first order."""
    tagged = F.transform(items, lambda x, i: F.struct((-weight(x)).alias("w"), i.alias("i"), x.alias("x")))
    top = F.slice(F.array_sort(tagged), 1, limit)
    return F.transform(F.array_sort(F.transform(top, lambda t: F.struct(t["i"].alias("i"), t["x"].alias("x")))), lambda t: t["x"])


def leading_count(df: DataFrame, keys: Sequence[str], priority: str, is_table: Column, count: str, order: str) -> DataFrame:
    """The count that the highest priority states: summed if all of it are tables, else the first one.

    Two aggregations with partial results; no group is gathered.
    """
    tiers = df.groupBy(*keys, priority).agg(F.bool_and(is_table).alias("t"), F.sum(count).alias("s"), F.min_by(count, order).alias("f"))
    return tiers.groupBy(*keys).agg(F.max_by(F.when(F.col("t"), F.col("s")).otherwise(F.col("f")), priority).alias("count"))


def weight_and_score_columns(df: DataFrame, keys: Sequence[str], columns: dict[str, Column], tolerance: float = 0.02) -> DataFrame:
    """(keys, weight_column, score_column): named only where exactly one column fits each role.

    Weights lie in [0, 1] and sum to 1; scores reach above 1, to 100 at most.
    """
    stats = [f(c).alias(f"{n}_{k}") for n, c in columns.items() for k, f in (("lo", F.min), ("hi", F.max), ("sum", F.sum))]
    wide = df.groupBy(*keys).agg(*stats)

    def only(fits: dict[str, Column]) -> Column:
        named = F.filter(F.array(*[F.when(fit, F.lit(n)) for n, fit in fits.items()]), lambda x: x.isNotNull())
        return F.when(F.size(named) == 1, F.element_at(named, 1))

    weights = {n: (F.col(f"{n}_lo") >= 0) & (F.col(f"{n}_hi") <= 1) & (F.abs(F.col(f"{n}_sum") - 1) <= tolerance) for n in columns}
    scores = {n: (F.col(f"{n}_hi") > 1) & (F.col(f"{n}_hi") <= 100) for n in columns}
    return wide.select(*keys, only(weights).alias("weight_column"), only(scores).alias("score_column"))


def topic_statements(df: DataFrame, keys: Sequence[str], text: str, order: Sequence[str], topic: Column, rank: Column, reassuring: Column, limit: int) -> DataFrame:
    """The best statement of every topic by rank, a reassuring one before others, then the first; ``limit`` topics a key.

    Topics are aggregated before the shuffle, so only their best statements reach the window.
    """
    key = F.struct("rank", (~reassuring).alias("alarming"), *order, F.col(text).alias("text"))
    best = df.withColumns({"topic": topic, "rank": rank}).groupBy(*keys, "topic").agg(F.min(key).alias("b"))
    rows = best.select(*keys, "topic", F.col("b.text").alias(text), F.col("b.rank").alias("rank"))
    return rows.withColumn("_place", F.row_number().over(Window.partitionBy(*keys).orderBy("rank", "topic"))).where(F.col("_place") <= limit).drop("_place")


def counts_zero_filled(dimension: DataFrame, facts: DataFrame, key: str, kind: str, kinds: Sequence[str]) -> DataFrame:
    """Every row of ``dimension`` with each of the ``kinds`` and its number of facts, zeros included."""
    counts = facts.groupBy(key, kind).agg(F.count("*").alias("n"))
    grid = dimension.withColumn(kind, F.explode(F.array(*[F.lit(k) for k in kinds])))
    return grid.join(counts, [key, kind], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def file_statistics(files: DataFrame, by: Column, content: str) -> DataFrame:
    """(by, n_files, n_bytes, longest) of files."""
    return files.groupBy(by).agg(F.count("*").alias("n_files"), F.sum(F.octet_length(content)).cast("long").alias("n_bytes"), F.max(F.length(content)).cast("long").alias("longest"))


def state_matrix(df: DataFrame, row: str, state: str, states: Sequence[str]) -> DataFrame:
    """One row a value of ``row`` with the number of each state."""
    return df.groupBy(row).pivot(state, list(states)).count().fillna(0)


def dominant_value(df: DataFrame, key: str, value: str, percent: int = 80) -> DataFrame:
    """(key, dominant, n, warns): each key's most frequent value, ties to the smaller, and whether it has ``percent`` of the rows."""
    c = df.groupBy(key, value).agg(F.count("*").alias("n"))
    top = c.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), value)).alias("b"), F.sum("n").alias("total"))
    return top.select(key, F.col(f"b.{value}").alias("dominant"), (-F.col("b.n")).alias("n"), (-100 * F.col("b.n") >= percent * F.col("total")).alias("warns"))
