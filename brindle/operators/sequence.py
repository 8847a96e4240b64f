"""Operators over ordered rows.  Every one names its partition and a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _so_far(part: list[str], order: list):
    return Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def forward_fill(df: DataFrame, part: list[str], order: list, columns: list[str]) -> DataFrame:
    """Blank values take the last value above them.  Filter afterwards, so rejected rows still count."""
    w = _so_far(part, order)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in columns})


def conditional_fill(df: DataFrame, part: list[str], order: list, column: str, may_inherit: Column) -> DataFrame:
    """Like ``forward_fill``, but only rows that may inherit do."""
    last = F.last(F.col(column), ignorenulls=True).over(_so_far(part, order))
    return df.withColumn(column, F.when(F.col(column).isNull() & may_inherit, last).otherwise(F.col(column)))


def as_of(df: DataFrame, part: list[str], order: list, marker: Column, value: Column, name: str) -> DataFrame:
    """The value of the nearest marked row at or above each row."""
    return df.withColumn(name, F.last(F.when(marker, value), ignorenulls=True).over(_so_far(part, order)))


def look_back(df: DataFrame, part: list[str], order: list, marker: Column, value: Column, rows: int, name: str) -> DataFrame:
    """The nearest marked value among the ``rows`` rows before."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-rows, -1)
    return df.withColumn(name, F.last(F.when(marker, value), ignorenulls=True).over(w))


def islands(df: DataFrame, part: list[str], order: list, begins: Column, name: str = "island") -> DataFrame:
    """Numbers of the stretches that begin where ``begins`` holds; rows before the first are 0."""
    return df.withColumn(name, F.sum(F.when(begins, 1).otherwise(0)).over(_so_far(part, order)).cast("long"))


def runs(df: DataFrame, part: list[str], order: list, value: Column, name: str = "run") -> DataFrame:
    """Numbers of the runs of equal consecutive values, from 1."""
    before = F.lag(F.struct(value.alias("v"))).over(Window.partitionBy(*part).orderBy(*order))
    return islands(df.withColumn("_new", before.isNull() | ~before["v"].eqNullSafe(value)), part, order, F.col("_new"), name).drop("_new")


def merge_continuations(df: DataFrame, part: list[str], order: list, begins: Column, text: str, glue: str = "") -> DataFrame:
    """Rows that continue an item join it: one row an island with the texts in order."""
    numbered = islands(df, part, order, begins)
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    items = F.sort_array(F.collect_list(F.struct(*[k.alias(f"o{i}") for i, k in enumerate(keys)], F.col(text).alias("t"))))
    return numbered.groupBy(*part, "island").agg(items.alias("i")).select(*part, "island", F.array_join("i.t", glue).alias(text), F.size("i").cast("long").alias("n_rows"))


def dense_index(df: DataFrame, part: list[str], order: list, key: Column, name: str = "display_index") -> DataFrame:
    """A display number that grows when a non-blank key changes; blanks repeat the previous one."""
    filled = df.withColumn("_k", F.last(key, ignorenulls=True).over(_so_far(part, order)))
    return runs(filled, part, order, F.col("_k"), name).drop("_k")


def section_intervals(df: DataFrame, part: list[str], position: str, level: str, levels: int) -> DataFrame:
    """Half-open intervals of headings: each ends at the next heading of its level or above, or with the part.

    One running minimum for each level over the rows below replaces the self-join.
    """
    below = Window.partitionBy(*part).orderBy(position).rowsBetween(1, Window.unboundedFollowing)
    last = F.max(position).over(Window.partitionBy(*part)) + 1
    ends = [F.min(F.when(F.col(level) <= k, F.col(position))).over(below) for k in range(1, levels + 1)]
    picked = df.withColumn("_last", last).withColumns({f"_e{k + 1}": e for k, e in enumerate(ends)}).where(F.col(level).isNotNull())
    end = F.coalesce(*[F.when(F.col(level) == k, F.col(f"_e{k}")) for k in range(1, levels + 1)], F.col("_last"))
    return picked.select(*part, F.col(position).alias("start_block"), end.alias("end_block"), F.col(level))


def block_membership(df: DataFrame, part: list[str], position: str, level: str, levels: int) -> DataFrame:
    """Every row with the innermost heading of each level that covers it, found by running state."""
    w = _so_far(part, [position])
    out = df
    for k in range(1, levels + 1):
        # A heading of level k holds until one of its level or above.
        out = out.withColumn(f"in_level_{k}", F.last(F.when(F.col(level) == k, F.col(position)).when(F.col(level) < k, F.lit(-1)), ignorenulls=True).over(w))
    return out.withColumns({f"in_level_{k}": F.nullif(F.col(f"in_level_{k}"), F.lit(-1)) for k in range(1, levels + 1)})


def last_marker_window(df: DataFrame, part: list[str], position: str, start: Column, end: Column) -> DataFrame:
    """(start, end) of the window from the last start marker to the first end marker after it."""
    marked = df.withColumn("_s", F.max(F.when(start, F.col(position))).over(Window.partitionBy(*part)))
    return marked.groupBy(*part).agg(F.max("_s").alias("start_block"), F.min(F.when(end & (F.col(position) > F.col("_s")), F.col(position))).alias("end_block"))


def next_value(df: DataFrame, part: list[str], position: str, is_label: Column, value: str, name: str) -> DataFrame:
    """A label cell with the value of the next physical cell."""
    return df.withColumn(name, F.lead(F.col(value)).over(Window.partitionBy(*part).orderBy(position))).where(is_label)


def split_items(df: DataFrame, text: str, separator: str, keys: list[str]) -> DataFrame:
    """One row for each non-blank piece of a text, numbered by its place among all pieces from 0."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), separator)).alias("item_no", "item")).where(F.trim("item") != "")
