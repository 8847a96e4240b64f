"""Pieces of extraction flows: label/value cells, header columns, tiers, rule tables and fallbacks.

All dictionaries, aliases, limits and rules are arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def label_values(rows: DataFrame, keys: list[str], cells: str) -> DataFrame:
    """Rows of label and value cells as (label, value, pair_no).

    Four cells or more are pairs side by side; with three, the first is a running number.  An
    odd last cell is padded with an empty value; blank labels give no row.
    """
    padded = F.when(F.size(cells) == 3, F.slice(cells, 2, 2)).otherwise(F.col(cells))
    firsts = F.filter(padded, lambda x, i: i % 2 == 0)
    seconds = F.filter(padded, lambda x, i: i % 2 == 1)
    pairs = F.transform(F.arrays_zip(firsts.alias("l"), seconds.alias("v")), lambda p: F.struct(F.trim(p["l"]).alias("label"), F.coalesce(F.trim(p["v"]), F.lit("")).alias("value")))
    return rows.select(*keys, F.posexplode(pairs).alias("pair_no", "p")).select(*keys, "pair_no", "p.label", "p.value").where("label <> ''")


def header_columns(cells: DataFrame, table: list[str], row: str, column: str, text: str, aliases: list[tuple[str, str]], head_rows: int = 4) -> DataFrame:
    """(table, field, column): within the first rows of a table, each field's first header cell.

    A cell belongs to the field of the first alias that it contains.
    """
    field = F.coalesce(*[F.when(F.col(text).contains(a), F.lit(f)) for a, f in aliases])
    heads = cells.where(F.col(row) < head_rows).select(*table, row, column, field.alias("field")).where("field IS NOT NULL")
    return heads.groupBy(*table, "field").agg(F.min(F.struct(row, column)).alias("c")).select(*table, "field", F.col(f"c.{column}").alias(column))


def complete_tables(headers: DataFrame, table: list[str], required: list[str]) -> DataFrame:
    """The tables whose headers name every required field."""
    found = headers.where(F.col("field").isin(required)).groupBy(*table).agg(F.count_distinct("field").alias("n"))
    return found.where(F.col("n") == len(set(required))).drop("n")


def lowest_tier(df: DataFrame, keys: list[str], tier: Column) -> DataFrame:
    """The rows of each group's best tier only; rows without a tier never count.

    The minima are aggregated before the shuffle and joined back, so no group is gathered.
    """
    x = df.withColumn("_tier", tier).where("_tier IS NOT NULL")
    best = x.groupBy(*keys).agg(F.min("_tier").alias("_tier"))
    return x.join(best, [*keys, "_tier"]).drop("_tier")


def fallback_reason(tables: Column, rows: Column, numbered: Column, margin: int = 2) -> Column:
    """Why the text pass runs besides the table pass; null where it does not."""
    return F.when(tables == 0, F.lit("no_tables")).when(rows == 0, F.lit("no_rows")).when(numbered >= rows + margin, F.lit("more_numbered_text"))


def rule_phrases(df: DataFrame, keys: list[str], rules: list[tuple[str, Column, int, int]], most: int) -> DataFrame:
    """Phrases of a rule table: (phrase, condition, least count, weight); the ``most`` heaviest that hold.

    All rules are counted by one aggregation; ties go to the rule listed first.
    """
    counted = df.groupBy(*keys).agg(*[F.count_if(c).alias(f"_n{i}") for i, (_, c, _, _) in enumerate(rules)])
    held = F.array_compact(F.array(*[F.when(F.col(f"_n{i}") >= n, F.struct(F.lit(-w).alias("w"), F.lit(i).alias("i"), F.lit(p).alias("p"))) for i, (p, _, n, w) in enumerate(rules)]))
    return counted.select(*keys, F.array_join(F.slice(F.sort_array(held), 1, most)["p"], "; ").alias("phrases"))


def grouped_tokens(df: DataFrame, keys: list[str], subject: str, token: str, order: list[str], tokens: int = 5, phrases: int = 6) -> DataFrame:
    """Per group one line: subjects in first-seen order, each with its first distinct tokens.

    First places are aggregated, so repeats never travel.
    """
    place = F.struct(*order)
    first = df.where(F.col(subject).isNotNull() & F.col(token).isNotNull()).groupBy(*keys, subject, token).agg(F.min(place).alias("at"))
    inside = Window.partitionBy(*keys, subject).orderBy("at", token)
    kept = first.withColumns({"r": F.row_number().over(inside), "head": F.min("at").over(Window.partitionBy(*keys, subject))}).where(F.col("r") <= tokens)
    lines = kept.groupBy(*keys, subject).agg(F.min("head").alias("head"), F.array_join(F.sort_array(F.collect_list(F.struct("r", token)))[token], "/").alias("t"))
    ranked = lines.withColumn("k", F.row_number().over(Window.partitionBy(*keys).orderBy("head", subject))).where(F.col("k") <= phrases)
    return ranked.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list(F.struct("k", F.concat_ws(":", F.col(subject).cast("string"), "t").alias("p"))))["p"], "; ").alias("line"))


def first_fragments(df: DataFrame, keys: list[str], order: list, admit: Column, have: DataFrame, most: int = 3) -> DataFrame:
    """The first ``most`` admitted fragments of every group that ``have`` does not name yet."""
    x = df.where(admit).join(have, keys, "left_anti")
    return x.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= most).drop("_r")


def is_raw_data(text: Column, measure: str, judgement: str, least: int = 3) -> Column:
    """Whether a text is figures only: ``least`` measures or more and no word of judgement."""
    return (F.size(F.regexp_extract_all(text, F.lit(measure), F.lit(0))) >= least) & ~text.rlike(judgement)


def last_match(text: Column, pattern: str) -> Column:
    """The last match of a pattern's first group; null without a match."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(-1))


def stated_count(text: Column, none_words: str) -> Column:
    """The sum of the numbers that a text states; 0 where it says there are none, null where it says nothing or more than a long holds."""
    found = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    total = F.aggregate(found, F.lit(0).cast("decimal(38,0)"), lambda a, x: (a + x.try_cast("decimal(37,0)")).try_cast("decimal(38,0)"))
    return F.when(F.size(found) > 0, total.try_cast("long")).when(text.rlike(none_words), F.lit(0).cast("long"))


def split_scopes(text: Column, scopes: list[str], value: str) -> Column:
    """Map of scope word to the first value in the stretch from that word to the next scope word.

    A scope named twice keeps its first value; stretches without a value are left out.
    """
    words = "|".join(scopes)
    parts = F.regexp_extract_all(text, F.lit(f"(?s)(?:{words})(?:(?!{words}).)*"), F.lit(0))
    pairs = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, f"^({words})", 1).alias("k"), F.regexp_extract(p, value, 1).alias("v")))
    kept = F.filter(pairs, lambda p: p["v"] != "")
    firsts = F.filter(kept, lambda p, i: F.array_position(kept["k"], p["k"]) == i + 1)
    return F.map_from_entries(firsts)


def overlay(base: Column, change: Column, allowed: list[str]) -> Column:
    """Map ``base`` with the allowed, non-blank entries of ``change`` put over it."""
    ok = F.map_filter(F.coalesce(change, F.create_map().cast("map<string,string>")), lambda k, v: k.isin(allowed) & (F.trim(F.coalesce(v, F.lit(""))) != ""))
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.array_contains(F.map_keys(ok), k)), ok)
