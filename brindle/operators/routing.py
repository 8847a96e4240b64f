"""Sections of documents: which blocks open one, where it ends, and what lies in it.

Blocks are rows (document, position, is_table, text, heading_level, style).  All positional rules
are windows over one sort of a document's blocks; none joins blocks with blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brindle.functions import vocabulary as V
from brindle.functions.reports import compact, contains_any, title_key

LEVELS = 9
ENDS = "：:。.;；，,、"


def heading_level(level: Column, style: Column) -> Column:
    """The stated level (1 at least), else the one that the style's name tells; null for plain text."""
    name = F.trim(F.coalesce(style, F.lit("")))
    told = F.nullif(F.regexp_extract(name, V.HEADING_STYLE, 1), F.lit("")).cast("int")
    return F.when(level.isNotNull(), F.greatest(level, F.lit(1))).otherwise(F.coalesce(told, F.when(F.lower(name).isin(*V.TITLE_STYLES), 1)))


def title_category(text: Column, titles=V.TITLES) -> Column:
    """The category of the longest title word found, ties to the category listed first; causes are no list of defects."""
    key = title_key(text)
    words = sorted(((len(w), -n, w, c) for n, (c, ws) in enumerate(titles) for w in ws), reverse=True)
    hit = lambda w, c: key.contains(w) & ~contains_any(key, V.CAUSE_WORDS) if c == "defect_table" else key.contains(w)
    return F.coalesce(*[F.when(hit(w, c), F.lit(c)) for _, _, w, c in words])


def table_category(text: Column) -> Column:
    """What the text of a table tells: its header words, then those of the sections, then a short line's title."""
    x = compact(text)
    has = lambda ws: contains_any(x, ws)
    known = (
        F.when(has(V.TABLE_DEFECTS), "defect_table").when(has(V.TABLE_SCORES) & has(V.TABLE_SCORE_UNITS), "scoring").when(has(V.TABLE_RECOMMENDATIONS), "recommendations")
        .when(has(V.TABLE_TREATMENTS), "treatment_recommendations").when(has(V.TABLE_SAFETY), "safety_assessment").when(has(V.TABLE_CONCLUSIONS), "inspection_conclusion")
    )
    return F.coalesce(known, F.when(~F.coalesce(text, F.lit("")).contains("\n") & (F.length(x) <= 80), title_category(text)))


def reads_as_title(text: Column, titles=V.TITLES) -> Column:
    """Whether a paragraph without a heading's style is one by its words: short, one line, ending in a title word."""
    key = F.regexp_replace(title_key(text), f"[{ENDS}]+$", "")
    ends = "(?:" + "|".join(w for _, ws in titles for w in ws) + ")$"
    return ~text.contains("\n") & (F.length(compact(text)) <= 80) & (key.rlike(ends) | (key.rlike("(?:章节|部分)$") & title_category(key).isNotNull()))


def is_container(text: Column) -> Column:
    """Whether a heading only holds sections of conclusions and advice."""
    return _title(text).rlike("(?:" + "|".join(V.CONTAINER_TITLES) + ")$")


def is_leaf(text: Column) -> Column:
    """Whether a heading can itself hold advice."""
    return ~is_container(text) & _title(text).rlike("(?:" + "|".join(V.LEAF_TITLES) + ")$")


def _title(text: Column) -> Column:
    return F.btrim(title_key(text), F.lit(ENDS))


def candidates(blocks: DataFrame, text: str = "text", level: str = "heading_level", style: str = "style", is_table: str = "is_table") -> DataFrame:
    """``blocks`` with ``level`` (null for tables) and ``category`` (null where no section opens)."""
    own = F.when(~F.col(is_table), heading_level(F.col(level), F.col(style)))
    x = blocks.withColumn("level", own)
    opens = F.col("level").isNotNull() | reads_as_title(F.col(text))
    return x.withColumn("category", F.when(F.col(is_table), table_category(F.col(text))).when(opens, title_category(F.col(text))))


def route_sections(blocks: DataFrame, document: list[str], position: str, is_table: str = "is_table", text: str = "text") -> DataFrame:
    """(document, category, start, end, is_table, is_container): the sections of each document, ``end`` exclusive.

    ``blocks`` comes from ``candidates``.  A section ends before the next heading of its level or above, any
    heading if it has none, or the next plain paragraph that opens one; a table is its own section unless a
    section of its category around it exists.
    """
    ordered = Window.partitionBy(*document).orderBy(position)
    later = ordered.rowsBetween(1, Window.unboundedFollowing)
    at = F.col(position)
    upto = [F.min(F.when(F.col("level") <= k, at)).over(later).alias(f"_h{k}") for k in range(1, LEVELS + 1)]
    plain = F.min(F.when(F.col("level").isNull() & ~F.col(is_table) & F.col("category").isNotNull(), at)).over(later).alias("_plain")
    last = (F.max(at).over(Window.partitionBy(*document)) + 1).alias("_last")
    x = blocks.select(*document, position, is_table, text, "level", "category", *upto, plain, last).where("category IS NOT NULL")
    heading = F.coalesce(*[F.when(F.least(F.col("level"), F.lit(LEVELS)) == k, F.col(f"_h{k}")) for k in range(1, LEVELS + 1)], F.when(F.col("level").isNull(), F.col(f"_h{LEVELS}")))
    end = F.when(F.col(is_table), at + 1).otherwise(F.coalesce(F.least(heading, "_plain"), F.col("_last")))
    x = x.withColumn("end", end)
    around = F.max(F.when(~F.col(is_table), F.col("end"))).over(Window.partitionBy(*document, "category").orderBy(position).rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("_around", around).where(~F.col(is_table) | F.col("_around").isNull() | (F.col("_around") <= at))
    return x.select(*document, "category", at.alias("start"), "end", is_table, (~F.col(is_table) & is_container(F.col(text))).alias("is_container"))


def block_categories(blocks: DataFrame, routes: DataFrame, document: list[str], position: str, titles=V.TITLES) -> DataFrame:
    """``blocks`` with ``categories``: the sorted names of all sections that a block lies in.

    Sections and blocks are laid in one sequence, so the farthest end seen so far tells, category by category.
    """
    names = sorted(c for c, _ in titles)
    ends = routes.groupBy(*document, F.col("start").alias(position)).pivot("category", names).agg(F.max("end"))
    so_far = Window.partitionBy(*document).orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = blocks.join(ends, [*document, position], "left")
    inside = [F.when(F.max(F.col(c)).over(so_far) > F.col(position), F.lit(c)) for c in names]
    return x.withColumn("categories", F.array_compact(F.array(*inside))).drop(*names)


def route_text(blocks: DataFrame, document: list[str], position: str, category: str, text: str = "text", is_table: str = "is_table", glue: str = "\n") -> DataFrame:
    """One text a document: the paragraphs inside sections of a category, in order; ``blocks`` has ``categories``."""
    own = blocks.where(F.array_contains("categories", category) & ~F.col(is_table) & (F.trim(text) != "") & F.col("category").isNull())
    return own.groupBy(*document).agg(F.array_join(F.sort_array(F.collect_list(F.struct(position, text)))[text], glue).alias("text"))


def cover(blocks: DataFrame, document: list[str], position: str) -> DataFrame:
    """``blocks`` (from ``candidates``) with ``is_cover``: whether a block stands before the first heading or section."""
    first = F.min(F.when(F.col("level").isNotNull() | F.col("category").isNotNull(), F.col(position))).over(Window.partitionBy(*document))
    return blocks.withColumn("is_cover", F.coalesce(F.col(position) < first, F.lit(True)))


def earlier_period(blocks: DataFrame, document: list[str], position: str, heading: str, text: str = "text") -> DataFrame:
    """``blocks`` with ``is_earlier``: from the first heading that matches up to the next heading of its level or above."""
    doc = Window.partitionBy(*document)
    matches = F.col("level").isNotNull() & title_key(F.col(text)).rlike(heading)
    x = blocks.withColumn("_from", F.min(F.when(matches, F.struct(F.col(position).alias("at"), "level"))).over(doc))
    closes = (F.col(position) > F.col("_from.at")) & (F.col("level") <= F.col("_from.level"))
    x = x.withColumn("_to", F.min(F.when(closes, F.col(position))).over(doc))
    inside = (F.col(position) >= F.col("_from.at")) & (F.col("_to").isNull() | (F.col(position) < F.col("_to")))
    return x.withColumn("is_earlier", F.coalesce(inside, F.lit(False))).drop("_from", "_to")


def text_window(units: DataFrame, document: list[str], position: str, text: str, start: str, end: str) -> DataFrame:
    """What stands after a document's last start marker and before the first end marker behind it, to the character.

    Markers are patterns.  Without a start there is no row; without an end the text runs to the last unit.
    """
    x = units.withColumn("_tail", F.regexp_extract(text, f"(?s)^.*(?:{start})(.*)$", 1)).withColumn("_has", F.col(text).rlike(start))
    x = x.withColumn("_from", F.max(F.when(F.col("_has"), F.col(position))).over(Window.partitionBy(*document))).where(F.col(position) >= F.col("_from"))
    x = x.withColumn("_text", F.when(F.col(position) == F.col("_from"), F.col("_tail")).otherwise(F.col(text)))
    x = x.withColumn("_to", F.min(F.when(F.col("_text").rlike(end), F.col(position))).over(Window.partitionBy(*document))).where(F.col("_to").isNull() | (F.col(position) <= F.col("_to")))
    cut = F.when(F.col(position) == F.col("_to"), F.element_at(F.split("_text", end, 2), 1)).otherwise(F.col("_text"))
    part = x.withColumn("_cut", cut).where("_cut <> ''")
    return part.groupBy(*document).agg(F.array_join(F.sort_array(F.collect_list(F.struct(position, "_cut")))["_cut"], "\n").alias("text"))
