"""Small audits over records: where values come from, which names fit, which table is meant, what supports a statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: How list items are labelled inside running text, behind a mark or at the start; decimals are no labels.
ITEM = r"(?:(?<=[。；;：:\n\s])|^)(?:[（(]\d+[）)]|\d+[、）)]|[①②③④⑤⑥⑦⑧⑨⑩])"


def split_numbered(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, place, item): the numbered items of a text; what stands before the first number is no item, a text without numbers is one."""
    parts = F.split(F.coalesce(text, F.lit("")), ITEM)
    trimmed = F.transform(F.when(F.size(parts) > 1, F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1)))).otherwise(parts), lambda p: F.btrim(p, F.lit(" 　\n，,；;。")))
    return df.select(*keys, F.posexplode(F.filter(trimmed, lambda p: p != "")).alias("place", "item"))


def audit_states(candidates: DataFrame, records: DataFrame, keys: list[str], fields: list[str], strong: list[str], none_words: tuple[str, ...] = ("无", "暂无", "不适用")) -> DataFrame:
    """(keys, field, state): extracted, ambiguous, explicit_none or missing.

    ``candidates`` has field, value, kind and anchor.  Values that differ are ambiguous unless all from strong sources agree; a word for
    nothing with an anchor is an explicit none, without one it is missing.
    """
    filled = F.trim(F.coalesce("value", F.lit(""))) != ""
    said = candidates.where(filled).withColumns({"_s": F.col("kind").isin(*strong), "_n": F.trim("value").isin(*none_words)})
    per = said.groupBy(*keys, "field").agg(
        F.count_distinct(F.when(~F.col("_n"), F.col("value"))).alias("n"), F.count_distinct(F.when(F.col("_s") & ~F.col("_n"), F.col("value"))).alias("s"), F.max(F.when(F.col("_n") & F.col("anchor").isNotNull(), 1).otherwise(0)).alias("none"),
    )
    grid = records.select(*keys, F.explode(F.array(*map(F.lit, fields))).alias("field")).join(per, [*keys, "field"], "left")
    state = F.when(F.col("n").isNull() | ((F.col("n") == 0) & (F.col("none") == 0)), "missing").when(F.col("n") == 0, "explicit_none").when((F.col("n") == 1) | (F.col("s") == 1), "extracted").otherwise("ambiguous")
    return grid.select(*keys, "field", state.alias("state"))


def name_check(expected: DataFrame, actual: DataFrame, name: str, ending: str) -> DataFrame:
    """(name, issue): names that are missing, not expected, there twice, of another ending or unsafe; good ones give no row."""
    e = expected.select(F.col(name)).distinct().withColumn("_e", F.lit(True))
    a = actual.groupBy(name).agg(F.count("*").alias("n"))
    unsafe = F.col(name).rlike(r'(^|/)\.\.(/|$)|^/|[\\:*?"<>|\x{0}-\x{1f}]')
    issues = F.array(
        F.when(F.col("n").isNull(), "missing"), F.when(F.col("_e").isNull(), "unexpected"), F.when(F.col("n") > 1, "duplicate"), F.when(~F.lower(name).endswith(ending), "ending"), F.when(unsafe, "unsafe"),
    )
    return e.join(a, name, "full").select(name, F.explode(F.array_compact(issues)).alias("issue"))


def best_table(cells: DataFrame, document: list[str], table: str, row: str, text: str, markers: list[str]) -> DataFrame:
    """(document, table, n_rows): of the tables one of whose rows holds all markers, the one with most rows, the first of equals."""
    row_text = cells.groupBy(*document, table, row).agg(*[F.max(F.col(text).contains(m).cast("int")).alias(f"_m{i}") for i, m in enumerate(markers)])
    all_ = F.lit(True)
    for i in range(len(markers)):
        all_ = all_ & (F.col(f"_m{i}") == 1)
    per = row_text.groupBy(*document, table).agg(F.count("*").alias("n_rows"), F.max(all_.cast("int")).alias("_ok")).where("_ok = 1")
    return per.groupBy(*document).agg(F.max_by(F.struct(table, "n_rows"), F.struct("n_rows", (-F.col(table)).alias("t"))).alias("b")).select(*document, f"b.{table}", "b.n_rows")


def on_one_row(candidates: DataFrame, keys: list[str], place: list[str], first: str, second: str) -> DataFrame:
    """(keys, place, first, second): values of two fields that stand on one row of one table."""
    a = candidates.where(F.col("field") == first).select(*keys, *place, F.col("value").alias(first))
    b = candidates.where(F.col("field") == second).select(*keys, *place, F.col("value").alias(second))
    return a.join(b, [*keys, *place])


def supporting(statements: DataFrame, facts: DataFrame, document: list[str], key: str, text: str, fact: str, fact_text: str, fallback: Column) -> DataFrame:
    """(document, key, evidence): the sorted facts of a statement's document that contain it or that it contains, else the fallback."""
    s = statements.select(*document, key, F.col(text).alias("_t"))
    f = facts.select(*document, fact, F.col(fact_text).alias("_f"))
    met = s.join(f, document).where((F.col("_t") != "") & (F.col("_f") != "") & (F.col("_t").contains(F.col("_f")) | F.col("_f").contains(F.col("_t"))))
    found = met.groupBy(*document, key).agg(F.array_sort(F.collect_set(fact)).alias("evidence"))
    return s.join(found, [*document, key], "left").select(*document, key, F.coalesce("evidence", F.array(fallback)).alias("evidence"))


def first_labels(own: Column, given: Column, names: list[str]) -> Column:
    """The first non-blank of the named entries of two maps; given ones go over a record's own."""
    both = F.map_concat(F.map_filter(own, lambda k, _: ~F.array_contains(F.map_keys(given), k)), given)
    return F.coalesce(*[F.nullif(F.trim(F.try_element_at(both, F.lit(n))), F.lit("")) for n in names])


def lowest_tier_evidence(evidence: DataFrame, keys: list[str], tiers: list[tuple[str, int]], kind: str) -> DataFrame:
    """Evidence of a record's best tier only, by kind; other kinds never count."""
    tier = F.coalesce(*[F.when(F.col(kind) == k, F.lit(t)) for k, t in tiers], F.lit(None).cast("int"))
    x = evidence.withColumn("_t", tier).where("_t IS NOT NULL")
    return x.withColumn("_b", F.min("_t").over(Window.partitionBy(*keys))).where("_t = _b").drop("_t", "_b")
