"""Audit operators: flags, diffs, gates and incremental state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flags(df: DataFrame, keys: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """One row for each rule that a row breaks, from one pass over the rows."""
    codes = F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(code)) for code, broken in rules])
    return df.select(*keys, F.explode(F.filter(codes, lambda c: c.isNotNull())).alias("code"))


def field_diff(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old, new) wherever a field differs, absent rows included; nulls equal nulls."""
    long = lambda df, v: df.select(key, F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias(v)) for f in fields])))
    joined = long(before, "old").join(long(after, "new"), [key, "field"], "full")
    return joined.where(~F.col("old").eqNullSafe(F.col("new")))


def locked_changes(before: DataFrame, after: DataFrame, key: list[str], locked: list[str]) -> DataFrame:
    """Keys of both sides whose locked fields changed, with the names of those fields."""
    b = before.select(*key, *[F.col(f).alias(f"_b_{f}") for f in locked])
    changed = F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_b_{f}")), F.lit(f)) for f in locked])
    out = after.join(b, key).withColumn("changed", F.array_join(F.filter(changed, lambda x: x.isNotNull()), ","))
    return out.where("changed <> ''").select(*key, "changed")


def stale(files: DataFrame, state: DataFrame, path: str, content: str, digest: str = "digest") -> DataFrame:
    """Files without a finished state of the same content: what an incremental run still has to do."""
    now = files.withColumn(digest, F.sha2(F.col(content), 256))
    return now.join(state.select(path, digest), [path, digest], "left_anti").select(path, digest)


def coverage(df: DataFrame, key: str, categories: dict[str, Column], by: str) -> DataFrame:
    """How many rows of each group belong to each category, long form, zeros included."""
    counts = F.array(*[F.struct(F.lit(c).alias("category"), F.when(x, 1).otherwise(0).alias("n")) for c, x in categories.items()])
    return df.select(by, F.inline(counts)).groupBy(by, "category").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_total"))


def judge_decisions(candidates: DataFrame, decisions: DataFrame, key: str, allowed: str, evidence: str) -> DataFrame:
    """(key, status): accepted, unresolved (no decision), or unknown_evidence where it cites what is not allowed."""
    met = candidates.select(key, allowed).join(decisions.select(key, evidence), key, "left")
    foreign = F.size(F.array_except(evidence, allowed)) > 0
    return met.select(key, F.when(F.col(evidence).isNull(), "unresolved").when(foreign, "unknown_evidence").otherwise("accepted").alias("status"))


def unsupported_tokens(said: DataFrame, context: DataFrame, keys: list[str], text: str, pattern: str, out: str) -> DataFrame:
    """Distinct tokens of ``said`` that no row of ``context`` with the same keys has, by an anti-join."""
    tokens = F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias(out)
    known = context.select(*keys, tokens).distinct()
    return said.select("*", tokens).drop(text).distinct().join(known, [*keys, out], "left_anti")


def consistency_issues(records: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, code): where a record contradicts itself or holds text that no report says.

    ``records`` has the texts recommendations_summary, expected_summary, overall_conclusion, risk_points, the arrays
    detailed, causes and safety, and the counts n_rows and n_blank of its recommendations.
    """
    from brindle.functions import vocabulary as V
    from brindle.functions.reports import contains_any

    of = lambda c: F.coalesce(F.col(c), F.lit(""))
    lines = lambda c: F.array_join(F.coalesce(F.col(c), F.array().cast("array<string>")), "\n")
    joined = F.concat_ws("\n", of("overall_conclusion"), of("risk_points"), lines("detailed"), lines("causes"), lines("safety"))
    advice = ("建议", "维修", "修复", "处治", "处置")
    calm = contains_any(lines("safety"), V.REASSURING)
    rest = F.regexp_replace(lines("safety"), r"(?:暂不|不|未)\s*影响(?:结构)?(?:安全|承载能力|承载)", "")
    return flags(records, keys, [
        ("blank_recommendation_category", F.col("n_blank") > 0),
        ("recommendation_summary_mismatch", (F.col("n_rows") > 0) & (of("recommendations_summary") != of("expected_summary"))),
        ("missing_value_sentence_splice", joined.contains("无。本次检测")),
        ("generic_composer_marker", contains_any(joined, V.MADE_UP)),
        ("overall_conclusion_too_long", F.length(of("overall_conclusion")) > 250),
        ("overall_conclusion_contains_action", contains_any(of("overall_conclusion"), advice)),
        ("risk_points_too_long", F.length(of("risk_points")) > 200),
        ("risk_points_contains_action", contains_any(of("risk_points"), (*advice, "可直接用", "环氧砂浆"))),
        ("detailed_conclusion_contains_recommendation", lines("detailed").contains("综上，报告建议")),
        ("unsupported_no_history_statement", lines("detailed").contains("无往年检测评分")),
        ("safety_meta_text", contains_any(lines("safety"), ("已有证据为", "报告未明确"))),
        ("safety_conclusion_conflict", calm & contains_any(rest, ("影响安全", "影响承载", "承载能力不足", "不满足要求"))),
    ])


def label_issues(records: DataFrame, keys: list[str], previous_score: str, previous_grade: str, trend: str, detailed: str, stated: str, counted: str) -> DataFrame:
    """(keys, code): a trend without an earlier assessment, a trend at a first inspection, or stated counts that the rows do not have.

    ``stated`` and ``counted`` are maps of category to count.
    """
    blank = lambda c: F.col(c).isNull() | F.trim(F.col(c)).isin("", "无", "暂无", "不适用", "-", "—", "/")
    n = lambda m, k: F.coalesce(F.try_element_at(F.col(m), k), F.lit(0).cast("long"))
    wrong = F.exists(F.map_keys(stated), lambda k: n(stated, k) != n(counted, k))
    return flags(records, keys, [
        ("trend_without_previous_score", blank(previous_score) & blank(previous_grade) & ~blank(trend)),
        ("first_inspection_with_trend", F.col(detailed).rlike("首次|无往年") & ~blank(trend)),
        ("recommendation_count_mismatch", wrong),
    ])


def issue_report(issues: DataFrame, n_records: int, key: str) -> DataFrame:
    """(code, n, share): how many records have each issue."""
    return issues.groupBy("code").agg(F.count_distinct(key).alias("n")).withColumn("share", F.bround(F.col("n") / F.lit(n_records), 6))
