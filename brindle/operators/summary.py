"""Summary fields: labelled values in running text, candidates from many places, and the choice among them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brindle.functions import vocabulary as V
from brindle.functions.reports import compact, contains_any
from brindle.functions.text import plain_number

TAIL = r"\s*(?:[（(][^）)]*[）)])?"


def _spaced(alias: str) -> str:
    return r"\s*".join(re.escape(c) if c.isascii() and not c.isalnum() else c for c in alias)


def field_of_label(label: Column, labels=V.SUMMARY_LABELS) -> Column:
    """The field that a label names: by its letters alone, else with blanks inside and a bracket behind; the longest alias first."""
    key = F.lower(F.regexp_replace(F.coalesce(label, F.lit("")), r"(?U)[\W_]+", ""))
    by_length = sorted(((a, f) for f, names in labels for a in names), key=lambda x: -len(x[0]))
    exact = [F.when(key == a.lower(), F.lit(f)) for a, f in by_length]
    loose = [F.when(F.trim(label).rlike(f"(?i)^{_spaced(a)}{TAIL}$"), F.lit(f)) for a, f in by_length]
    return F.coalesce(*exact, *loose)


def labelled_values(df: DataFrame, keys: list[str], text: str, labels=V.SUMMARY_LABELS, may_be_blank=V.MAY_BE_BLANK) -> DataFrame:
    """(keys, place, field, label, value): each labelled value of a text runs up to the next label.

    A label is followed by a colon, an equals sign, 为 or 是, or directly by a value; where labels overlap the one that starts first counts, of those
    at one place the longest.  Blank values stay only for fields that may be blank.
    """
    by_length = sorted(((a, f) for f, names in labels for a in names), key=lambda x: -len(x[0]))
    one = "(?:" + "|".join(_spaced(a) for a, _ in by_length) + ")" + TAIL + r"\s*(?:[:：=]\s*|[为是]\s*|(?=[\d.无暂不A-Ea-e优良中差]|$))"
    edge = " \t:：=，,；;。．"
    names = F.regexp_extract_all(F.col(text), F.lit(one), F.lit(0))
    values = F.split(F.col(text), one)
    pairs = F.transform(names, lambda n, i: F.struct(n.alias("label"), F.btrim(F.get(values, i + 1), F.lit(edge)).alias("value")))
    each = df.select(*keys, F.posexplode(pairs).alias("place", "p"))
    name = F.regexp_replace(F.regexp_replace(F.col("p.label"), r"[:：=为是\s]+$", ""), r"[（(][^）)]*[）)]$", "")
    out = each.select(*keys, "place", field_of_label(name, labels).alias("field"), F.trim(name).alias("label"), "p.value")
    return out.where((F.col("value") != "") | F.col("field").isin(*may_be_blank))


def distinct_candidates(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Candidates (field, value, kind, anchor, scope) once each, at their first place."""
    same = ["field", "value", "kind", "anchor", "scope"]
    return df.groupBy(*keys, *same).agg(F.min(seq).alias(seq))


def with_priority(df: DataFrame, base: dict[str, int], score: dict[str, int], grade: dict[str, int], components: tuple[str, ...] = ("deck", "superstructure", "substructure")) -> DataFrame:
    """``df`` with ``priority`` by kind; component scores and grades have tables of their own, kinds they leave out keep the base."""
    table = lambda t: F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in t.items()], F.lit(None).cast("int"))
    is_score, is_grade = F.col("field").isin(*[c + "_score" for c in components]), F.col("field").isin(*[c + "_grade" for c in components])
    own = F.when(is_score, table(score)).when(is_grade | (F.col("field") == "overall_score"), table(grade))
    return df.withColumn("priority", F.coalesce(own, table(base), F.lit(0)))


def producible(df: DataFrame, components: tuple[str, ...] = ("deck", "superstructure", "substructure"), barred: tuple[str, ...] = ("paired_score_grade",)) -> DataFrame:
    """Candidates that may fill a field: evidence of structural indices never fills component scores or grades."""
    own = F.col("field").isin(*[c + s for c in components for s in ("_score", "_grade")])
    return df.where(~(own & F.col("kind").isin(*barred)))


def name_quality(value: Column) -> Column:
    """The lower, the better a name: complete, without words of the inspection's kind, short."""
    x = compact(value)
    noise = sum((F.when(x.contains(w), 1).otherwise(0) for w in V.NAME_NOISE), F.lit(0))
    return F.struct(F.when(x.endswith("匝道"), 1).otherwise(0).alias("open"), noise.alias("noise"), F.length(x).alias("length"))


def conclusion_quality(value: Column, parts: tuple[str, ...] = ("桥面", "上部结构", "下部结构", "主梁", "梁体", "桥台", "桥墩", "支座", "栏杆", "护栏", "顶板", "侧墙", "翼墙"), contents: tuple[str, ...] = ("基本资料", "结构建模", "计算说明", "验算结果", "静载试验", "动载试验", "目录", "页码")) -> Column:
    """The lower, the better a conclusion: no table of contents, many defects and parts named, short."""
    x = compact(value)
    hits = lambda words: sum((F.when(x.contains(w), 1).otherwise(0) for w in words), F.lit(0))
    defects, named = hits(V.DEFECTS), hits(parts)
    heads = F.regexp_count(x, F.lit("|".join(contents)))
    numbers = F.regexp_count(value, F.lit(r"(?:^|\s)\d+(?:\.\d+)+"))
    listing = ((heads >= 2) | (numbers >= 5)) & (defects <= 1)
    return F.struct(F.when(listing, 1).otherwise(0).alias("listing"), (-(defects + named)).alias("told"), F.length(x).alias("length"))


def selected(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """(keys, field, value, kind): the best candidate of every field by priority, non-blank first, then place.

    Names and conclusions are compared by their quality; overall scores with a scope take no part.  A score is spelled as an equal number
    with a fraction spells it, those of kind ``bci`` first.
    """
    scoped = (F.col("field") == "overall_score") & (F.coalesce("scope", F.lit("")) != "")
    x = df.where(~scoped).withColumn("_blank", F.trim(F.coalesce("value", F.lit(""))) == "")
    name = F.when(F.col("field") == "bridge_name", F.struct((-F.col("priority")).alias("p"), name_quality(F.col("value")).alias("q")))
    conclusion = F.when(F.col("field") == "overall_conclusion", conclusion_quality(F.col("value")))
    order = F.struct("_blank", name.alias("n"), conclusion.alias("c"), (-F.col("priority")).alias("p"), F.col(seq).alias("s"), "kind", "value")
    number = F.when(F.col("field").endswith("_score") & F.col("value").rlike(r"^[0-9.]+$"), plain_number(F.col("value")))
    x = x.withColumns({"_order": order, "_number": number})
    best = x.groupBy(*keys, "field").agg(F.min_by(F.struct("value", "kind", F.col("_number").alias("number")), "_order").alias("b"))
    spelled = x.where(F.col("_number").isNotNull() & F.col("value").contains(".")).groupBy(*keys, "field", F.col("_number").alias("number")).agg(F.min_by("value", F.struct((F.col("kind") != "bci").alias("k"), "_order")).alias("spelled"))
    out = best.select(*keys, "field", "b.value", "b.kind", "b.number").join(spelled, [*keys, "field", "number"], "left")
    return out.select(*keys, "field", F.coalesce("spelled", "value").alias("value"), "kind")


def quality_flags(df: DataFrame, records: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    """(keys, field, code): missing_value for required fields without a value, conflicting_candidates where values differ."""
    told = df.where(F.trim(F.coalesce("value", F.lit(""))) != "").groupBy(*keys, "field").agg(F.count_distinct("value").alias("n"))
    clash = told.where("n > 1").select(*keys, "field", F.lit("conflicting_candidates").alias("code"))
    wanted = records.select(*keys, F.explode(F.array(*map(F.lit, required))).alias("field"))
    return clash.unionByName(wanted.join(told, [*keys, "field"], "left_anti").select(*keys, "field", F.lit("missing_value").alias("code")))


def anchored_history(df: DataFrame, anchors: DataFrame, keys: list[str], field: str, value: str, prefix: str = "previous_") -> DataFrame:
    """``df`` with earlier values blanked, and ``suppressed`` set, in records that no history anchor vouches for."""
    x = df.join(anchors.select(*keys, F.lit(True).alias("_a")).distinct(), keys, "left")
    gone = F.col(field).startswith(prefix) & F.col("_a").isNull() & (F.coalesce(value, F.lit("")) != "")
    return x.withColumn("suppressed", gone).withColumn(value, F.when(gone, "").otherwise(F.col(value))).drop("_a")


def latest_scoped(df: DataFrame, keys: list[str], year: str, order: list[str], current: Column, scope: str, scopes: tuple[str, str], value: str, glue: str = "；") -> DataFrame:
    """(keys, year, value): of the years before the current one that have both scopes, the latest; its last value of each scope."""
    x = df.where((F.col(year) < current) & F.col(scope).isin(*scopes))
    last = lambda s: F.max_by(F.when(F.col(scope) == s, F.col(value)), F.when(F.col(scope) == s, F.struct(*order)))
    years = x.groupBy(*keys, year).agg(last(scopes[0]).alias("_a"), last(scopes[1]).alias("_b")).where("_a IS NOT NULL AND _b IS NOT NULL")
    both = F.concat(F.lit(scopes[0]), "_a", F.lit(glue + scopes[1]), "_b")
    return years.withColumn("_v", both).groupBy(*keys).agg(F.max(year).alias(year), F.max_by("_v", year).alias(value))
