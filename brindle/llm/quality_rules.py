"""Quality rules: a threshold table compiled into one projection.

Every rule bounds a ratio of two counts taken from the whole text.  Ratios are
compared as integer products, so no rounding decides a verdict.

Defined results: a null or blank text has no words and fails the base rule;
texts are never cut; repeated rows are judged one by one; columns beyond
``doc_id`` and ``text`` do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, let, words

SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the and of to in that it is for was with on as by be this are from at or an not "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es "
    "de la le et les en un une du que qui dans est pour pas sur par au avec ce "
    "el y los se del las una por con no su para al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= per * count / base <= high``; a bound of None does not hold."""

    name: str
    count: str
    base: str
    per: int
    low: int | None = None
    high: int | None = None


#: The threshold table.  Counts are named in ``counts``.
RULES = (
    Rule("mean word length", "word_chars", "n_words", 1, 2, 15),
    Rule("symbols per word", "n_symbols", "n_words", 100, None, 20),
    Rule("stop words", "n_stop", "n_words", 100, 2, None),
    Rule("repeated lines", "n_dup_lines", "n_lines", 100, None, 40),
    Rule("ellipsis lines", "n_ellipsis_lines", "n_lines", 100, None, 40),
    Rule("bullet lines", "n_bullet_lines", "n_lines", 100, None, 90),
    Rule("shouted marks", "n_shouts", "n_words", 100, None, 25),
)


#: Up to so many repeated hashes are looked up one by one; beyond, all windows are sorted.  The count is the same.
FEW = 32


def _covered(places: Column, width: int) -> Column:
    """How many words the windows at these ascending places cover together."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-width).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(width), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )


def _neighbours(s: Column, pair) -> Column:
    """What ``pair`` gives for neighbours in a sorted array, where it gives anything."""
    n = F.size(s) - 1
    return F.filter(F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, F.lit(2), n), pair), lambda x: x.isNotNull())


def repeated_window_words(ws: Column, width: int = 3) -> Column:
    """Words lying in a window of ``width`` words that the text holds twice or more.

    Sorted 64-bit window hashes show which windows may repeat; most texts have none and are
    done.  Windows are then compared word by word, sorted with their places: those with a
    repeated hash where such hashes are few, else all.  The work is n log n in the length of the text.
    """
    at = F.sequence(F.lit(0), F.size(ws) - width)
    parts = lambda i: [F.get(ws, i + k) for k in range(width)]
    hashes = F.transform(at, lambda i: F.xxhash64(*parts(i)))
    twice = lambda h: F.array_distinct(_neighbours(F.sort_array(h), lambda a, b: F.when(a == b, a)))
    looked_up = lambda h, t: F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(t, x), i)), lambda x: x.isNotNull())

    def by_words(places: Column) -> Column:
        windows = F.transform(places, lambda i: F.struct(F.concat_ws(" ", *parts(i)).alias("w"), i.alias("i")))
        same = lambda s: _neighbours(s, lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
        return _covered(let(F.sort_array(windows), lambda s: F.sort_array(F.array_distinct(F.flatten(same(s))))), width)

    pick = lambda h, t: F.when(F.size(t) == 0, F.lit(0)).when(F.size(t) <= FEW, by_words(looked_up(h, t))).otherwise(by_words(at))
    return F.when(F.size(ws) >= width, let(hashes, lambda h: let(twice(h), lambda t: pick(h, t)))).otherwise(F.lit(0)).cast("long")


def counts(text: Column) -> Column:
    """All counts of a text as one struct, built from built-in expressions only."""
    plain = F.coalesce(text, F.lit(""))
    bare = lambda x: F.translate(x, BLANKS, "")
    lines = F.filter(F.split(plain, "\n"), lambda x: bare(x) != "")

    def of(ws: Column, ls: Column) -> Column:
        some = lambda xs, p: F.size(F.filter(xs, p)).cast("long")
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.regexp_count(plain, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_window_words(ws).alias("n_repeat_words"),
            some(ws, lambda w: F.lower(w).isin(STOP_WORDS)).alias("n_stop"),
            F.size(ls).cast("long").alias("n_lines"),
            some(ls, lambda x: F.rtrim(x).endswith("...")).alias("n_ellipsis_lines"),
            some(ls, lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•")).alias("n_bullet_lines"),
            (F.length(plain) - F.length(F.replace(plain, F.lit("!"), F.lit("")))).cast("long").alias("n_shouts"),
        )

    return let(F.struct(words(text).alias("w"), lines.alias("l")), lambda x: of(x["w"], x["l"]))


def verdict(rules: tuple[Rule, ...], c) -> Column:
    """The threshold table as one boolean; a ratio over zero passes."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out &= c(r.count) * r.per >= c(r.base) * r.low
        if r.high is not None:
            out &= c(r.count) * r.per <= c(r.base) * r.high
    return out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """``docs`` with the counts, ``base_failed`` and ``kept``: one narrow projection, no shuffle."""
    found = docs.withColumn("_counts", counts(F.col("text")))
    c = lambda name: F.col(f"_counts.{name}")
    failed = (c("n_words") < min_words) | (c("n_repeat_words") * 100 > c("n_words") * max_repeat)
    names = [f.name for f in found.schema["_counts"].dataType.fields]
    return found.select(*[F.col(f"`{x}`") for x in docs.columns if x not in (*names, "base_failed", "kept")], *[c(x).alias(x) for x in names], failed.alias("base_failed"), (~failed & verdict(rules, c)).alias("kept"))


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The threshold table as SQL text."""
    tests = [f"{r.count} * {r.per} >= {r.base} * {r.low}" for r in rules if r.low is not None]
    tests += [f"{r.count} * {r.per} <= {r.base} * {r.high}" for r in rules if r.high is not None]
    return " AND ".join(tests)


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) AS c FROM g),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM t, (VALUES (0), (1), (2)) v(k) WHERE c > 1 GROUP BY rid),
f AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
  len(list_filter(ws, lambda x: lower(x) IN ({', '.join(f"'{x}'" for x in STOP_WORDS)})))::BIGINT AS n_stop,
  len(ls)::BIGINT AS n_lines, len(list_filter(ls, lambda x: rtrim(x, ' ') LIKE '%...'))::BIGINT AS n_ellipsis_lines,
  len(list_filter(ls, lambda x: ltrim(x, ' ')[1] IN ('-', '*', '•')))::BIGINT AS n_bullet_lines,
  length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_shouts
  FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT *, NOT base_failed AND {rules_sql()} AS kept FROM b"""
