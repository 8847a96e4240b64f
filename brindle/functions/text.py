"""Text normal forms and small scalar rules, as column expressions.

Unicode normal form and case folding have no built-in counterpart; one Arrow function does
both, and everything after it stays in the engine.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"


def _folder():
    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        import unicodedata

        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).casefold())

    return fold


def fold(x: Column) -> Column:
    """NFKC and full case folding; null stays null.

    ASCII texts are folded in the engine; only the others cross to the Arrow function, as nulls in between cost nothing there.
    """
    x = x.cast("string")
    plain = x.rlike(r"^\p{ASCII}*$")
    return F.when(plain, F.lower(x)).otherwise(_folder()(F.when(~plain, x)))


def plain_number(x: Column) -> Column:
    """A decimal string without needless zeros (87.060 becomes 87.06); other strings as they are."""
    cut = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"^\+", ""), r"^(-?)0+(?=[0-9])", "$1"), r"^(-?)\.", "$10.")
    fraction = F.when(F.instr(cut, ".") > 0, F.regexp_replace(cut, r"\.?0*$", "")).otherwise(cut)
    return F.when(x.rlike(NUMBER), F.when(fraction.isin("", "-"), "0").otherwise(fraction)).otherwise(x)


def normalize_text(x: Column) -> Column:
    """Folded, without any white space, numbers in plain form; null becomes empty."""
    return plain_number(F.regexp_replace(F.coalesce(fold(x), F.lit("")), r"(?U)\s+", ""))


def semantic_key(x: Column) -> Column:
    """Folded letters and digits only: the identity under which labels and headers are compared."""
    return F.regexp_replace(F.coalesce(fold(x), F.lit("")), r"(?U)[\W_]+", "")


def is_missing(x: Column, vocabulary: tuple[str, ...] = ("", "none", "null", "nan", "n/a")) -> Column:
    """Null, or one of the words that stand for nothing."""
    return x.isNull() | F.lower(F.trim(x)).isin(*vocabulary)


def field_state(present: Column, applicable: Column, value: Column, none_value) -> Column:
    """present, explicit_none, not_applicable or not_extracted."""
    return F.when(~applicable, "not_applicable").when(~present | value.isNull(), "not_extracted").when(value == none_value, "explicit_none").otherwise("present")


#: Lower bounds of the grade bands, highest first; below the last is the rest grade.
BANDS = (("A", 90), ("B", 80), ("C", 70), ("D", 60))


def grade(score: Column, bands=BANDS, rest: str = "E") -> Column:
    """The band of a decimal score; null for none."""
    out = F.lit(rest)
    for name, low in reversed(bands):
        out = F.when(score >= F.lit(low).cast("decimal(18,6)"), F.lit(name)).otherwise(out)
    return F.when(score.isNotNull(), out)


def grade_change(score: Column, reported: Column) -> Column:
    """How the banded grade treats a reported one: preserved, filled or mapped."""
    banded = grade(score)
    return F.when(banded.isNull(), "preserved").when(is_missing(reported), "filled").when(reported == banded, "preserved").otherwise("mapped")


def shorten(x: Column, limit: int, head: float = 0.7) -> Column:
    """At most ``limit`` characters: a head, an ellipsis and a tail."""
    first = int(limit * head)
    return F.when(F.length(x) <= limit, x).otherwise(F.concat(F.left(x, F.lit(first)), F.lit("…"), F.right(x, F.lit(limit - first - 1))))


def redact_paths(x: Column) -> Column:
    """Absolute paths give way to a digest of the whole text."""
    return F.when(x.rlike(r"^(/|[A-Za-z]:[\\/]|file:|https?://)"), F.concat(F.lit("sha256:"), F.left(F.sha2(x, 256), F.lit(16)))).otherwise(x)


def stable_id(prefix: str, *parts: Column) -> Column:
    """A short identity from the contents of a record: the digest of its parts as a JSON array of texts, so no mark can join two parts."""
    return F.concat(F.lit(prefix + ":"), F.left(F.sha2(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 256), F.lit(20)))


def fact_tokens(x: Column) -> Column:
    """Tokens of a normal form: ASCII words, and character pairs of CJK runs (a single character stays)."""
    runs = F.regexp_extract_all(x, F.lit(r"[a-z0-9]+(?:[._/-][a-z0-9]+)*|[\x{3400}-\x{9fff}]+"), F.lit(0))
    cjk = lambda t: t.rlike(r"^[\x{3400}-\x{9fff}]") & (F.length(t) > 1)
    pairs = lambda t: F.transform(F.sequence(F.lit(1), F.length(t) - 1), lambda i: F.substring(t, i, F.lit(2)))
    out = F.flatten(F.transform(runs, lambda t: F.when(cjk(t), pairs(t)).otherwise(F.array(t))))
    return F.when((F.size(out) == 0) & (x != ""), F.array(x)).otherwise(out)


DATE = r"([0-9]{4})\s*[年./-]\s*0?([0-9]{1,2})\s*[月./-]\s*0?([0-9]{1,2})"


def normal_date(value: Column) -> Column:
    """The last date of a text, so the end of a range, without padding; null where there is none."""
    parts = [F.try_element_at(F.regexp_extract_all(value, F.lit(DATE), F.lit(i)), F.lit(-1)) for i in (1, 2, 3)]
    return F.concat(parts[0], F.lit("年"), parts[1], F.lit("月"), parts[2], F.lit("日"))
