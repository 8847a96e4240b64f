"""Dictionary classification: ordered cascades, longest keyword, suffixes.  Dictionaries are data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def longest_keyword(text: Column, dictionary: list[tuple[str, str]]) -> Column:
    """The category of the longest keyword contained; among equal lengths the first listed.

    The dictionary becomes one ordered expression, so no join multiplies the rows.
    """
    order = sorted(range(len(dictionary)), key=lambda i: (-len(dictionary[i][0]), i))
    return F.coalesce(*[F.when(text.contains(dictionary[i][0]), F.lit(dictionary[i][1])) for i in order], F.lit(None).cast("string"))


def cascade(text: Column, rules: list[tuple[str, str]], otherwise: str | None = None) -> Column:
    """The label of the first pattern found."""
    return F.coalesce(*[F.when(text.rlike(p), F.lit(label)) for p, label in rules], F.lit(otherwise).cast("string"))


def by_suffix(text: Column, suffixes: list[tuple[str, str]]) -> Column:
    """The label of the first listed suffix that the text ends with."""
    return F.coalesce(*[F.when(text.endswith(s), F.lit(label)) for s, label in suffixes], F.lit(None).cast("string"))
