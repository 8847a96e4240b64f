"""Defect rows: headers, validity, inheritance, duplicates, captions and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brindle.functions import vocabulary as V
from brindle.functions.reports import compact, contains_any
from brindle.functions.text import semantic_key


def header_fields(text: Column, headers=V.DEFECT_HEADERS, exact=V.EXACT_HEADERS) -> Column:
    """The fields that a header cell names: an alias that is the whole header, or a longer one inside it."""
    key = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\W_]+", ""))
    named = lambda a: (key == a) if a in exact or len(a) < 2 else key.contains(a)

    def any_of(names) -> Column:
        out = F.lit(False)
        for a in names:
            out = out | named(a)
        return out

    return F.array_compact(F.array(*[F.when(any_of(names), F.lit(f)) for f, names in headers]))


def header_rows(cells: DataFrame, table: list[str], row: str, column: str, text: str) -> DataFrame:
    """(table, row, field, column, ambiguous): every header row's fields, the leftmost column first; more than one column is ambiguous."""
    named = cells.select(*table, row, column, F.explode(header_fields(F.col(text))).alias("field"))
    return named.groupBy(*table, row, "field").agg(F.min(column).alias(column), (F.count_distinct(column) > 1).alias("ambiguous"))


def positional_columns(cells: DataFrame, table: list[str], row: str, column: str, span: str, fields: list[str]) -> DataFrame:
    """(table, field, column) for tables without headers: fields in order over the columns of the widest row, the first of equals."""
    covered = cells.select(*table, row, F.explode(F.sequence(F.col(column), F.col(column) + F.greatest(F.col(span), F.lit(1)) - 1)).alias("c"))
    rows = covered.groupBy(*table, row).agg(F.sort_array(F.collect_set("c")).alias("cs"))
    widest = rows.groupBy(*table).agg(F.max_by("cs", F.struct(F.size("cs"), -F.col(row))).alias("cs"))
    pairs = F.transform(F.slice("cs", 1, len(fields)), lambda c, i: F.struct(F.get(F.array(*map(F.lit, fields)), i).alias("field"), c.alias("column")))
    return widest.select(*table, F.inline(pairs))


def carried_columns(cells: DataFrame, headers: DataFrame, table: list[str], row: str, column: str, span: str, text: str) -> DataFrame:
    """(table, row, field, text): the cell under each field's latest header; rows before the first header, and headers themselves, give none.

    A cell stands under a header column when its span covers it.
    """
    marks = headers.select(*table, row, "field", column).groupBy(*table, row).pivot("field", [f for f, _ in V.DEFECT_HEADERS]).agg(F.min(column))
    rows = cells.select(*table, row).distinct().join(marks.withColumn("_head", F.lit(True)), [*table, row], "left")
    so_far = Window.partitionBy(*table).orderBy(row).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    names = [f for f, _ in V.DEFECT_HEADERS]
    known = rows.select(*table, row, "_head", *[F.last(f, ignorenulls=True).over(so_far).alias(f) for f in names]).where("_head IS NULL")
    wanted = known.select(*table, row, F.inline(F.filter(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("_at")) for f in names]), lambda x: x["_at"].isNotNull())))
    under = (F.col(column) <= F.col("_at")) & (F.col("_at") < F.col(column) + F.greatest(F.col(span), F.lit(1)))
    return wanted.join(cells, [*table, row]).where(under).groupBy(*table, row, "field").agg(F.min_by(text, column).alias(text))


def figure_references(x: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(V.FIGURE), F.lit(1)))


def without_figures(x: Column) -> Column:
    return F.regexp_replace(F.coalesce(x, F.lit("")), V.FIGURE, "")


def row_issue(index: Column, location: Column, kind: Column, description: Column, repeated_header: Column, ambiguous: Column, own: Column | None = None) -> Column:
    """Why a row is no defect: placeholder, repeated_header, photo_caption, unit_or_placeholder or non_defect_state; null for a defect.

    A row under ambiguous headers is kept for review rather than judged by its words.  ``own`` lists the row's own texts, before
    any were taken from above; a row of placeholders only is none, whatever it took.
    """
    t = lambda c: F.trim(F.coalesce(c, F.lit("")))
    i, place, k, d = t(index), t(location), t(kind), t(description)
    whole = F.concat(i, place, k, d)
    caption = i.rlike(V.CAPTION) & ((d == "") | (d == i))
    empty = lambda x: x.rlike(V.UNIT_ROW) | x.rlike(V.PLACEHOLDER)
    layout = (whole != "") & empty(whole) if own is None else (F.size(own) > 0) & F.forall(own, empty)
    both = F.trim(F.concat_ws(" ", k, d))
    formal = k.isin(*V.FORMAL_STATES)
    concrete = F.when((both == "") | k.rlike(V.PLACEHOLDER), False).when(contains_any(both, V.NO_DEFECT), contains_any(k, V.DEFECT_TERMS) | formal).otherwise(contains_any(both, V.DEFECT_TERMS) | formal)
    return F.when(whole == "", "placeholder").when(repeated_header, "repeated_header").when(caption, "photo_caption").when(layout, "unit_or_placeholder").when(~concrete & ~ambiguous, "non_defect_state")


def with_side(location: Column, description: Column, section: Column) -> Column:
    """A location with the side that its description begins with; a bare side gets the section's name."""
    sides = "^(" + "|".join(V.SIDES) + ")"
    place = F.coalesce(location, F.lit(""))
    side = F.regexp_extract(F.coalesce(description, F.lit("")), sides, 1)
    sided = F.when((place != "") & (side != "") & ~place.rlike(sides), F.concat(side, place)).otherwise(place)
    bare = sided.isin("左幅", "右幅") & (F.coalesce(section, F.lit("")) != "")
    return F.when(bare, F.concat(sided, section)).otherwise(sided)


def numbered(df: DataFrame, document: list[str], order: list, index: str) -> DataFrame:
    """Blank display numbers become the row's place in its document."""
    place = F.row_number().over(Window.partitionBy(*document).orderBy(*order)).cast("string")
    return df.withColumn(index, F.when(F.trim(F.coalesce(index, F.lit(""))) == "", place).otherwise(F.col(index)))


def distinct_observations(df: DataFrame, document: list[str], order: list[str], location: str, kind: str, description: str, evidence: str) -> DataFrame:
    """Observations of a document without repeats: (document, location, kind, description, evidence, n_merged).

    Two of one place and type are one when their descriptions are equal, share a figure, or contain each other (both of four
    characters or more).  The first stays as it is and gathers the evidence of the others; each row is held against those kept.
    The rows of one place and type of a document meet in one row.
    """
    core = semantic_key(F.col(description))
    item = F.struct(*order, F.col(location).alias("l"), F.col(kind).alias("k"), F.col(description).alias("d"), core.alias("core"), figure_references(F.col(description)).alias("figures"), F.array(evidence).alias("e"))
    listed = df.select(*document, semantic_key(F.col(location)).alias("_l"), semantic_key(F.col(kind)).alias("_k"), item.alias("i")).groupBy(*document, "_l", "_k").agg(F.sort_array(F.collect_list("i")).alias("items"))
    long = lambda a, b: (F.length(a) >= 4) & (F.length(b) >= 4)
    same = lambda a, b: ((a["core"] != "") & (a["core"] == b["core"])) | F.arrays_overlap(a["figures"], b["figures"]) | (long(a["core"], b["core"]) & (a["core"].contains(b["core"]) | b["core"].contains(a["core"])))
    none = F.slice("items", 1, 0)
    first = lambda acc, x: F.array_min(F.filter(F.transform(acc, lambda y, n: F.when(same(y, x), n)), lambda n: n.isNotNull()))

    def step(acc: Column, x: Column) -> Column:
        at = first(acc, x)
        grown = F.transform(acc, lambda y, n: F.when(n == at, y.withField("e", F.array_union(y["e"], x["e"]))).otherwise(y))
        return F.when(at.isNull(), F.array_append(acc, x)).otherwise(grown)

    out = listed.select(*document, F.inline(F.aggregate("items", none, step)))
    return out.select(*document, *order, F.col("l").alias(location), F.col("k").alias(kind), F.col("d").alias(description), F.col("e").alias(evidence))


def distinct_recommendations(df: DataFrame, document: list[str], order: list[str], content: str, location: str, category: str) -> DataFrame:
    """Recommendations of a document without repeats; the kept one takes the longer content and place, and the first category stated.

    Two are one when their contents, without numbering, titles of standards, urging words and marks, are equal or contain each other
    (both of eight characters or more), and their places are compatible: one blank, equal, or inside the other.
    """
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(compact(F.col(content)), V.ITEM_LABEL, ""), "《[^》]+》", ""), "^(?:建议|应|需|须|及时|尽快|立即|对|对于|针对)", ""), r"[，,。；;：:、（）()\s]", "")
    item = F.struct(*order, F.coalesce(content, F.lit("")).alias("c"), F.coalesce(location, F.lit("")).alias("l"), F.coalesce(category, F.lit("")).alias("g"), bare.alias("key"), compact(F.col(location)).alias("place"))
    listed = df.select(*document, item.alias("i")).groupBy(*document).agg(F.sort_array(F.collect_list("i")).alias("items"))
    inside = lambda a, b: a.contains(b) | b.contains(a)
    same = lambda a, b: ((a["key"] == b["key"]) | ((F.least(F.length(a["key"]), F.length(b["key"])) >= 8) & inside(a["key"], b["key"]))) & inside(a["place"], b["place"])
    first = lambda acc, x: F.array_min(F.filter(F.transform(acc, lambda y, n: F.when(same(y, x), n)), lambda n: n.isNotNull()))

    def grow(y: Column, x: Column) -> Column:
        keeps = F.length(y["c"]) >= F.length(x["c"])
        far = F.length(x["place"]) > F.length(y["place"])
        y = y.withField("c", F.when(keeps, y["c"]).otherwise(x["c"])).withField("key", F.when(keeps, y["key"]).otherwise(x["key"]))
        return y.withField("l", F.when(far, x["l"]).otherwise(y["l"])).withField("place", F.when(far, x["place"]).otherwise(y["place"])).withField("g", F.when(y["g"] == "", x["g"]).otherwise(y["g"]))

    def step(acc: Column, x: Column) -> Column:
        at = first(acc, x)
        return F.when(at.isNull(), F.array_append(acc, x)).otherwise(F.transform(acc, lambda y, n: F.when(n == at, grow(y, x)).otherwise(y)))

    out = listed.select(*document, F.inline(F.aggregate("items", F.slice("items", 1, 0), step)))
    return out.select(*document, *order, F.col("c").alias(content), F.col("l").alias(location), F.col("g").alias(category))


def component(location: Column, terms=V.COMPONENT_TERMS) -> Column:
    """The structural component of a place, by the first group one of whose words it holds; null for none."""
    return F.coalesce(*[F.when(contains_any(F.coalesce(location, F.lit("")), ws), F.lit(c)) for c, ws in terms])


def disease_terms(x: Column, terms=V.DEFECT_TERMS, most: int = 6) -> Column:
    """The defect words of a text, longest first; a word inside one that is kept is not told again."""
    words = sorted(dict.fromkeys(t for t in terms if len(t) > 1 and not t.startswith("无")), key=lambda t: (-len(t), t))
    found = F.filter(F.array(*map(F.lit, words)), lambda w: x.contains(w))
    kept = F.aggregate(found, F.array().cast("array<string>"), lambda acc, w: F.when(F.exists(acc, lambda k: k.contains(w)), acc).otherwise(F.array_append(acc, w)))
    return F.slice(kept, 1, most)


def best_history(defects: DataFrame, history: DataFrame, document: list[str], key: str, order: str) -> DataFrame:
    """(document, key, order, score): the earlier finding that a defect continues, the first of equals.

    ``defects`` has location, defect_type and description, ``history`` location, previous, current and development.  Only findings
    that share a defect word or the type count: 8 for the component, 12 for a named place, 3 a word, 5 for the type.  Rows
    meet within their document.
    """
    text = F.concat_ws(" ", "location", "defect_type", "description")
    told = F.concat_ws(" ", F.col("h.current"), F.col("h.development"), F.col("h.previous"))
    places = F.array_distinct(F.regexp_extract_all(F.coalesce("location", F.lit("")), F.lit(V.LOCATION_TOKEN), F.lit(0)))
    d = defects.select(*document, key, F.coalesce("defect_type", F.lit("")).alias("_t"), component(F.col("location")).alias("_c"), disease_terms(text).alias("_w"), F.transform(places, compact).alias("_p"))
    h = history.select(*document, order, F.struct("location", "previous", "current", "development").alias("h"))
    met = d.join(h, document).withColumn("_told", told)
    hits = F.size(F.filter("_w", lambda w: F.col("_told").contains(w)))
    typed = (F.col("_t") != "") & F.col("_told").contains(F.col("_t"))
    placed = F.exists("_p", lambda p: compact(F.col("_told")).contains(p))
    of = F.col("_c").isNotNull() & F.coalesce(F.col("h.location"), F.lit("")).contains(F.col("_c"))
    score = F.when(of, 8).otherwise(0) + F.when(placed, 12).otherwise(0) + 3 * hits + F.when(typed, 5).otherwise(0)
    ranked = met.withColumn("score", score).where((hits > 0) | typed)
    return ranked.groupBy(*document, key).agg(F.max_by(F.struct(order, "score"), F.struct("score", (-F.col(order)).alias("o"))).alias("b")).select(*document, key, f"b.{order}", "b.score")


def caption_owner(captions: DataFrame, defects: DataFrame, document: list[str], caption: str, row: str, key: str) -> DataFrame:
    """(document, caption, key): the defect that a caption row documents, if any.

    ``captions`` and ``defects`` have ``row`` and ``description``.  A shared figure number wins, the latest defect first; then the nearest
    defect above whose description contains or is contained (four characters or more); then the first such one.
    """
    core = lambda: semantic_key(without_figures(F.col("description")))
    c = captions.select(*document, caption, F.col(row).alias("_cr"), figure_references(F.col("description")).alias("_cf"), core().alias("_cc"))
    d = defects.select(*document, key, F.col(row).alias("_dr"), figure_references(F.col("description")).alias("_df"), core().alias("_dc"))
    met = c.join(d, document)
    shared = F.arrays_overlap("_cf", "_df")
    inside = (F.length("_dc") >= 4) & (F.col("_cc") != "") & (F.col("_cc").contains(F.col("_dc")) | F.col("_dc").contains(F.col("_cc")))
    above = F.col("_cr") - F.col("_dr")
    tier = F.when(shared, F.struct(F.lit(0).alias("t"), (-F.col(key)).cast("long").alias("o"))).when(inside & (above >= 0), F.struct(F.lit(1).alias("t"), (above * 1000000 + F.col(key)).cast("long").alias("o"))).when(inside, F.struct(F.lit(2).alias("t"), F.col(key).cast("long").alias("o")))
    ranked = met.withColumn("_tier", tier).where("_tier IS NOT NULL")
    return ranked.groupBy(*document, caption).agg(F.min_by(key, "_tier").alias(key))


def located_tables(tables: DataFrame, document: list[str], routed: str, looks: str) -> DataFrame:
    """The defect tables of a document with ``used_fallback``: routed ones that look right, else any that look right, else the routed ones."""
    doc = Window.partitionBy(*document)
    good = F.max((F.col(routed) & F.col(looks)).cast("int")).over(doc)
    some = F.max(F.col(looks).cast("int")).over(doc)
    take = F.when(good == 1, F.col(routed) & F.col(looks)).when(some == 1, F.col(looks)).otherwise(F.col(routed))
    return tables.withColumn("used_fallback", good == 0).withColumn("_take", take).where("_take").drop("_take")
