"""Scores and diagnoses of predicted records against true ones, sample by sample and as a whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.functions import text as T
from brindle.functions import vocabulary as V
from brindle.operators import matching


def map_counts(gold: DataFrame, predicted: DataFrame, keys: list[str], field: str, value: str) -> DataFrame:
    """(field, tp, fp, fn) over (keys, field, value) rows: a differing value is a false positive and a false negative."""
    m = gold.select(*keys, field, F.col(value).alias("_g")).join(predicted.select(*keys, field, F.col(value).alias("_p")), [*keys, field], "full")
    same = F.coalesce(F.col("_g") == F.col("_p"), F.lit(False))
    return m.groupBy(field).agg(F.count_if(same).alias("tp"), F.count_if(F.col("_p").isNotNull() & ~same).alias("fp"), F.count_if(F.col("_g").isNotNull() & ~same).alias("fn"))


def fact_pairs(gold: DataFrame, predicted: DataFrame, keys: list[str], item: str, text: str) -> DataFrame:
    """(keys, gold_item, predicted_item, shared, dice): all pairs of a sample's facts that share tokens.

    Facts are multisets of ``fact_tokens``; they meet by an equality join over the tokens of their sample.
    """

    def counted(df: DataFrame, name: str, n: str, total: str) -> DataFrame:
        tokens = df.select(*keys, F.col(item).alias(name), T.fact_tokens(T.normalize_text(F.col(text))).alias("ts"))
        one = tokens.select(*keys, name, F.size("ts").cast("long").alias(total), F.explode("ts").alias("w"))
        return one.groupBy(*keys, name, "w").agg(F.count("*").alias(n), F.first(total).alias(total))

    g, p = counted(gold, "gold_item", "gn", "gt"), counted(predicted, "predicted_item", "pn", "pt")
    met = g.join(p, [*keys, "w"]).groupBy(*keys, "gold_item", "predicted_item").agg(F.sum(F.least("gn", "pn")).alias("shared"), F.first("gt").alias("gt"), F.first("pt").alias("pt"))
    return met.withColumn("dice", 2 * F.col("shared") / (F.col("gt") + F.col("pt")))


def fact_counts(gold: DataFrame, predicted: DataFrame, keys: list[str], item: str, text: str) -> DataFrame:
    """(keys, tp, fp, fn) of tokens: facts pair off greedily by their Dice score, then by shared tokens, then in order."""
    pairs = fact_pairs(gold, predicted, keys, item, text)
    order = [-F.col("dice"), -F.col("shared"), F.col("gold_item"), F.col("predicted_item")]
    chosen = matching.greedy_pairs(pairs, keys, "gold_item", "predicted_item", order)
    tp = chosen.join(pairs.select(*keys, "gold_item", "predicted_item", "shared"), [*keys, "gold_item", "predicted_item"]).groupBy(*keys).agg(F.sum("shared").alias("tp"))
    size = F.size(T.fact_tokens(T.normalize_text(F.col(text)))).cast("long")
    sides = gold.select(*keys, size.alias("g"), F.lit(0).cast("long").alias("p")).unionByName(predicted.select(*keys, F.lit(0).cast("long").alias("g"), size.alias("p")))
    totals = sides.groupBy(*keys).agg(F.sum("g").alias("g"), F.sum("p").alias("p")).join(tp, keys, "left")
    hit = F.coalesce("tp", F.lit(0)).cast("long")
    return totals.select(*keys, hit.alias("tp"), (F.col("p") - hit).alias("fp"), (F.col("g") - hit).alias("fn"))


def section_scores(counts: DataFrame, sample: str, section: str, weights: dict[str, float] | None = None) -> DataFrame:
    """(sample, section, tp, fp, fn, precision, recall, f1, score): ``score`` is the rounded F1 times the section's weight."""
    weights = weights or V.SECTION_WEIGHTS
    w = F.coalesce(*[F.when(F.col(section) == k, F.lit(float(v))) for k, v in weights.items()], F.lit(0.0))
    out = counts.select(sample, section, "tp", "fp", "fn", *matching.metrics(F.col("tp"), F.col("fp"), F.col("fn")))
    return out.withColumn("score", F.bround(F.col("f1") * w, 6))


def record_totals(scores: DataFrame, sample: str) -> DataFrame:
    """(sample, total): the sum of a record's section scores; ``scores`` comes from ``section_scores``."""
    return scores.groupBy(sample).agg(F.bround(F.sum("score"), 6).alias("total"))


def dataset_scores(scores: DataFrame, sample: str, section: str, weights: dict[str, float] | None = None) -> DataFrame:
    """A row a section and one of all (``section`` null): pooled metrics and score (micro), the mean F1 of the samples and its score (macro).

    The totals are sums of rounded section scores, and the mean of the records' totals.
    """
    weights = weights or V.SECTION_WEIGHTS
    each = matching.micro_macro(scores, sample, section, weights)
    each = each.withColumns({c: F.col(c).cast("long") for c in ("tp", "fp", "fn")})
    micro = each.agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")], F.bround(F.sum("micro_score"), 6).alias("micro_score"))
    macro = record_totals(scores, sample).agg(F.bround(F.avg("total"), 6)).first()[0]
    whole = micro.select(F.lit(None).cast("string").alias(section), "tp", "fp", "fn", *matching.metrics(F.col("tp"), F.col("fp"), F.col("fn")), F.lit(None).cast("double").alias("macro_f1"), "micro_score", F.lit(macro).cast("double").alias("macro_score"))
    return each.unionByName(whole)


def partial_total(scores: DataFrame, sample: str, section: str, sections: tuple[str, ...] = ("summary", "recommendations", "defects"), weight: float = 70.0) -> DataFrame:
    """(sample, total): the score of the structured sections, scaled to 100."""
    return scores.where(F.col(section).isin(*sections)).groupBy(sample).agg(F.bround(F.sum("score") / weight * 100, 6).alias("total"))


# ---- tolerant pairing of rows


def _listed(df: DataFrame, sample: str, order: str, index: str, fields: list[str], name: str) -> DataFrame:
    row = F.struct(F.col(order).cast("long").alias("no"), F.coalesce(T.normalize_text(F.col(index).cast("string")), F.lit("")).alias("index"), F.array(*[F.coalesce(T.normalize_text(F.col(f).cast("string")), F.lit("")) for f in fields]).alias("v"))
    return df.select(sample, row.alias("_r")).groupBy(sample).agg(F.sort_array(F.collect_list("_r")).alias(name))


def _closeness(g: Column, p: Column, fields: list[str]) -> Column:
    """(identity fields equal, fields equal, values in other fields, shared values, index equal); null where nothing tells that two rows are one."""
    m = len(fields)
    of = lambda i: (g["v"][i] != "") & (g["v"][i] == p["v"][i])
    add = lambda xs: sum((F.when(x, 1).otherwise(0) for x in xs), F.lit(0))
    same = add(of(i) for i in range(m))
    identity = add(of(i) for i, f in enumerate(fields) if f not in ("description", "content"))
    crossed = lambda i: F.exists(F.array_compact(F.array(*[g["v"][j] for j in range(m) if j != i])), lambda x: x == p["v"][i])
    cross = add((p["v"][i] != "") & crossed(i) for i in range(m))
    times = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    values = F.array_distinct(F.filter(g["v"], lambda x: x != ""))
    shared = F.aggregate(F.transform(values, lambda x: F.least(times(g["v"], x), times(p["v"], x))), F.lit(0), lambda a, n: a + n)
    index = F.when((g["index"] != "") & (g["index"] == p["index"]), 1).otherwise(0)
    told = (identity > 0) | (same > 0) | (cross > 0) | ((index > 0) & (shared > 0))
    return F.when(told, F.struct(identity.alias("a"), same.alias("b"), cross.alias("c"), shared.alias("d"), index.alias("e")))


def pair_rows(gold: DataFrame, predicted: DataFrame, sample: str, order: str, index: str, fields: list[str]) -> DataFrame:
    """(sample, gold_no, predicted_no, ambiguous, gold_values, predicted_values): rows of a sample paired one to one.

    True rows choose in order, each the closest row left; of equally close ones the first, which is then
    ambiguous.  Rows without a partner have a null on the other side.  A sample's rows are the items of one
    document and meet in one row.
    """
    both = _listed(gold, sample, order, index, fields, "g").join(_listed(predicted, sample, order, index, fields, "p"), sample, "full")
    none = F.array().cast("array<struct<g:bigint,p:bigint,ties:boolean>>")
    g, p = F.coalesce("g", F.array().cast("array<struct<no:bigint,index:string,v:array<string>>>")), F.coalesce("p", F.array().cast("array<struct<no:bigint,index:string,v:array<string>>>"))

    def step(acc: Column, x: Column) -> Column:
        free = F.filter(p, lambda y: ~F.exists(acc, lambda q: q["p"] == y["no"]))
        close = F.filter(F.transform(free, lambda y: F.struct(_closeness(x, y, fields).alias("c"), (-y["no"]).alias("no"))), lambda z: z["c"].isNotNull())
        best = lambda zs: F.array_max(zs)
        found = F.transform(F.array(close), lambda zs: F.when(F.size(zs) > 0, F.struct(x["no"].alias("g"), (-best(zs)["no"]).alias("p"), (F.size(F.filter(zs, lambda z: z["c"] == best(zs)["c"])) > 1).alias("ties"))))[0]
        return F.when(found.isNotNull(), F.array_append(acc, found)).otherwise(acc)

    x = both.select(sample, g.alias("g"), p.alias("p")).withColumn("pairs", F.aggregate(g, none, step))
    row = lambda xs, no: F.get(F.filter(xs, lambda y: y["no"] == no), F.lit(0))["v"]
    out = lambda gn, pn, ties, gv, pv: F.struct(gn.alias("gold_no"), pn.alias("predicted_no"), ties.alias("ambiguous"), gv.alias("gold_values"), pv.alias("predicted_values"))
    nil, no = F.lit(None).cast("bigint"), F.lit(False)
    empty = F.lit(None).cast("array<string>")
    paired = F.transform("pairs", lambda q: out(q["g"], q["p"], q["ties"], row(F.col("g"), q["g"]), row(F.col("p"), q["p"])))
    missing = F.transform(F.filter("g", lambda y: ~F.exists("pairs", lambda q: q["g"] == y["no"])), lambda y: out(y["no"], nil, no, y["v"], empty))
    extra = F.transform(F.filter("p", lambda y: ~F.exists("pairs", lambda q: q["p"] == y["no"])), lambda y: out(nil, y["no"], no, empty, y["v"]))
    return x.select(sample, F.inline(F.concat(paired, missing, extra)))


def field_statuses(pairs: DataFrame, sample: str, fields: list[str]) -> DataFrame:
    """(sample, gold_no, predicted_no, field, status) for every field of every pair or single row of ``pair_rows``."""
    g, p = (lambda i: F.col("gold_values")[i]), (lambda i: F.col("predicted_values")[i])

    def status(i: int, f: str) -> Column:
        others = [j for j in range(len(fields)) if j != i]
        moved = lambda x, side: (x != "") & F.exists(F.array(*[side(j) for j in others]), lambda y: y == x)
        differs = "description_difference" if f in ("description", "content") else "value_difference"
        return (
            F.when(F.col("predicted_no").isNull(), "missing").when(F.col("gold_no").isNull(), "extra").when(g(i) == p(i), "matched")
            .when(moved(p(i), g) | moved(g(i), p), "wrong_column").otherwise(differs)
        )

    each = F.inline(F.array(*[F.struct(F.lit(f).alias("field"), status(i, f).alias("status")) for i, f in enumerate(fields)]))
    return pairs.select(sample, "gold_no", "predicted_no", each)


def row_counts(pairs: DataFrame, sample: str) -> DataFrame:
    """(sample, tp, fp, fn, matched_rows, paired_rows, missing_rows, extra_rows, ambiguous): a pair that differs counts against both sides."""
    exact = F.col("gold_values") == F.col("predicted_values")
    pair, lost, more = F.col("gold_no").isNotNull() & F.col("predicted_no").isNotNull(), F.col("predicted_no").isNull(), F.col("gold_no").isNull()
    n = lambda c, name: F.count_if(c).alias(name)
    return pairs.groupBy(sample).agg(n(pair & exact, "tp"), n((pair & ~exact) | more, "fp"), n((pair & ~exact) | lost, "fn"), n(pair & exact, "matched_rows"), n(pair & ~exact, "paired_rows"), n(lost, "missing_rows"), n(more, "extra_rows"), n("ambiguous", "ambiguous"))


def bucketed(counts: DataFrame, bucket: Column, others: list[str], sums: list[str], bounds_name: str = "bucket") -> DataFrame:
    """Sums by bucket, by each other label and over all, as grouping sets of one pass; ``n_records`` is the number of records."""
    x = counts.withColumn(bounds_name, bucket)
    keys = [F.col(bounds_name), *[F.col(o) for o in others]]
    return x.groupingSets([*[[k] for k in keys], []], *keys).agg(F.count("*").alias("n_records"), *[F.sum(s).alias(s) for s in sums])


def size_bucket(n: Column, bounds: tuple[int, ...] = (0, 10, 50)) -> Column:
    """0, 1-10, 11-50, 51+ for the usual bounds."""
    out, low = F.when(n <= bounds[0], str(bounds[0])), bounds[0]
    for b in bounds[1:]:
        out, low = out.when(n <= b, f"{low + 1}-{b}"), b
    return out.otherwise(f"{low + 1}+")


def summed_maps(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """One map a key that adds up the counters of all its maps."""
    one = df.select(*keys, F.explode(column).alias("k", "n")).groupBy(*keys, "k").agg(F.sum("n").alias("n"))
    return one.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n")))).alias(column))


# ---- alignment


def align_paths(manifest: DataFrame, predictions: DataFrame, sample: str, source: str, file: str) -> DataFrame:
    """(sample, source, file, status): manifest paths with the prediction whose path is theirs, or ends one the other.

    Paths meet by their last part, then are compared; anything but one free match is missing or ambiguous, and a
    prediction that two samples claim is ambiguous for both.
    """
    clean = lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), r"\\", "/"), r"^(\./)+", "")
    last = lambda c: F.element_at(F.split(c, "/"), -1)
    m = manifest.select(sample, clean(F.col(source)).alias("_s")).withColumn("_n", last(F.col("_s")))
    p = predictions.select(clean(F.col(file)).alias("_f")).withColumn("_n", last(F.col("_f")))
    from brindle.functions.reports import same_path

    met = m.join(p, "_n").where(same_path(F.col("_s"), F.col("_f"))).select(sample, "_s", "_f")
    per = met.groupBy(sample, "_s").agg(F.count("*").alias("n"), F.min("_f").alias("_f"))
    claims = per.groupBy("_f").agg(F.count("*").alias("claims"))
    out = m.select(sample, "_s").join(per, [sample, "_s"], "left").join(claims, "_f", "left")
    status = F.when(F.col("n").isNull(), "missing").when((F.col("n") > 1) | (F.col("claims") > 1), "ambiguous").otherwise("aligned")
    return out.select(sample, F.col("_s").alias(source), F.when(status == "aligned", F.col("_f")).alias(file), status.alias("status"))


def align_records(gold: DataFrame, predicted: DataFrame, key: str, order: str) -> DataFrame:
    """(gold_key, predicted_key, status): by id where all ids are there, else by position; an id twice on one side is an error.

    Positions are ranks over a narrow table of ids and orders.
    """
    from pyspark.sql.window import Window

    blank = lambda df: df.where(F.col(key).isNull() | (F.trim(F.col(key).cast("string")) == "")).limit(1).count() > 0
    if blank(gold) or blank(predicted):
        place = Window.orderBy(order)
        a = gold.select(F.col(key).alias("gold_key"), F.row_number().over(place).alias("_r"))
        b = predicted.select(F.col(key).alias("predicted_key"), F.row_number().over(place).alias("_r"))
        met = a.join(b.withColumn("_p", F.lit(True)), "_r", "full").join(a.select("_r", F.lit(True).alias("_g")), "_r", "left")
        return met.select("gold_key", "predicted_key", F.when(F.col("_g").isNull(), "extra").when(F.col("_p").isNull(), "missing").otherwise("aligned").alias("status"))
    once = lambda df, name: df.groupBy(F.col(key).alias(name)).agg(F.count("*").alias("n")).withColumn(name, F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("duplicate id: "), F.col(name).cast("string"))).cast(df.schema[key].dataType)).otherwise(F.col(name))).drop("n")
    met = once(gold, "gold_key").join(once(predicted, "predicted_key"), F.col("gold_key") == F.col("predicted_key"), "full")
    return met.select("gold_key", "predicted_key", F.when(F.col("gold_key").isNull(), "extra").when(F.col("predicted_key").isNull(), "missing").otherwise("aligned").alias("status"))


def match_aliases(owners: DataFrame, items: DataFrame, owner: str, names: str, item: str, name: str) -> DataFrame:
    """(item, owner, status): the one owner that has an item's name among its aliases; ambiguous, missing, or duplicate where an owner has several items."""
    alias = owners.select(owner, F.explode(names).alias("_a")).distinct()
    per = items.select(item, F.col(name).alias("_a")).join(alias, "_a", "left").groupBy(item).agg(F.count(owner).alias("n"), F.min(owner).alias(owner))
    claimed = per.where("n = 1").groupBy(owner).agg(F.count("*").alias("claims"))
    out = per.join(claimed, owner, "left")
    status = F.when(F.col("n") == 0, "missing").when(F.col("n") > 1, "ambiguous").when(F.col("claims") > 1, "duplicate").otherwise("matched")
    return out.select(item, F.when(status.isin("matched", "duplicate"), F.col(owner)).alias(owner), status.alias("status"))
