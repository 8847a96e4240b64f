"""Joins that match records: multisets, greedy pairs, fuzzy pairs, fail-closed alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def multiset_match(gold: DataFrame, predicted: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """True and false positives and false negatives of rows matched one to one by their whole signature.

    Both sides are counted before they meet, so equal rows never multiply.
    """
    sides = gold.select(*keys, F.lit(1).alias("_g"), F.lit(0).alias("_p")).unionByName(predicted.select(*keys, F.lit(0).alias("_g"), F.lit(1).alias("_p")))
    counted = sides.groupBy(*keys).agg(F.sum("_g").alias("g"), F.sum("_p").alias("p"))
    tp = F.least("g", "p")
    return counted.groupBy(*by).agg(F.sum(tp).alias("tp"), F.sum(F.col("p") - tp).alias("fp"), F.sum(F.col("g") - tp).alias("fn"))


def metrics(tp: Column, fp: Column, fn: Column) -> list[Column]:
    """Precision, recall and F1; an empty denominator counts as 1; six decimals, half to even."""
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(1.0))
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(1.0))
    f = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))
    return [F.bround(x, 6).alias(n) for x, n in ((p, "precision"), (r, "recall"), (f, "f1"))]


def micro_macro(counts: DataFrame, sample: str, section: str, weights: dict[str, float]) -> DataFrame:
    """Section scores pooled over samples (micro) and as the mean of sample F1 (macro)."""
    weight = F.coalesce(*[F.when(F.col(section) == k, F.lit(v)) for k, v in weights.items()], F.lit(0.0))
    each = counts.select(section, sample, "tp", "fp", "fn", *metrics(F.col("tp"), F.col("fp"), F.col("fn")))
    pooled = each.groupBy(section).agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"), F.bround(F.avg("f1"), 6).alias("macro_f1"))
    scored = pooled.select(section, "tp", "fp", "fn", *metrics(F.col("tp"), F.col("fp"), F.col("fn")), "macro_f1")
    return scored.withColumns({"micro_score": F.bround(weight * F.col("f1"), 6), "macro_score": F.bround(weight * F.col("macro_f1"), 6)})


def full_outer_align(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every id of either side with where it occurs."""
    a = left.select(F.col(key)).distinct().withColumn("_l", F.lit(True))
    b = right.select(F.col(key)).distinct().withColumn("_r", F.lit(True))
    status = F.when(F.col("_l").isNull(), "extra").when(F.col("_r").isNull(), "missing").otherwise("aligned")
    return a.join(b, key, "full").select(key, status.alias("status"))


def align_unique(manifest: DataFrame, found: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Manifest rows with the number of found rows of their key and a status; strict raises unless all are 1."""
    n = found.groupBy(key).agg(F.count("*").alias("n_found"))
    out = manifest.join(n, key, "left").withColumn("n_found", F.coalesce("n_found", F.lit(0)).cast("long"))
    out = out.withColumn("status", F.when(F.col("n_found") == 1, "aligned").when(F.col("n_found") == 0, "missing").otherwise("ambiguous"))
    if strict:
        out = out.withColumn("n_found", F.when(F.col("n_found") == 1, F.col("n_found")).otherwise(F.raise_error(F.concat(F.lit("not aligned: "), F.col(key).cast("string"))).cast("long")))
    return out


def pair_entities(left: DataFrame, right: DataFrame, key: str, anchor: int = 6) -> DataFrame:
    """Left keys with a status: paired_exact, paired_fuzzy, ambiguous, duplicate or missing.

    Exact keys pair first.  A key contained in another shares that key's leading ``anchor`` characters (all
    of a shorter one) somewhere inside it, so containment is an equality join on character windows of the
    lengths that occur, then verified.
    """
    lk, rk = left.groupBy(key).agg(F.count("*").alias("n_left")), right.groupBy(key).agg(F.count("*").alias("n_right"))
    exact = lk.join(rk, key, "left")
    rest = exact.where(F.col("n_right").isNull() & (F.length(key) > 0)).select(F.col(key).alias("l"))
    r = rk.where(F.length(key) > 0).select(F.col(key).alias("r"))

    def windows(df: DataFrame, c: str, inner: DataFrame, i: str) -> DataFrame:
        sizes = sorted(x[0] for x in inner.select(F.least(F.length(i), F.lit(anchor))).distinct().collect())  # at most ``anchor`` numbers
        cut = lambda n: F.when(F.length(c) >= n, F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda k: F.substring(c, k, F.lit(n)))).otherwise(F.array().cast("array<string>"))
        return df.select(c, F.explode(F.array_distinct(F.concat(F.array().cast("array<string>"), *[cut(n) for n in sizes]))).alias("w"))

    inside = rest.select("l", F.left("l", F.lit(anchor)).alias("w")).join(windows(r, "r", rest, "l"), "w").where(F.col("r").contains(F.col("l")))
    around = windows(rest, "l", r, "r").join(r.select("r", F.left("r", F.lit(anchor)).alias("w")), "w").where(F.col("l").contains(F.col("r")))
    fuzzy = inside.select("l", "r").union(around.select("l", "r")).distinct().groupBy("l").agg(F.count("*").alias("n_fuzzy")).withColumnRenamed("l", key)
    out = exact.join(fuzzy, key, "left")
    status = F.when(F.col("n_left") > 1, "duplicate").when(F.col("n_right") == 1, "paired_exact").when(F.col("n_right") > 1, "ambiguous").when(F.col("n_fuzzy") == 1, "paired_fuzzy").when(F.col("n_fuzzy") > 1, "ambiguous").otherwise("missing")
    return out.select(key, status.alias("status"))


def best_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tokens: str, top: int = 1) -> DataFrame:
    """The right rows sharing most distinct tokens with each left row; ties to the smaller id.

    An inverted-index join counts shared tokens; tokens of the larger side are pruned to those the other has.
    """
    a = left.select(left_id, F.explode(F.array_distinct(tokens)).alias("_t"))
    b = right.select(right_id, F.explode(F.array_distinct(tokens)).alias("_t"))
    shared = a.join(b, "_t").groupBy(left_id, right_id).agg(F.count("*").alias("shared"))
    w = Window.partitionBy(left_id).orderBy(F.desc("shared"), right_id)
    return shared.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def containing(texts: DataFrame, needles: DataFrame, text_id: str, text: str, needle_id: str, needle: str, words: int = 8) -> DataFrame:
    """(text_id, needle_id) of needles that a text holds as whole words in a row.

    The hash of a needle's first words is joined by equality to the hashes of the text's word windows, and
    each proposed pair is verified.  Needles of fewer words have shorter anchors of their own.
    """
    split = lambda c: F.split(F.col(c), " ")
    n = F.least(F.size(split(needle)), F.lit(words))
    key = lambda ws, i, k: F.xxhash64(F.lit(k) if isinstance(k, int) else k, F.array_join(F.slice(ws, i, F.lit(k) if isinstance(k, int) else k), " "))
    keyed = needles.where(F.length(needle) > 0).select(needle_id, needle, n.alias("_n"), key(split(needle), F.lit(1), n).alias("_a"))
    sizes = sorted(r[0] for r in keyed.select("_n").distinct().collect())  # at most ``words`` numbers
    if not sizes:
        return texts.select(text_id).withColumn(needle_id, F.lit(None).cast(needles.schema[needle_id].dataType)).where("1 = 0")
    windows = lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - k + 1, F.lit(1))), lambda i: key(F.col("_w"), i, k))
    # Only ids and hashes of windows travel; the texts of hits are fetched afterwards.
    grams = texts.select(text_id, split(text).alias("_w")).select(text_id, F.explode(F.array_distinct(F.concat(*[windows(k) for k in sizes]))).alias("_g"))
    hits = grams.join(keyed.select(needle_id, "_a"), F.col("_g") == F.col("_a")).select(text_id, needle_id).distinct()
    padded = lambda c: F.concat(F.lit(" "), F.col(c), F.lit(" "))
    met = hits.join(texts.select(text_id, text), text_id).join(needles.select(needle_id, needle), needle_id)
    return met.where(padded(text).contains(padded(needle))).select(text_id, needle_id).distinct()


def greedy_pairs(pairs: DataFrame, sample: str | list[str], gold: str, predicted: str, order: list[Column]) -> DataFrame:
    """One-to-one pairs taken greedily in the given order within each sample, by a fold over used sides.

    A sample's candidate pairs meet in one row: they are the items of one document.
    """
    by = [sample] if isinstance(sample, str) else sample
    keys = [c.alias(f"k{i}") for i, c in enumerate(order)]
    listed = pairs.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(*keys, F.col(gold).alias("g"), F.col(predicted).alias("p")))).alias("c"))
    kind = "array<struct<g:bigint,p:bigint>>"
    free = lambda acc, x: ~F.exists(acc, lambda y: (y["g"] == x["g"]) | (y["p"] == x["p"]))
    fold = F.aggregate("c", F.array().cast(kind), lambda acc, x: F.when(free(acc, x), F.array_append(acc, F.struct(x["g"].cast("long").alias("g"), x["p"].cast("long").alias("p")))).otherwise(acc))
    return listed.select(*by, F.inline(fold)).withColumnsRenamed({"g": gold, "p": predicted})
