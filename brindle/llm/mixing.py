"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents stand in a shuffled order (MD5 of the id) as one stream of
tokens that is cut into blocks of equal length.  Slots of the mix fall to sources by a
low-discrepancy sequence: the golden-ratio point of a slot, mapped through the cumulative
weights, names its source; the slots of a source are ranked, and rank r takes the
source's r-th block, going round again after the last.  A source stops at its target,
inside its last block if need be; slots that the sequence's small discrepancy leaves
short follow at the end.  The slot at which a document is first taken, and each further time,
is part of the result, and ``emit`` gives its rows in that order.

Streams are ranked in steps (hash bucket; equal rows of one reading task; place among
them), and slots likewise in runs, so no window ever holds a whole source, nor all
rows of one id or of none.  Sources meet only as one narrow row each.

Defined results: a null text has size 0 and is taken 0 times, at no slot; a null source is a source
of its own, last in order; repeated rows are documents of their own; an empty table or
one without words gives targets of 0; columns of the input may have any names, since
they travel inside one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, count_words, written

WEIGHTS = (5, 2, 1)
#: Words of a block.
BLOCK = 4096
#: Hash buckets of a source's stream: a bucket of 2 ** -12 of a source is ranked at once.
BUCKETS = 4096
#: Slots ranked at once.
RUN = 1 << 14
#: Grid cells by which points find their sources.
GRID = 1 << 16
#: The odd multiplier nearest to 2 ** 31 over the golden ratio, which gives the points' order.
GOLDEN = 1327217885


def targets(sizes: DataFrame, share_pct: int = 150, cap: int = 2, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, weight, target) by water-filling, one row a source.

    Sources sorted by cap over weight reach their caps in that order; the level that
    the others share follows from running sums.
    """
    one = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(one) - 1, F.lit(len(weights))) + 1).cast("int"))
    x = sizes.withColumn("weight", w.cast("long"))
    order = Window.orderBy((F.lit(cap) * F.col("source_size") / F.col("weight")), F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy()
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    left = F.floor(F.sum("source_size").over(every) * share_pct) / 100 - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0))
    x = x.withColumn("level", left / F.sum("weight").over(after)).withColumn("over", F.col("level") * F.col("weight") > F.col("source_size") * cap)
    level = F.min(F.when(~F.col("over"), F.struct(F.col("source_size") * cap / F.col("weight"), F.col("source").isNull().alias("n"), "source", "level"))).over(every)["level"]
    return x.select("source", "source_size", "weight", F.when(F.col("over"), F.col("source_size") * F.lit(float(cap))).otherwise(level * F.col("weight")).cast("double").alias("target"))


def stream(rows: DataFrame) -> DataFrame:
    """(row, source, size, start): each document's place in its source's shuffled stream of words.

    Equal rows that one task has read are one cell, so an id that a third of all rows bear is
    spread over as many cells as tasks; a cell lists its rows, never more than that task read.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    of = ["source", "bucket", "key", "doc_id", "size", "tie", "task"]
    rows = rows.select("row", "source", "doc_id", "size", "tie", key.alias("key"), F.conv(F.substring(key, 1, 3), 16, 10).cast("int").alias("bucket"), F.shiftright("row", 33).alias("task"))
    cells = rows.groupBy(*of).agg(F.array_sort(F.collect_list("row")).alias("rows"), F.sum("size").alias("n"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "tie", "task").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = cells.withColumn("before", F.sum("n").over(inside) - F.col("n"))
    parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    first = parts.select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("first"))
    joined = placed.join(first, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    each = joined.select("source", "size", (F.col("before") + F.col("first")).alias("at"), F.posexplode("rows").alias("i", "row"))
    return each.select("row", "source", "size", (F.col("at") + F.col("i") * F.col("size")).alias("start"))


def schedule(goal: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source, source_size, rank, slot, words): the slots of the mix and the words that each takes."""
    spark = goal.sparkSession
    rows = goal.withColumn("need", F.floor("target").cast("long")).where("need > 0").withColumn("slots", F.ceil(F.col("need") / block).cast("long"))
    order, every = Window.orderBy(F.col("source").isNull(), F.col("source")), Window.partitionBy()
    rows = rows.withColumn("high", F.sum("target").over(order) / F.sum("target").over(every)).withColumn("no", F.row_number().over(order) - 1)
    rows = rows.withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0.0))).withColumn("high", F.when(F.col("no") == F.count("*").over(every) - 1, 1.0).otherwise(F.col("high")))
    total = rows.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    # A point meets the sources that share its grid cell: an equality join, then the exact bounds.
    grid = F.explode(F.sequence(F.floor(F.col("low") * GRID), F.least(F.floor(F.col("high") * GRID), F.lit(GRID - 1))))
    edges = rows.select("no", "low", "high", grid.alias("cell"))
    point = F.pmod(F.pmod(F.col("id"), F.lit(1 << 31)) * GOLDEN, F.lit(1 << 31)) / float(1 << 31)
    slots = spark.range(total).withColumn("point", point).withColumn("cell", F.floor(F.col("point") * GRID))
    dealt = slots.join(edges, "cell").where("point >= low AND point < high").select("no", "id", F.floor(F.col("id") / RUN).alias("run"))
    runs = dealt.groupBy("no", "run").agg(F.count("*").alias("n"))
    first = runs.withColumn("first", F.sum("n").over(Window.partitionBy("no").orderBy("run")) - F.col("n")).drop("n")
    inside = dealt.withColumn("in_run", F.row_number().over(Window.partitionBy("no", "run").orderBy("id")) - 1)
    ranked = inside.join(first, ["no", "run"]).select("no", (F.col("in_run") + F.col("first")).alias("rank"), F.col("id").alias("slot"))
    # Every rank up to the need has a slot: its own, or one after all others.  Ranks are made in runs, too.
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {RUN}"))).alias("chunk")
    chunks = rows.select("no", "source", "source_size", "need", "slots", chunk).repartition("no", "chunk")
    each = F.explode(F.sequence(F.col("chunk") * RUN, F.least(F.col("slots"), (F.col("chunk") + 1) * RUN) - 1)).alias("rank")
    wanted = chunks.select("no", "source", "source_size", "need", each)
    late = F.coalesce(F.col("slot"), F.lit(total) + F.col("rank"))
    return wanted.join(ranked, ["no", "rank"], "left").select("source", "source_size", "rank", late.alias("slot"), F.least(F.lit(block).cast("long"), F.col("need") - F.col("rank") * block).alias("words"))


def spans(slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """(s, cell, a, b, turn, slot): the stretches of a source's stream that its slots take.

    Rank r takes ``words`` words from word ``r * block`` on; the stream goes round, so a
    slot that crosses its end takes a stretch on either side, in the next turn.
    """
    at, n = F.col("rank") * block, F.col("source_size")
    low, turn = F.pmod(at, n), F.floor(at / n)
    turns = F.sequence(F.lit(0).cast("long"), F.floor((low + F.col("words") - 1) / n))
    parts = F.transform(turns, lambda k: F.struct(F.greatest(F.lit(0).cast("long"), low - k * n).alias("a"), F.least(n, low + F.col("words") - k * n).alias("b"), (turn + k).alias("turn")))
    x = slots.select(F.col("source").alias("s"), "slot", F.explode(parts).alias("p")).select("s", "slot", "p.a", "p.b", "p.turn")
    x = x.withColumn("cell", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block))))
    return x.select("s", "cell", "slot", "turn", F.greatest("a", F.col("cell") * block).alias("a"), F.least("b", (F.col("cell") + 1) * block).alias("b"))


def mix(docs: DataFrame, share_pct: int = 150, cap: int = 2, block: int = BLOCK, keep: list[str] | None = None) -> DataFrame:
    """(doc, size, source_size, target, taken, takes): every row of ``docs`` as a struct, with what the mix takes of it.

    ``docs`` has doc_id, source and text; ``keep`` names the columns that travel on (all).  ``taken`` counts
    words with repeats; no document is taken more than ``cap`` times.  ``takes`` lists (turn, slot, words)
    in order: whole copies and, where the target ends inside the document, its beginning.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("doc")
    text = F.col("text").cast("string")
    rows = docs.select(kept, "doc_id", "source", count_words(text).alias("size"), F.coalesce(F.crc32(text), F.lit(-1)).alias("tie"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows)
    goal = written(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), share_pct, cap))
    placed = stream(rows.where("size > 0"))
    pieces = placed.withColumn("c", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    taken_spans = spans(schedule(goal, block), block)
    shared = F.least(F.col("b"), F.col("start") + F.col("size")) - F.greatest(F.col("a"), F.col("start"))
    met = pieces.join(taken_spans, F.col("source").eqNullSafe(F.col("s")) & (F.col("c") == F.col("cell"))).withColumn("words", shared).where("words > 0")
    turns = met.groupBy("row", "turn").agg(F.min("slot").alias("slot"), F.sum("words").alias("words"))
    takes = turns.groupBy("row").agg(F.sum("words").alias("taken"), F.array_sort(F.collect_list(F.struct("turn", "slot", "words"))).alias("takes"))
    facts = goal.select(F.col("source").alias("s"), "source_size", "target")
    out = rows.select("doc", "source", "size", "row").join(takes, "row", "left").join(facts, F.col("source").eqNullSafe(F.col("s")), "left")
    return out.select("doc", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.coalesce("takes", F.array().cast("array<struct<turn:bigint,slot:bigint,words:bigint>>")).alias("takes"))


def emit(mixed: DataFrame) -> DataFrame:
    """The rows of the mix, with the columns that the documents had: whole copies, and beginnings of documents taken in part.

    Rows of a partition stand in the order of their slots; partitions are random shares of the mix, so each of
    them, and each beginning of one, holds the sources in their proportions.  A beginning keeps the
    text's own separators.
    """
    x = mixed.withColumn("t", F.explode("takes")).sortWithinPartitions("t.slot", "t.turn")
    head = F.array_join(F.slice(F.regexp_extract_all(F.col("doc.text"), F.lit(f"[\\x20\\x09-\\x0D]*{WORD}"), F.lit(0)), F.lit(1), F.col("t.words").cast("int")), "")
    text = F.when(F.col("t.words") == F.col("size"), F.col("doc.text")).otherwise(head)
    names = mixed.schema["doc"].dataType.fieldNames()
    return x.select(*[(text if c == "text" else F.col("doc").getField(c)).alias(c) for c in names])


ORACLE = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
l AS (SELECT *, (floor(sum(source_size) OVER () * 150) / 100.0 - coalesce(sum(source_size * 2) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
  / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w
  WINDOW o AS (ORDER BY 2.0 * source_size / weight, encode(source) NULLS LAST)),
t AS (SELECT source, source_size, CASE WHEN level * weight > source_size * 2 THEN source_size * 2.0::DOUBLE
  ELSE (SELECT arg_min(level, 2.0 * source_size / weight) FROM l WHERE NOT level * weight > source_size * 2) * weight END::DOUBLE AS target FROM l),
p AS (SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start FROM d),
g AS (SELECT source, target, floor(target)::BIGINT AS need, ceil(floor(target) / 4096)::BIGINT AS slots FROM t WHERE target >= 1),
h AS (SELECT *, sum(target) OVER o / sum(target) OVER () AS high, row_number() OVER o = count(*) OVER () AS final FROM g WINDOW o AS (ORDER BY encode(source) NULLS LAST)),
e AS (SELECT source, coalesce(lag(high) OVER (ORDER BY encode(source) NULLS LAST), 0.0) AS low, CASE WHEN final THEN 1.0 ELSE high END AS high FROM h),
i AS (SELECT id, id * 1327217885 % 2147483648 / 2147483648.0::DOUBLE AS point FROM (SELECT unnest(range(coalesce(sum(slots), 0)::BIGINT)) AS id FROM g)),
k AS (SELECT source, id AS slot, row_number() OVER (PARTITION BY source ORDER BY id) - 1 AS rank FROM i JOIN e ON point >= low AND point < high)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  floor(target)::BIGINT // source_size * size + greatest(0, least(size, floor(target)::BIGINT % source_size - start)) END::BIGINT AS taken,
  CASE WHEN size > 0 AND start < floor(target)::BIGINT THEN coalesce(slot, (SELECT sum(slots)::BIGINT FROM g) + start // 4096) END::BIGINT AS first_slot
FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source LEFT JOIN k ON k.source IS NOT DISTINCT FROM p.source AND k.rank = start // 4096"""
