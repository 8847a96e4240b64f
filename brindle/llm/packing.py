"""Packing token sequences by non-negative least squares.

A document's ids are cut into whole windows and one remainder.  Remainders are
counted by length class (8 tokens wide); shallow combinations of classes that
fill a window exactly are enumerated, and non-negative least squares finds how often to
repeat each so that the counts are met.  Repeats are rounded and handed out by rank
within a class.  What is left over is packed greedily, one after another, cut where a
window ends; the last, partly filled window is cut into powers of two, which need no
padding.

The histogram has 256 classes whatever the input, and at most 256 combinations are
repeated: that is all the driver sees.  Ranks come from counts of writing tasks and
classes, so no window gathers a class.  Token ids cross the network once, when pieces meet their
documents.

Strings of special tokens in a text are those tokens, as the tokenizer file has it.

Defined results: null and empty texts are the end id alone; repeated rows are
documents of their own; an empty table gives no pieces; a document may be of any length; columns
beyond doc_id and text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

WINDOW, STEP, DEPTH, END = 2048, 8, 3, 1
#: The special tokens of the vocabulary, which its rank file leaves out.
SPECIAL = (("<|endoftext|>", 50256),)


def tokenize(vocabulary: str = "byte_bpe_50k.tiktoken", window: int = WINDOW, step: int = STEP, end: int = END, id_bytes: int = 2, special: tuple[tuple[str, int], ...] = SPECIAL):
    """An Arrow mapper from rows with ``text`` to ids and the counters that ranks are made of.

    The vocabulary holds the ranks of the byte-level BPE model of the same name, which give the
    same ids several times faster.  A text is cut at the strings of ``special`` tokens, which get their own
    ids.  An id that does not fit into ``id_bytes`` is an error.
    """

    def run(batches: Iterator):
        import base64

        import numpy as np
        import public_tokenizers as public
        import pyarrow as pa
        import tiktoken
        from pyspark import TaskContext

        with open(public.path(vocabulary), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        model = tiktoken.Encoding("public", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens=dict(special))
        names = tuple(n for n, _ in special)
        pid, row, windows = TaskContext.get().partitionId(), 0, 0
        seen = [0] * (window // step + 1)
        for b in batches:
            out = {k: [] for k in ("row", "doc_tokens", "windows_before", "rest", "class", "local", "ids")}
            for t in b.column("text").to_pylist():
                t = t or ""
                found = model.encode(t, allowed_special="all") if any(n in t for n in names) else model.encode_ordinary(t)
                ids = np.array([*found, end], f"<u{id_bytes}")
                rest = len(ids) % window
                c = -(-rest // step)
                for k, v in zip(out, (row, len(ids), windows, rest, c, seen[c], ids.tobytes()), strict=True):
                    out[k].append(v)
                row += 1
                windows += len(ids) // window
                seen[c] += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            cols = [pa.array(v, kind) for v, kind in zip(out.values(), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([pid] * b.num_rows, pa.int32()), *cols], ["doc_id", "pid", *out])

    return run


def widen(id_bytes: int):
    """An Arrow mapper that turns ``ids`` of ``id_bytes`` bytes each into ids of four."""

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            i = b.schema.get_field_index("ids")
            ids = [np.frombuffer(x, f"<u{id_bytes}").astype("<u4").tobytes() for x in b.column(i).to_pylist()]
            yield b.set_column(i, "ids", pa.array(ids, pa.binary()))

    return run


def combinations(size: int, depth: int) -> list[tuple[int, ...]]:
    """Descending multisets of at most ``depth`` positive class numbers with the given sum."""
    out: list[tuple[int, ...]] = []

    def grow(left: int, most: int, sofar: tuple[int, ...]) -> None:
        if left == 0:
            out.append(sofar)
        elif len(sofar) < depth:
            need = -(-left // (depth - len(sofar)))
            for x in range(min(most, left), need - 1, -1):
                grow(left - x, x, (*sofar, x))

    grow(size, size, ())
    return out


def nnls(a, h, rounds: int = 600):
    """Non-negative least squares by an active set.

    Only the active columns meet in a solve, so memory is that of ``a``.  After ``rounds`` columns it
    stops with what it has: counts that are then not met are packed as residuals, which costs padding, never data.
    """
    import numpy as np

    x = np.zeros(a.shape[1])
    active: list[int] = []
    for _ in range(rounds):
        gain = a.T @ (h - a[:, active] @ x[active])
        gain[active] = -1
        j = int(gain.argmax())
        if gain[j] <= 1e-6 * max(1.0, float(h.max(initial=0))):
            break
        active.append(j)
        while active:
            s = np.linalg.lstsq(a[:, active], h, rcond=None)[0]
            if s.min() > 1e-9:
                x[:] = 0
                x[active] = s
                break
            old = x[active]
            falling = s <= 1e-9
            t = float(np.min(old[falling] / np.maximum(old[falling] - s[falling], 1e-12)))
            moved = old + t * (s - old)
            x[:] = 0
            x[active] = np.maximum(moved, 0)
            active = [k for k in active if x[k] > 1e-9]
    return x


def plan(counts: dict[int, int], classes: int, depth: int = DEPTH) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """((class, first rank, rank after the last, first sequence, place) ..., sequences): rounded repeats."""
    import numpy as np

    h = np.array([counts.get(c, 0) for c in range(1, classes + 1)], float)
    combos = [c for c in combinations(classes, depth) if all(counts.get(x) for x in c)]
    if not combos:
        return [], 0
    a = np.zeros((classes, len(combos)))
    for j, c in enumerate(combos):
        for x in c:
            a[x - 1, j] += 1
    repeats = nnls(a, h)
    left = {c: n for c, n in counts.items() if c}
    taken = dict.fromkeys(left, 0)
    runs, sequences = [], 0
    for j in sorted(np.flatnonzero(repeats), key=lambda k: (-repeats[k], k)):
        combo = combos[j]
        n = min(int(repeats[j] + 0.5), *(left[x] // combo.count(x) for x in combo))
        if n:
            for place, x in enumerate(combo):
                runs.append((x, taken[x], taken[x] + n, sequences, place))
                taken[x] += n
                left[x] -= n
            sequences += n
    return runs, sequences


def pack(docs: DataFrame, vocabulary: str = "byte_bpe_50k.tiktoken", window: int = WINDOW, step: int = STEP, depth: int = DEPTH, id_bytes: int = 2) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), one row a piece; ids of 4 bytes, little-endian.

    Written and shuffled ids take ``id_bytes``: 2, or 4 for vocabularies of more than 65,536 ids.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, pid int, row long, doc_tokens long, windows_before long, rest int, class int, local long, ids binary"
    tokens = written(docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(tokenize(vocabulary, window, step, id_bytes=id_bytes), schema))
    facts = tokens.select("pid", "row", "doc_tokens", "windows_before", "rest", "class", "local")
    rests = facts.where("rest > 0")
    by_class = {r["class"]: r["n"] for r in rests.groupBy("class").agg(F.count("*").alias("n")).collect()}
    runs, sequences = plan(by_class, window // step, depth)

    # Ranks within a class: by writing task, then by order within the task.
    cells = rests.groupBy("class", "pid").agg(F.count("*").alias("n"))
    before = cells.withColumn("before", F.sum("n").over(Window.partitionBy("class").orderBy("pid")) - F.col("n")).drop("n")
    ranked = rests.join(before, ["class", "pid"]).withColumn("rank", F.col("local") + F.col("before"))
    table = spark.createDataFrame(runs or [(-1, 0, 0, 0, 0)], "c int, low long, high long, first long, place int")  # at most 768 rows
    dealt = ranked.join(F.broadcast(table), (F.col("class") == F.col("c")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")), "left")
    dealt = written(dealt.select("pid", "row", "doc_tokens", "rest", "class", "local", "place", (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id")))
    whole_rest = F.col("doc_tokens") - F.col("rest")
    inside = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    combined = dealt.where("sequence_id IS NOT NULL").select("pid", "row", whole_rest.alias("start"), F.col("rest").cast("long").alias("length"), "sequence_id", F.coalesce(F.sum("rest").over(inside), F.lit(0)).cast("long").alias("offset"))

    # Residuals stand one after another: by class, writing task and order.
    left = dealt.where("sequence_id IS NULL").drop("sequence_id", "place")
    sums = written(left.groupBy("class", "pid").agg(F.sum("rest").alias("n")))
    classes = sums.groupBy("class").agg(F.sum("n").alias("n")).orderBy("class").collect()  # at most 256 rows
    total, bases = 0, []
    for r in classes:
        bases.append((r["class"], total))
        total += r["n"]
    base = F.broadcast(spark.createDataFrame(bases or [(-1, 0)], "class int, base long"))
    firsts = sums.withColumn("first", F.sum("n").over(Window.partitionBy("class").orderBy("pid")) - F.col("n")).drop("n").join(base, "class")
    run = Window.partitionBy("class", "pid").orderBy("local").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = left.withColumn("run", F.sum("rest").over(run) - F.col("rest")).join(firsts, ["class", "pid"])
    at = at.select("pid", "row", whole_rest.alias("begin"), (F.col("base") + F.col("first") + F.col("run")).alias("a"), (F.col("base") + F.col("first") + F.col("run") + F.col("rest")).alias("b"))
    full = total // window
    tail, lows = total - full * window, []
    while tail:
        n = 1 << tail.bit_length() - 1
        lows.append((total - tail, total - tail + n, sequences + full + len(lows)))
        tail -= n
    k = F.sequence(F.floor(F.col("a") / window), F.floor((F.col("b") - 1) / window))
    spans = F.transform(F.filter(k, lambda i: i < full), lambda i: F.struct((i * window).alias("low"), ((i + 1) * window).alias("high"), (i + sequences).alias("s")))
    last = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for v, n in zip(x, ("low", "high", "s"), strict=True)]) for x in lows]) if lows else F.array().cast("array<struct<low:bigint,high:bigint,s:bigint>>")
    hit = F.filter(F.concat(spans, last), lambda s: (s["low"] < F.col("b")) & (s["high"] > F.col("a")))
    cut = at.withColumn("s", F.explode(hit)).withColumn("from", F.greatest("a", "s.low"))
    greedy = cut.select("pid", "row", (F.col("begin") + F.col("from") - F.col("a")).alias("start"), (F.least("b", "s.high") - F.col("from")).alias("length"), F.col("s.s").alias("sequence_id"), (F.col("from") - F.col("s.low")).alias("offset"))

    # Whole windows are numbered after all others, by writing task and order.
    after = sequences + full + len(lows)
    many = facts.withColumn("n", F.expr(f"doc_tokens div {window}")).where("n > 0")
    tasks = many.groupBy("pid").agg(F.sum("n").alias("t"))
    start = tasks.withColumn("first", F.sum("t").over(Window.orderBy("pid")) - F.col("t") + after).drop("t")
    each = many.join(start, "pid").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    windows = each.select("pid", "row", (F.col("i") * window).alias("start"), F.lit(window).cast("long").alias("length"), (F.col("first") + F.col("windows_before") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    pieces = combined.unionByName(greedy).unionByName(windows)
    of_doc = pieces.groupBy("pid", "row").agg(F.sort_array(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("p"))
    met = tokens.select("pid", "row", "doc_id", "doc_tokens", "ids").join(of_doc, ["pid", "row"])
    cuts = F.transform("p", lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length"), F.substring(F.col("ids"), (p["start"] * id_bytes + 1).cast("int"), (p["length"] * id_bytes).cast("int")).alias("ids"), p["sequence_id"].alias("sequence_id"), p["offset"].alias("offset")))
    out = met.select("doc_id", "doc_tokens", F.inline(cuts)).select("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
    return out if id_bytes == 4 else out.mapInArrow(widen(id_bytes), out.schema)
