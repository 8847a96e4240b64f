"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A text becomes relative counts of its hashed words and word pairs; a word that repeats the
one before it, and the marks a word ends with, count as tokens too.  Weights are
learnt by FTRL-proximal updates, one text at a time, over a bounded sample of labelled
texts that are read whole.  A score is the logistic of a sparse dot product.

Defined results: null and blank texts have no n-grams and get the score of the bias
alone; labels that are null, or whose text is missing, teach nothing; several labels of one
id each count, as do several texts, within the bound of the sample; without labels of both kinds every score is 0.5; texts are never cut;
ids may be of any type; columns of the input may have any names, but for the two that are added.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights are 2 ** BITS floats (1 MB), the bound of what reaches every executor.
BITS = 18
#: At most so many labelled texts are learnt from, drawn by the hash of their ids.
SAMPLE = 8192
THRESHOLD = 0.3
#: Relative counts are scaled by this before they meet the weights.
SCALE = 8.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def featurizer(bits: int = BITS):
    """A function from a text's bytes to its hashed n-grams, repeats included."""
    import re
    from zlib import crc32

    import numpy as np

    marks = re.compile(rb"[!-/:-@\[-`{-~]+\Z")
    mask = np.uint64((1 << bits) - 1)

    class Ids(dict):
        def __missing__(self, w: bytes) -> int:
            if len(self) >= 1 << 19:  # bounded memory: start again
                self.clear()
            tail = marks.search(w)
            # High half: the word's own hash; low half: the hash of the marks that it ends with.
            out = self[w] = crc32(w) << 32 | (crc32(tail[0][-3:], 7) if tail else 0)
            return out

    ids = Ids()

    def mix(x: np.ndarray) -> np.ndarray:
        x = x * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)) & mask

    def of(data: bytes | None) -> np.ndarray:
        ws = (data or b"").split()
        if not ws:
            return np.zeros(0, np.int64)
        both = np.fromiter(map(ids.__getitem__, ws), np.uint64, len(ws))
        w, tail = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
        same = w[1:] == w[:-1]
        pairs = np.where(same, np.uint64(3), (w[:-1] << np.uint64(31)) + w[1:] + np.uint64(1 << 63))
        return mix(np.concatenate([w, pairs, tail[tail > 0] + np.uint64(1 << 40)])).astype(np.int64)

    return of


def collect_features(bits: int = BITS):
    """An Arrow mapper (doc_id, text, y) -> (doc_id, y, idx, val): sparse rows for training."""

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        of = featurizer(bits)
        for b in batches:
            idx, val = [], []
            for t in b.column("text").cast(pa.binary()).to_pylist():
                i, c = np.unique(of(t), return_counts=True)
                idx.append(i.astype("<i4").tobytes())
                val.append((c / max(1, c.sum())).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], ["doc_id", "y", "idx", "val"])

    return run


@dataclass
class Model:
    weights: object
    bias: float
    bits: int = BITS


def ftrl(rows: list[tuple[int, bytes, bytes]], bits: int = BITS, epochs: int = 3, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1) -> Model:
    """FTRL-proximal over (y, idx, val) rows in their order; the bias is not regularised."""
    import numpy as np

    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb = nb = 0.0
    if len({y for y, _, _ in rows}) < 2:
        return Model(np.zeros(1 << bits, np.float32), 0.0, bits)
    for _ in range(epochs):
        for y, i, v in rows:
            i, x = np.frombuffer(i, "<i4"), np.frombuffer(v, "<f4").astype(np.float64) * SCALE
            zi, ni = z[i], n[i]
            w = np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(ni)) / alpha + l2))
            b = -zb / ((beta + nb**0.5) / alpha)
            g = 1 / (1 + np.exp(-np.clip(w @ x + b, -35, 35))) - y
            gx = g * x
            z[i] += gx - (np.sqrt(ni + gx * gx) - np.sqrt(ni)) / alpha * w
            n[i] += gx * gx
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / alpha * b
            nb += g * g
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
    return Model(w.astype(np.float32), float(-zb / ((beta + nb**0.5) / alpha)), bits)


def _learn(bits: int):
    """An Arrow mapper from all rows (doc_id, y, idx, val), in one partition, to one row (weights, bias)."""

    def run(batches: Iterator):
        import pyarrow as pa

        got = [r for b in batches for r in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)]
        got.sort(key=lambda r: (hash_order(r[0]), str(r[0]), r[1], r[2]))
        model = ftrl([r[1:] for r in got], bits)
        yield pa.RecordBatch.from_arrays([pa.array([model.weights.tobytes()], pa.binary()), pa.array([model.bias])], ["weights", "bias"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bits: int = BITS) -> Model:
    """Learns from at most ``sample`` labelled texts whose ids are not held out.

    One task learns from them, and the driver gets the weights alone.  An id that many rows bear gives many texts: where
    they are more than ``sample``, the least by hash stay, so that task never gets more rows than that.  Counting them
    reads the ids alone.
    """
    import numpy as np

    usable = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    drawn = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)
    kind = docs.schema["doc_id"].dataType.simpleString()
    met = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    rows = met.mapInArrow(collect_features(bits), f"doc_id {kind}, y int, idx binary, val binary")
    if docs.select("doc_id").join(F.broadcast(drawn), "doc_id").count() > sample:
        rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y", F.xxhash64("idx", "val")).limit(sample)
    got = rows.repartition(1).mapInArrow(_learn(bits), "weights binary, bias double").first()
    if got is None:  # no rows, so the plan had no task either
        return ftrl([], bits)
    return Model(np.frombuffer(bytes(got["weights"]), np.float32), got["bias"], bits)


def hash_order(x) -> int:
    from zlib import crc32

    return crc32(str(x).encode(), 1)


def scorer(model: Model):
    """An Arrow mapper (doc, text) -> (doc, score)."""
    weights, bias, bits = model.weights, model.bias, model.bits

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        of = featurizer(bits)
        for b in batches:
            out = np.empty(b.num_rows)
            for k, t in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                f = of(t)
                out[k] = bias + (SCALE * float(weights[f].sum(dtype=np.float64)) / len(f) if len(f) else 0.0)
            score = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["doc", "score"])

    return run


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc, score, predicted): every row of ``docs`` as a struct, whatever its columns are named; one narrow pass."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(scorer(model), rows.select("doc", F.lit(0.0).alias("score")).schema)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``, which take the place of columns of these names."""
    rest = [c for c in docs.columns if c not in ("score", "predicted")]
    return scored(docs, model, threshold).select(*[F.col("doc").getField(c).alias(c) for c in rest], "score", "predicted")
