"""The pipeline's stages against plain versions, and at the edges: nulls, blanks, repeats, empty tables, clashing and dotted names."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brindle.llm import common, quality_model, secrets, shingles

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHES = ("size", "taken", "target", "first_slot", "row", "fp", "_row", "_text", "score", "predicted", "findings", "redacted", "doc", "scan", "node", "keys", "a.b", "source_size", "takes", "t", "s", "tie", "slot", "words", "h")


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(["the", "and", "of", "to", "river", "stone", "light", "garden", "walks", "over"]) + r.choice(["", "", "s", "ly"]) + r.choice(["", "", f"{r.randrange(50)}"]) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents and labels: good and bad texts, copies, near copies, secrets, and every odd row."""
    r, rows = random.Random(1), []
    for i in range(60):
        rows.append((i, prose(i, 40 + 3 * i), "en", f"src{i % 3}", 1))
    for i in range(60, 90):
        rows.append((i, " | ".join(r.choice(["buy", "cheap", "click", "now!!"]) + str(r.randint(0, 99)) for _ in range(60)), "en", "src1", 1))
    for i in range(90, 110):
        ws = prose(i - 90, 40 + 3 * (i - 90)).split(" ")
        ws[len(ws) // 2] = "changed"
        rows.append((i, " ".join(ws) if i % 2 else prose(i - 90, 40 + 3 * (i - 90)).upper(), "de", "src2", 1))
    for i in range(110, 116):
        rows.append((i, prose(i, 60) + f" token = {r.getrandbits(160):040x} " + prose(i + 1, 20), None, None, 1))
    rows += [(200, None, None, None, None), (201, "", "en", "src0", 0), (202, " \t\n", "en", "src0", 3), (None, prose(300, 90), "en", "src1", 1), (None, prose(301, 90), "en", "src1", 1)]
    rows += [(203, prose(302, 6000), "en", "src0", 1), (204, prose(303, 70), None, "src2", 1), (204, prose(303, 70), None, "src2", 1), (205, "the " * 30, "en", "src1", 1)]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(path + "/documents.parquet")
    labels = [(i, int(not 60 <= i < 90), 0) for i in range(110)] + [(None, 1, 0), (7, None, None), (999, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(path + "/labels.parquet")
    return path


def key(r) -> tuple:
    return (repr(r.doc_id), r.text or "", repr(r.text), r.source or "")


def shingle_set(text: str | None) -> frozenset:
    ws = [w.lower() for w in WORD.findall(text or "")]
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))) if ws else frozenset()


def plain_keep_one(rows: list) -> list:
    """All pairs: linked at similarity 0.8 or more; the smallest id of a group stays, null last."""
    sets, up = [shingle_set(r.text) for r in rows], list(range(len(rows)))

    def top(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] == sets[j] or sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8:
                up[max(top(i), top(j))] = min(top(i), top(j))
    groups: dict[int, list] = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append(r)
    return [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for g in groups.values()]


def test_stages_one_after_another(spark, tables):
    """Each stage's whole result follows from its input by a plain version of what it does."""
    docs = common.table(spark, tables, "documents")
    state = docs.collect()
    names = docs.columns
    inputs = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        inputs.append(common.written(stage(spark, inputs[-1], tables)))
        assert inputs[-1].columns == names
    got = [x.collect() for x in inputs]

    model = quality_model.train(docs, common.table(spark, tables, "labels"))
    scores = {key(r): r.predicted for r in quality_model.score(docs, model).collect()}
    assert sorted(map(key, got[1])) == sorted(key(r) for r in state if scores[key(r)] == 1)
    assert not any(r.doc_id is not None and 60 <= r.doc_id < 90 for r in got[1]) and sum(r.doc_id is not None and r.doc_id < 60 for r in got[1]) == 60

    want = plain_keep_one(got[1])
    assert sorted(repr(r.doc_id) for r in got[2]) == sorted(repr(r.doc_id) for r in want)
    assert {key(r) for r in got[2]} <= {key(r) for r in got[1]}

    tokens = re.compile("token = [0-9a-f]{40}")
    assert sorted((repr(r.doc_id), r.text, r.n_chars) for r in got[3] if r.text) == sorted((repr(r.doc_id), tokens.sub("token = " + secrets.MASK, r.text), len(tokens.sub("token = " + secrets.MASK, r.text))) for r in got[2] if r.text)
    assert sum(secrets.MASK in (r.text or "") for r in got[3]) == 6 and len(got[3]) == len(got[2])

    source = {key(r): WORD.findall(r.text or "") for r in got[3]}
    size = {s: sum(len(w) for k, w in source.items() if k[3] == (s or "")) for s in {r.source for r in got[3]}}
    taken: dict = {}
    for r in got[4]:
        taken[r.source] = taken.get(r.source, 0) + len(WORD.findall(r.text))
        whole = next(w for k, w in source.items() if k[0] == repr(r.doc_id) and k[3] == (r.source or "") and w[: len(WORD.findall(r.text))] == WORD.findall(r.text))
        assert r.n_chars == len(r.text) and 0 < len(WORD.findall(r.text)) <= len(whole)
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(s for s in size if s is not None) + [None] * (None in size))}
    left, open_, target = int(1.5 * sum(size.values())), {s for s in size if size[s]}, {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * size[s]} or None
        for s in over or open_:
            target[s] = 2 * size[s] if over else level * weights[s]
        left, open_ = left - sum(target[s] for s in over or ()), open_ - over if over else set()
    assert all(abs(taken.get(s, 0) - target[s]) <= 1 for s in target)

    import numpy as np
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    pieces = corpus_pipeline.STAGES[-1][1](spark, inputs[4], tables).collect()
    total = sum(len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in got[4])
    assert sum(p.length for p in pieces) == total == sum(len(np.frombuffer(bytes(p.ids), "<u4")) for p in pieces)
    whole = sorted(tuple(t.encode(r.text, add_special_tokens=False).ids) for r in got[4])
    single = [tuple(np.frombuffer(bytes(p.ids), "<u4")[:-1].tolist()) for p in pieces if p.length == p.doc_tokens]
    assert single and set(single) <= set(whole)

    before = common.made()
    ran = corpus_pipeline.run(spark, tables)
    assert ran.count() == len(pieces)
    assert common.made() - before < 12  # the stages' own tables are gone; those of the last stage are still read


@pytest.mark.parametrize("k", range(4), ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stage_carries_any_columns(spark, tables, k):
    """Clashing and dotted names travel along untouched, and rows are those without them."""
    docs = common.table(spark, tables, "documents")
    more = docs.withColumns({c: F.lit(f"<{c}>") for c in CLASHES})
    stage = corpus_pipeline.STAGES[k][1]
    out = stage(spark, more, tables)
    assert out.columns == more.columns
    rows = out.collect()
    assert all(r[c] == f"<{c}>" for r in rows[:50] for c in CLASHES)
    assert sorted(map(key, rows)) == sorted(map(key, stage(spark, docs, tables).collect()))


@pytest.mark.parametrize("k", range(5), ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stage_of_nothing(spark, tables, k):
    """An empty table stays empty; a table of nulls and blanks goes through."""
    docs = common.table(spark, tables, "documents")
    stage = corpus_pipeline.STAGES[k][1]
    nothing = stage(spark, docs.where("1 = 0"), tables)
    assert nothing.count() == 0 and (k == 4 or nothing.columns == docs.columns)
    blank = spark.createDataFrame([(1, None, None, None, None), (None, "", None, None, None), (2, " \n", "en", "x", 2), (2, " \n", "en", "x", 2)], DOCS)
    n = stage(spark, blank, tables).count()
    assert n in {0: (0, 4), 1: (1,), 2: (4,), 3: (0,), 4: (4,)}[k]


def test_near_duplicates_go_through_fingerprints(spark):
    """Without any band, SimHash alone draws together what is at most five bits apart and similar."""
    from xxhash import xxh64_intdigest

    r, rows = random.Random(5), []
    for g in range(12):
        ws = prose(1000 + g, 300 + 40 * g).split(" ")
        for k in range(8):
            at = set(r.sample(range(len(ws)), k))
            rows.append((10 * g + k, " ".join(f"x{r.random()}" if i in at else w for i, w in enumerate(ws))))
    whole = shingles.described(spark.createDataFrame(rows, "doc_id long, text string"))
    nodes = {x.doc.doc_id: (x.node, x.fp) for x in whole.collect()}

    def plain(text: str) -> int:
        ws = text.split(" ")
        hs = [xxh64_intdigest(" ".join(ws[i : i + 5]).encode(), seed=42) for i in range(len(ws) - 4)]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    fps, sets = {i: plain(t) for i, t in rows}, {i: shingle_set(t) for i, t in rows}
    assert all(nodes[i][1] % 2**64 == fps[i] for i, _ in rows)
    roots = {x.node: x.root for x in shingles.groups(whole.withColumn("keys", F.array().cast("array<long>"))).collect()}
    root = {i: roots.get(n, n) for i, (n, _) in nodes.items()}
    near = {(i, j): (fps[i] ^ fps[j]).bit_count() for i in fps for j in fps if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    assert {0, 4, 5} <= {min(d, 6) for d in near.values()} and max(near.values()) > 5
    for (i, j), d in near.items():
        if d <= 5:
            assert root[i] == root[j]
    assert all(root[i] != root[j] for i in fps for j in fps if i // 10 != j // 10)


def test_training_sends_the_driver_weights_only(spark, tables, monkeypatch):
    docs, labels = spark.read.parquet(f"{tables}/documents.parquet"), common.table(spark, tables, "labels")
    seen, collect = [], type(docs).collect

    def watched(self):
        seen.append((got := collect(self)) and max(len(got), len(self.columns)))
        return got

    monkeypatch.setattr(type(docs), "collect", watched)
    model = quality_model.train(docs, labels)
    assert max([0, *seen]) <= 2
    monkeypatch.undo()
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~quality_model.held_out(F.col("doc_id")))
    rows = docs.join(usable, "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("y")).mapInArrow(quality_model.collect_features(), "doc_id long, y int, idx binary, val binary").collect()
    rows.sort(key=lambda x: (quality_model.hash_order(x.doc_id), str(x.doc_id), x.y, bytes(x.idx)))
    plain = quality_model.ftrl([(x.y, bytes(x.idx), bytes(x.val)) for x in rows])
    assert len(rows) > 50 and model.bias == plain.bias and (model.weights == plain.weights).all() and model.weights.any()
