"""Near copies by SimHash, verified by the similarity of their word shingles.

Two texts are near copies when the Jaccard similarity of their sets of five-word
shingles is 0.8 or more.  Sets are proposed in three ways, and every proposed pair is
verified on the whole sets:

* by SimHash, as in ``simhash``: a fingerprint of 64 bits over the five-word shingles; stars
  around fingerprints that agree in 15 of 16 nibbles; then deletion-variant signatures of three
  segments, whose equality join meets all fingerprints at most 5 bits apart.
* A pair at similarity 0.8 is some 10 bits apart, which no signature reaches.  For these, each
  set has 160 least hashes in 32 bands of five; of two sets at 0.8 no band is equal with
  probability (1 - 0.8^5)^32, about 3 in a million, and less often for closer ones.  Each member
  of a band's bucket is first held against one of them only.
* What is left is an exact similarity join over the sets met so far: shingles are ordered
  from rare to frequent, two similar sets share one of the first fifth of theirs, and the
  places of a shared shingle bound the overlap.  A group with a common passage, whose
  members differ in shingles of their own, therefore proposes next to nothing.

Equal sets are one node from the start; stars and buckets draw large groups of near copies
together, and later joins leave out pairs that are together already.  Groups are the
components of the verified pairs, by star contraction.

Defined results: words are those of ``simhash`` (A-Z in lower case); a text of fewer than
five words is one shingle; null and blank texts are one node; texts are never cut; other
columns may have any names; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_join, made, release, written
from .graph import components
from .simhash import close_stars, folder, hasher, links

WIDTH, SIMILARITY = 5, 0.8
#: The most bits that three segments prove.
DISTANCE = 5
BANDS, ROWS = 32, 5


def _describe(width: int, bands: int, rows: int):
    """An Arrow mapper that adds (node, fp, keys) to records ``doc`` with a field ``text``."""
    hashes, fold = hasher(width), folder()

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        r = np.random.default_rng(17)
        by = r.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        plus = r.integers(0, 1 << 63, bands * rows, np.uint64)

        def keys(s) -> list[int]:
            least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
            for i in range(0, len(s), 2048):
                np.minimum(least, (s[i : i + 2048, None] * by + plus).min(axis=0), out=least)
            parts = least.reshape(bands, rows)
            return [xxh64_intdigest(parts[k].tobytes(), k) for k in range(bands)]

        for b in batches:
            texts = b.column(b.schema.get_field_index("doc")).field("text").cast(pa.binary()).to_pylist()
            every = [hashes(x) for x in texts]
            fps = pa.array([fold(h) for h in every], pa.int64())
            found = [np.unique(h) for h in every]
            node = np.array([xxh64_intdigest(s.tobytes()) for s in found], np.uint64).view(np.int64)
            flat = np.array([k for s in found if len(s) for k in keys(s)], np.uint64).view(np.int64)
            cuts = np.concatenate([[0], np.cumsum([bands if len(s) else 0 for s in found])]).astype(np.int32)
            listed = pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat, pa.int64()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(node), fps, listed], [*b.schema.names, "node", "fp", "keys"])

    return run


def _as_sets(width: int):
    """An Arrow mapper from (node, text) to (node, shingles)."""
    hashes = hasher(width)

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            found = [np.unique(hashes(x)).view(np.int64) for x in b.column(1).cast(pa.binary()).to_pylist()]
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = np.concatenate([*found, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat))], ["node", "shingles"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) at ``similarity`` or more, by their whole sets."""
    s, t = sets.toDF("u", "s"), sets.toDF("v", "t")
    both = F.size(F.array_intersect("s", "t"))
    near = both / (F.size("s") + F.size("t") - both) >= similarity
    return written(pairs.join(s, "u").join(t, "v").where(near).select("u", "v"))


def _prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(node, size, h, at): the shingles by which a similar set must be met, with their places.

    A set in the order from rare to frequent shingles (ties by hash) shares one of its first
    ``size - ceil(similarity * size) + 1`` with every set that is similar enough; shingles
    of one set only come first and meet nobody.
    """
    single = sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("h"))
    common = single.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    shared = hot_join(single, common, "h", "n", single.count())
    ordered = shared.groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "h"))).alias("o"))
    own = F.col("size") - F.size("o")
    length = F.col("size") - F.ceil(F.col("size") * similarity - 1e-9).cast("int") + 1
    first = F.transform(F.slice("o", F.lit(1), F.greatest(length - own, F.lit(0))), lambda x, i: F.struct(x["h"].alias("h"), (own + i).alias("at")))
    return ordered.select("node", "size", F.inline(first))


def _fits(a: str, b: str, similarity: float) -> Column:
    """Whether the places of a shared shingle leave room for the overlap that the similarity needs."""
    col = lambda side, name: F.col(f"{side}.{name}")
    least = F.ceil((col(a, "size") + col(b, "size")) * (similarity / (1 + similarity)) - 1e-9)
    return F.least(col(a, "size") - col(a, "at"), col(b, "size") - col(b, "at")) >= least


def _mixed(prefixes: DataFrame, together: DataFrame) -> DataFrame:
    """The prefixes with their groups, where a shingle's sets are of several groups, as a written table.

    ``main`` is the shingle's largest group, ``hub`` its set with the fewest shingles of its own before.
    """
    rooted = prefixes.join(together.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left")
    rooted = written(rooted.select("h", F.struct("node", "size", "at", F.coalesce("root", "node").alias("root")).alias("x")))
    members = rooted.groupBy("h", "x.root").agg(F.count("*").alias("n"), F.min(F.struct("x.at", "x.node", "x.size", "x.root")).alias("hub"))
    largest = members.groupBy("h").agg(F.max_by(F.struct("root", "hub"), F.struct("n", "root")).alias("m"), F.count("*").alias("roots"), F.sum("n").alias("n")).where("roots > 1")
    facts = largest.select("h", "n", F.col("m.root").alias("main"), F.col("m.hub").alias("hub"))
    return written(hot_join(rooted, facts, "h", "n", rooted.count()).drop("n"))


def _hub_pairs(mixed: DataFrame, similarity: float) -> DataFrame:
    """(u, v): every set outside of a shingle's largest group with that group's hub."""
    fits = mixed.where((F.col("x.root") != F.col("main")) & _fits("x", "hub", similarity))
    return fits.select(F.greatest("x.node", "hub.node").alias("u"), F.least("x.node", "hub.node").alias("v")).distinct()


def _all_pairs(mixed: DataFrame, similarity: float) -> DataFrame:
    """(u, v): all pairs of sets of different groups whose sizes and shared places allow the similarity.

    The members of a shingle's largest group never meet one another, so a large group is passed
    once for each set outside of it.
    """
    a = mixed.where("x.root <> main").select("h", F.col("x").alias("a"))
    b = mixed.select("h", F.col("x").alias("b"), (F.col("x.root") == F.col("main")).alias("in_main"))
    met = a.join(b, (a["h"] == b["h"]) & (F.col("a.root") != F.col("b.root")) & (F.col("in_main") | (F.col("a.node") < F.col("b.node"))) & _fits("a", "b", similarity))
    return met.select(F.greatest("a.node", "b.node").alias("u"), F.least("a.node", "b.node").alias("v")).distinct()


def described(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc, row, node, fp, keys) as a written table: every row of ``docs``, its number, its shingle set's node, its fingerprint."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row"))
    schema = rows.withColumns({"node": F.lit(0).cast("long"), "fp": F.lit(0).cast("long"), "keys": F.array().cast("array<long>")}).schema
    return written(rows.mapInArrow(_describe(width, BANDS, ROWS), schema))


def _by_bands(nodes: DataFrame) -> DataFrame:
    """(u, v): every set with the smallest one that has an equal band."""
    keyed = nodes.select(F.col("node").alias("u"), F.explode("keys").alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("u").alias("v"), F.count("*").alias("n")).where("n > 1")
    return hot_join(keyed, hubs, "key", "n", BANDS * nodes.count()).where("u <> v").select("u", "v").distinct()


def _by_signatures(nodes: DataFrame, together: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v) of sets whose fingerprints are at most ``distance`` bits apart and not together yet, as a written table.

    Sets of one fingerprint are met by its smallest one here; the stars have held the others against that.
    """
    first = nodes.groupBy("fp").agg(F.min("node").alias("_of"))
    prints = written(first.join(together, F.col("_of") == F.col("node"), "left").select("fp", "_of", F.coalesce("root", "_of").alias("root")))
    near = written(links(prints, distance, prints.select("fp", "root")))
    of = lambda end: prints.select(F.col("fp").alias(end), F.col("_of").alias(f"_{end}"))
    return written(near.join(of("u"), "u").join(of("v"), "v").select(F.col("_u").alias("u"), F.col("_v").alias("v")))


def _sets_of(nodes: DataFrame, whole: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of ``nodes``, which has node and row, as a written table."""
    texts = whole.select("row", F.col("doc.text").cast("string").alias("text")).join(nodes.select("node", "row"), "row").select("node", "text")
    return written(texts.mapInArrow(_as_sets(width), "node long, shingles array<long>"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def groups(whole: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """(node, root) of all nodes of a table from ``described`` that have a near copy, but for the roots themselves."""
    first = whole.groupBy("node").agg(F.min("row").alias("row")).select("row")
    nodes = written(whole.select("row", "node", "fp", "keys").join(first, "row", "left_semi"))
    met = written(close_stars(nodes, "node").unionByName(_by_bands(nodes)).distinct())
    sets = _sets_of(nodes.join(_ends(met), "node"), whole, width)
    together = components(_verified(met, sets, similarity))
    linked = _by_signatures(nodes, together)
    late = nodes.join(_ends(linked), "node").join(sets.select("node"), "node", "left_anti")
    sets = sets.unionByName(_sets_of(late, whole, width))
    prefixes = written(_prefixes(sets, similarity))
    stars = lambda x: x.select(F.col("node").alias("u"), F.col("root").alias("v"))
    for pairs in (_hub_pairs, _all_pairs):
        more = pairs(_mixed(prefixes, together), similarity)
        if pairs is _hub_pairs:
            more = linked.unionByName(more).distinct()
        together = components(stars(together).unionByName(_verified(written(more), sets, similarity)))
    return together


def keep_one(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` less all but one of every group of near copies: the smallest id (nulls last) stays.

    Among rows of one id the first stays.
    """
    whole = described(docs, width)
    ids = whole.select("node", "row", F.col("doc.doc_id").alias("doc_id"))
    mark = made()
    roots = groups(whole, width, similarity).withColumnRenamed("node", "_n")
    release(docs.sparkSession, mark, but=1)
    placed = ids.join(roots, F.col("node") == F.col("_n"), "left").select("doc_id", "row", F.coalesce("root", "node").alias("root"))
    best = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("b"))
    return whole.join(best.select(F.col("b.row").alias("row")), "row", "left_semi").select("doc.*")
