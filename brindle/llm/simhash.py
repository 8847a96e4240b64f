"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints of 64 bits that differ in at most 4 are linked.  They are cut into three
segments, so at least one segment differs in at most one bit; two segments differing
in at most one bit are equal once some one bit is wiped out in both.  Every
fingerprint is therefore indexed under each of its 64 one-wildcard segment variants, and
an equality join proposes the pairs, which are verified by their whole distance.
A pair counts only under the first variant that it shares, so each link comes once.

Equal fingerprints are one node from the start: copies are never expanded into pairs.
Groups of near copies are drawn together first by keys whose equality alone proves a
link (15 or more of 16 nibbles equal); the join then leaves out pairs already together,
so a large group of near copies does not give all its pairs either.

Defined results: null and blank texts have fingerprint 0 and are linked like any other;
repeated rows share a fingerprint; a null id takes part, and a component of null ids
only has a null component; an empty table gives no rows; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_join, written
from .graph import components

WIDTH, DISTANCE = 4, 4
#: (first bit, bits) of the segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))


def hasher(width: int = WIDTH):
    """A function from the bytes of a text to the hashes of its word shingles, repeats included."""

    def of(data: bytes | None):
        from itertools import repeat

        import numpy as np
        from xxhash import xxh64_intdigest

        # bytes.lower() changes A-Z only; bytes.split() cuts at space and 09-0D, as words are defined.
        ws = (data or b"").lower().split()
        if not ws:
            return np.zeros(0, np.uint64)
        joined = b" ".join(ws)
        lengths = np.fromiter(map(len, ws), np.int64, len(ws))
        ends = np.cumsum(lengths + 1)
        starts = (ends - lengths - 1)[: max(1, len(ws) - width + 1)]
        stops = (ends - 1)[min(width, len(ws)) - 1 :]
        return np.fromiter(map(xxh64_intdigest, [joined[a:b] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], repeat(42)), np.uint64, len(starts))

    return of


def folder():
    """A function from shingle hashes to the fingerprint, a signed long: the bits set in over half of them."""

    def of(h) -> int:
        import numpy as np

        total = np.zeros(64, np.int64)
        for i in range(0, len(h), 65536):
            part = h[i : i + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
            total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return int(np.packbits(2 * total > len(h), bitorder="little").view("<i8")[0])

    return of


def fingerprint_texts(width: int = WIDTH):
    """An Arrow mapper that turns column ``text`` into ``fp``, the other columns staying as they are."""
    hashes, fold = hasher(width), folder()

    def run(batches: Iterator):
        import pyarrow as pa

        for b in batches:
            i = b.schema.get_field_index("text")
            fps = pa.array([fold(hashes(x)) for x in b.column(i).cast(pa.binary()).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([c for k, c in enumerate(b.columns) if k != i] + [fps], [n for k, n in enumerate(b.schema.names) if k != i] + ["fp"])

    return run


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with ``fp`` in place of ``text``."""
    rest = [c for c in docs.columns if c not in ("text", "fp")]
    schema = docs.select(*[F.col(f"`{c}`") for c in rest]).withColumn("fp", F.lit(0).cast("long")).schema
    return docs.select(*[F.col(f"`{c}`") for c in rest], F.col("text").cast("string").alias("text")).mapInArrow(fingerprint_texts(width), schema)


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def variants(fp: Column) -> Column:
    """The 64 one-wildcard segment variants as long keys: the wiped bit's place, then the segment without it."""
    keys = []
    for first, n in SEGMENTS:
        segment = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << n) - 1))
        keys += [segment.bitwiseAND(F.lit(((1 << n) - 1) & ~(1 << i))).bitwiseOR(F.lit((first + i) << 22)) for i in range(n)]
    return F.array(*keys)


def first_shared(x: Column, place: Column) -> Column:
    """Whether the variant at ``place`` is the first one that fingerprints with difference ``x`` share.

    That is the first segment differing in at most one bit, and in it the differing bit, or
    bit 0 where there is none.
    """
    out, earlier = F.lit(False), F.lit(True)
    for first, n in SEGMENTS:
        part = F.shiftrightunsigned(x, first).bitwiseAND(F.lit((1 << n) - 1))
        wiped = F.when(part == 0, F.lit(first)).otherwise(F.lit(first) + F.bit_count(part - 1))
        out |= earlier & (F.bit_count(part) <= 1) & (place == wiped)
        earlier &= F.bit_count(part) > 1
    return out


def links(nodes: DataFrame, distance: int = DISTANCE, apart: DataFrame | None = None) -> DataFrame:
    """(u, v) of distinct fingerprints at most ``distance`` bits apart, each once, for distances up to 5.

    ``apart`` is a table (fp, root): pairs of one root are left out.
    """
    if distance > 5:
        raise ValueError("three segments prove distances up to 5 only")
    x = nodes.select("fp") if apart is None else nodes.select("fp").join(apart, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    keyed = x.withColumn("key", F.explode(variants(F.col("fp"))))
    a, b = keyed.alias("a"), keyed.alias("b")
    diff = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    near = (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & (F.bit_count(diff) <= distance) & first_shared(diff, F.shiftrightunsigned(F.col("a.key"), 22))
    if apart is not None:
        near &= F.col("a.root") != F.col("b.root")
    return a.join(b, near).select(F.col("b.fp").alias("u"), F.col("a.fp").alias("v"))


def close_stars(nodes: DataFrame, of: str = "fp") -> DataFrame:
    """(u, v): every ``of`` with the smallest one whose fingerprint agrees in all but one of 16 nibbles: at most 4 bits apart."""
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_long(~(15 << 4 * i) & (1 << 64) - 1))).alias("k")) for i in range(16)]))
    keyed = nodes.select(F.col(of).alias("u"), keys.alias("key"))
    hubs = keyed.groupBy("key").agg(F.min("u").alias("v"), F.count("*").alias("n")).where("n > 1")
    return hot_join(keyed, hubs, "key", "n", 16 * nodes.count()).where("u <> v").select("u", "v").distinct()


def cluster(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, n, component_id) for a written table (doc_id, fp); n is the number of rows of a fingerprint."""
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n")))
    edges = None
    together = None
    if distance >= 4:
        together = components(close_stars(nodes)).withColumnRenamed("node", "fp")
        edges = together.select(F.col("fp").alias("u"), F.col("root").alias("v"))
    more = links(nodes, distance, together)
    roots = components(more if edges is None else edges.unionByName(more))
    labelled = written(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "n", "doc_id", F.coalesce("root", "fp").alias("root")))
    low = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("members"))
    return hot_join(labelled, low, "root", "members", labelled.count()).select("fp", "n", "component_id")


def near_duplicates(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``, whatever further columns it has."""
    fps = written(fingerprints(docs.select("doc_id", "text"), width))
    met = hot_join(fps, cluster(fps, distance), "fp", "n", fps.count())
    return met.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = WIDTH, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs`` less all but one of every component: the smallest id (nulls last) stays.

    Among rows of one id the first stays; columns may have any names.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.monotonically_increasing_id().alias("row"))
    whole = written(fingerprints(rows.select("doc", "row", F.col("doc.text").alias("text")), width))
    fps = whole.select(F.col("doc.doc_id").alias("doc_id"), "fp", "row")
    best = hot_join(fps, cluster(fps, distance), "fp", "n", fps.count()).groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("b"))
    return whole.join(best.select(F.col("b.row").alias("row")), "row", "left_semi").select("doc.*")
