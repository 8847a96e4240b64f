"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Documents hash to cells of a ring; every shard owns virtual nodes on it.  A cell goes
to the first virtual node clockwise whose shard has room; what a full shard cannot
take continues clockwise, so a cell may be split at a rank.  With ``slack`` 0 a shard
has room for ``n // shards`` rows, and one more for the first ``n % shards`` shards: the
law ``rows`` holds, counts are at most one apart.  A larger slack moves fewer rows
when a shard is added and bounds counts by ``(1 + slack)`` times the mean.

Rows that are alike in id, size and text hash are counted before anything is moved: they
travel as one row with a count and are dealt out again at the end, in chunks over many tasks.
So neither copies nor rows of one id, or of none, meet in one task.  The driver sees row counts of cells only,
at most ``2 ** CELL_BITS`` of them whatever the input, and the placement that goes back has at most one
entry more for every shard: 66,000 entries of 40 bytes, under 3 MB.

Defined results: a null text has no bytes and the CRC of an empty text; a null id hashes
like a value of its own; repeated rows are placed one by one; an empty table gives no rows;
columns beyond doc_id and text do not matter.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Size bound of everything that reaches the driver or is broadcast: 65,536 cells.
CELL_BITS = 16


#: Copies of one row that are dealt out by one task at a time.
CHUNK = 65536


def cell(*key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key, F.lit("ring")), 64 - CELL_BITS).cast("int")


def ring(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    place = lambda s, v: int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") >> (64 - CELL_BITS)
    return sorted((place(s, v), s) for s in range(shards) for v in range(virtual))


def place(counts: dict[int, int], shards: int, virtual: int, slack: float) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, rank after the last, shard, first slot) for every run of rows."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) if slack == 0 else int(-(-total * (1 + slack) // shards)) for s in range(shards)]
    nodes = ring(shards, virtual)
    at = [c for c, _ in nodes]
    after = list(range(1, len(nodes) + 1))  # clockwise successor, skipping virtual nodes of full shards
    used = [0] * shards
    out = []

    def free(i: int) -> int:
        path = []
        i %= len(nodes)
        while used[nodes[i][1]] >= room[nodes[i][1]]:
            path.append(i)
            i = after[i] % len(nodes)
        for p in path:
            after[p] = i
        return i

    for c in sorted(counts):
        rank, left = 0, counts[c]
        i = bisect_left(at, c)
        while left:
            i = free(i)
            s = nodes[i][1]
            n = min(left, room[s] - used[s])
            out.append((c, rank, rank + n, s, used[s]))
            used[s] += n
            rank += n
            left -= n
    return out


def shard_documents(docs: DataFrame, shards: int = 24, virtual: int = 64, slack: float = 0.0) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard): narrow shuffles by row, then by cell."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    alike = written(alike.withColumn("cell", cell(F.col("doc_id"), F.col("size"), F.col("text_crc32"))))
    counts = {r["cell"]: r["n"] for r in alike.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    runs = ",".join(f"[{','.join(map(str, r))}]" for r in place(counts, shards, virtual, slack))
    # The placement is a literal of bounded size, not data read from anywhere.
    plan = spark.range(1).select(F.explode(F.from_json(F.lit(f"[{runs}]"), "array<array<bigint>>")).alias("r")).select(
        F.col("r")[0].cast("int").alias("at"), F.col("r")[1].alias("low"), F.col("r")[2].alias("high"), F.col("r")[3].cast("int").alias("shard"), F.col("r")[4].alias("slot0")
    )
    so_far = Window.partitionBy("cell").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = alike.withColumn("last", F.sum("n").over(so_far)).withColumn("first", F.col("last") - F.col("n"))
    met = ranked.join(F.broadcast(plan), (F.col("cell") == F.col("at")) & (F.col("first") < F.col("high")) & (F.col("last") > F.col("low")))
    a, b = F.greatest("first", "low"), F.least("last", "high")
    runs_ = met.select("doc_id", "size", "text_crc32", "shard", (F.col("slot0") + a - F.col("low")).alias("slot"), (b - a).alias("n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {CHUNK}"))).alias("chunk")
    many = runs_.where(F.col("n") > CHUNK).select("*", chunk).repartition("shard", "slot", "chunk")
    many = many.withColumns({"slot": F.col("slot") + F.col("chunk") * CHUNK, "n": F.least(F.lit(CHUNK).cast("long"), F.col("n") - F.col("chunk") * CHUNK)}).drop("chunk")
    each = F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("n") - 1)).alias("slot")
    found = runs_.where(F.col("n") <= CHUNK).unionByName(many).select("doc_id", "size", "text_crc32", "shard", each)
    law = "rows" if slack == 0 else "bounded"
    return found.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
