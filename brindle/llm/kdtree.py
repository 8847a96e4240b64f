"""Exact top-k inner-product search with KD-trees.

Vectors are spread over shards by the hash of their row numbers; a shard is a KD-tree made by
median splits along the widest side, every node with the tight box of its points.
The largest inner product of a query with any point of a box is known from the box's
sides.  A query walks a tree best first: a heap holds the open nodes by their bounds, an
inner node gives way to its two children, a leaf is scored, and the walk ends when
the best open bound is below the query's k-th score.  Each query searches a home shard
first; the k-th score found there goes with it to the other shards, where a root box
below that score ends the walk at once.

Trees and query blocks have bounded sizes; blocks of queries meet shards by equality
joins, every block every shard.  Components are integers held as doubles, and scores are exact: products
are formed in double precision where no sum can leave 2 ** 53, in 64-bit integers where
none can leave 2 ** 63, else in integers without bound.

Defined results: vectors that are null, empty, or hold null or non-finite components take no part, nor do components
that leave the doubles when scaled; a row is its own only by its place, so repeated
rows are candidates of each other and each asks for itself; a query meets only vectors of its own dimension;
ties go to the smaller id; with fewer than k others, all are returned; a score
beyond 64 bits is ranked exactly and given as null; rows without an id take no part; other columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Rows of a shard (at most), queries of a block, blocks that meet a shard in one task, points of a leaf.
SHARD_ROWS, BLOCK_ROWS, BLOCKS_AT_ONCE, LEAF = 65536, 1024, 16, 128
#: Shards are made smaller, down to this, while there are fewer of them than twice the cores.
LEAST_ROWS = 2048


def exact(values, most: int):
    """Doubles that hold integers, in the narrowest kind in which sums up to ``most`` are exact."""
    import numpy as np

    if most < 1 << 53:
        return values
    if most < 1 << 63:
        return values.astype(np.int64)
    return np.array([int(x) for x in values.ravel()], object).reshape(values.shape)


def _matrix(column, rows: int):
    import numpy as np

    return np.array(column.combine_chunks().values.to_numpy(zero_copy_only=False), np.float64).reshape(rows, -1)


def build_tree(leaf: int = LEAF):
    """Arrow group function: a shard's rows -> one row holding its tree.

    Nodes are numbered from the root on: their boxes, their points' range, and the number of the first
    of their two children (0 for a leaf).
    """

    def run(key, table):
        import pickle

        import numpy as np
        import pyarrow as pa

        ids, rows = table.column("id").to_numpy(), table.column("row").to_numpy()
        v = _matrix(table.column("v"), len(ids))
        perm = np.lexsort((rows, ids))
        nodes, child, low, high = [(0, len(ids))], [0], [], []
        for i, (a, b) in enumerate(nodes):  # grows while it is walked
            part = v[perm[a:b]]
            low.append(part.min(0))
            high.append(part.max(0))
            if b - a > leaf:
                axis = int((high[i] - low[i]).argmax())
                half = (b - a) // 2
                perm[a:b] = perm[a:b][np.argpartition(part[:, axis], half)]
                child[i] = len(nodes)
                nodes += [(a, a + half), (a + half, b)]
                child += [0, 0]
        blob = pickle.dumps((ids[perm], rows[perm], v[perm], np.array(nodes), child, np.stack(low), np.stack(high)), protocol=5)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([blob], pa.binary())})

    return run


def walk(tree, queries, k: int):
    """The k best (score, id) of each query in one tree, and the numbers of nodes and leaves visited.

    Queries walk side by side: in a round each takes its best open node from its own heap; the bounds of
    all children and the scores of all leaves of a round are formed together.
    """
    import heapq

    import numpy as np

    ids, rows, v, nodes, child, low, high = tree
    q_rows, qv, tau = queries
    most = max(1, int(np.abs(v).max(initial=0))) * max(1, int(np.abs(qv).max(initial=0))) * v.shape[1]
    lo, hi, pts, qs = (exact(x, most) for x in (low, high, v, qv))

    def bounds(who, which):
        q = qs[who]
        return np.maximum(q * hi[which], q * lo[which]).sum(axis=1)

    n = len(q_rows)
    best: list[list] = [[] for _ in range(n)]  # ascending (score, -id) of at most k
    kth = list(tau)
    heaps: list[list] = [[(-x, 0)] for x in bounds(np.arange(n), np.zeros(n, int)).tolist()]
    active, visited, scored = list(range(n)), 0, 0
    while active:
        inner, leaves, still = [], {}, []
        for i in active:
            h = heaps[i]
            if h and (kth[i] is None or -h[0][0] >= kth[i]):
                node = heapq.heappop(h)[1]
                still.append(i)
                if child[node]:
                    inner.append((i, child[node]))
                else:
                    leaves.setdefault(node, []).append(i)
        active = still
        visited += len(still)
        if inner:
            who, which = np.array(inner).T
            for i, c, x, y in zip(who.tolist(), which.tolist(), bounds(who, which).tolist(), bounds(who, which + 1).tolist(), strict=True):
                if kth[i] is None or x >= kth[i]:
                    heapq.heappush(heaps[i], (-x, c))
                if kth[i] is None or y >= kth[i]:
                    heapq.heappush(heaps[i], (-y, c + 1))
        for node, mine in leaves.items():
            a, b = nodes[node]
            scored += len(mine)
            s = qs[mine] @ pts[a:b].T
            own = q_rows[mine][:, None] == rows[None, a:b]
            for r, i in enumerate(mine):
                at = np.flatnonzero(~own[r] if kth[i] is None else ~own[r] & (s[r] >= kth[i]))
                if len(at):
                    best[i] = sorted(best[i] + [(int(x), -int(y)) for x, y in zip(s[r][at], ids[a:b][at], strict=True)])[-k:]
                    if len(best[i]) == k and (kth[i] is None or best[i][0][0] > kth[i]):
                        kth[i] = best[i][0][0]
    return best, visited, scored


def search(k: int):
    """Arrow cogroup function: one tree and some query blocks -> the k best of each query here.

    Scores leave as text, since they may be larger than a long.
    """

    def run(key, trees, blocks):
        import pickle

        import pyarrow as pa

        out: tuple[list, list, list, list] = ([], [], [], [])
        if trees.num_rows and blocks.num_rows:
            tree = pickle.loads(trees.column("tree")[0].as_py())
            for blob in blocks.column("queries"):
                q_ids, q_rows, qv, tau = pickle.loads(blob.as_buffer())
                for i, found in enumerate(walk(tree, (q_rows, qv, tau), k)[0]):
                    out[0].extend([int(q_ids[i])] * len(found))
                    out[1].extend([int(q_rows[i])] * len(found))
                    out[2].extend(-y for _, y in found)
                    out[3].extend(str(x) for x, _ in found)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.table({n: pa.array(x, t) for n, x, t in zip(("query_id", "query_row", "vec_id", "score"), out, kinds, strict=True)})

    return run


def pack_queries():
    """Arrow group function: a block's queries with their k-th scores so far -> one row."""

    def run(key, table):
        import pickle

        import pyarrow as pa

        ids = table.column("id").to_numpy()
        tau = [None if x is None else int(x) for x in table.column("tau").to_pylist()]
        blob = pickle.dumps((ids, table.column("row").to_numpy(), _matrix(table.column("v"), len(ids)), tau), protocol=5)
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()), "queries": pa.array([blob], pa.binary())})

    return run


def _floor(x: Column) -> Column:
    """The floor as a double; doubles from 2 ** 53 on are whole already, and a long would not hold them all."""
    return F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x)


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries whose id is divisible by ``every``, against all rows."""
    spark = vectors.sparkSession
    whole = F.transform("embedding", lambda x: _floor(x.cast("double") * scale))
    fine = F.coalesce(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < float("inf"))), F.lit(False))
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine).select(F.col("vec_id").cast("long").alias("id"), whole.alias("v"))
    rows = written(rows.select("id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")))
    n = {r["dim"]: (r["n"], r["q"]) for r in rows.groupBy("dim").agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).collect()}
    wide = 2 * spark.sparkContext.defaultParallelism
    shard_rows = lambda a: min(SHARD_ROWS, max(LEAST_ROWS, -(-a // wide)))
    sizes = [(d, -(-a // shard_rows(a)), max(1, -(-q // BLOCK_ROWS))) for d, (a, q) in n.items()]
    shape = F.broadcast(spark.createDataFrame(sizes or [(-1, 1, 1)], "dim int, shards int, blocks int"))  # a row for each dimension
    dealt = rows.join(shape, "dim").withColumns({"shard": F.pmod(F.xxhash64("row"), "shards").cast("int"), "block": F.pmod(F.xxhash64("row", F.lit("q")), "blocks").cast("int")})
    trees = written(dealt.groupBy("dim", "shard").applyInArrow(build_tree(), "dim int, shard int, tree binary"))
    queries = dealt.where(F.col("id") % every == 0).select("dim", "id", "row", "v", "block", "shards", F.lit(None).cast("string").alias("tau"))

    def met(q: DataFrame, targets) -> DataFrame:
        packed = q.groupBy("dim", "block").applyInArrow(pack_queries(), "dim int, block int, queries binary").join(shape, "dim")
        sent = written(packed.withColumn("shard", F.explode(targets)).select("dim", "shard", F.floor(F.col("block") / BLOCKS_AT_ONCE).cast("int").alias("part"), "queries"))
        parts = sent.select(F.col("dim").alias("d"), F.col("shard").alias("s"), F.col("part").alias("p")).distinct()
        sides = trees.join(parts, (F.col("dim") == F.col("d")) & (F.col("shard") == F.col("s"))).select("d", "s", "p", "tree")
        return sides.groupBy("d", "s", "p").cogroup(sent.groupBy("dim", "shard", "part")).applyInArrow(search(k), "query_id long, query_row long, vec_id long, score string")

    # Decimal text of any length, ordered as numbers: sign, then length, then digits.
    minus = F.col("score").startswith("-")
    size = F.when(minus, -F.length("score")).otherwise(F.length("score"))
    key = [size.desc(), F.when(~minus, F.col("score")).desc(), F.when(minus, F.col("score")).asc()]
    home = F.pmod(F.col("block"), F.col("shards"))
    first = written(met(queries, F.array(home)))
    last = Window.partitionBy("query_row").orderBy(*key, "vec_id")
    kth = first.withColumn("r", F.row_number().over(last)).where(F.col("r") == k).select(F.col("query_row").alias("qr"), F.col("score").alias("low"))
    again = queries.where("shards > 1").join(kth, F.col("row") == F.col("qr"), "left").select("dim", "id", "row", "v", "block", F.col("low").alias("tau"))
    others = F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda s: s != home)
    rest = met(again, others)
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.expr("try_cast(score AS BIGINT)").alias("score"))


ORACLE = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.rid <> q.rid AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
