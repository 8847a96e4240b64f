"""Queries of the small audits, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import audit
from brindle.plans.catalogue import load, query
from brindle.plans.reports import pick

ITEMS = {0: ("说明 1、修补裂缝；2、更换支座。", ["修补裂缝", "更换支座"]), 1: ("宽1.5m的裂缝", ["宽1.5m的裂缝"]), 2: ("（1）清理（2）观测", ["清理（2）观测"]), 3: ("①甲 ②乙", ["甲", "乙"]), 4: ("", []), 5: ("3）丙\n4）丁", ["丙", "丁"])}
TEXT, TEXT_SQL = pick([t for t, _ in ITEMS.values()], "s_suppkey")


@query(" UNION ALL ".join(f"SELECT s_suppkey, {i} AS place, '{x}' AS item FROM supplier WHERE s_suppkey % 6 = {k}" for k, (_, xs) in ITEMS.items() for i, x in enumerate(xs)))
def numbered_items(spark, d):
    return audit.split_numbered(load(spark, d, "supplier").select("s_suppkey", TEXT().alias("t")), ["s_suppkey"], "t")


CAND_SQL = "c AS (SELECT l_orderkey % 500 AS doc, ['name', 'date', 'score'][l_linenumber % 3 + 1] AS field, ['A', 'A', '', '无', 'B'][l_partkey % 5 + 1] AS value, ['table', 'text'][l_suppkey % 2 + 1] AS kind, CASE WHEN l_suppkey % 4 = 0 THEN l_linenumber END AS anchor FROM lineitem WHERE l_orderkey % 9 = 0)"


def _candidates(spark, d):
    n = F.col("l_linenumber")
    c = load(spark, d, "lineitem").where("l_orderkey % 9 = 0").select((F.col("l_orderkey") % 500).alias("doc"), pick(("name", "date", "score"), "l_linenumber")[0]().alias("field"), pick(("A", "A", "", "无", "B"), "l_partkey")[0]().alias("value"), pick(("table", "text"), "l_suppkey")[0]().alias("kind"), F.when(F.col("l_suppkey") % 4 == 0, n).alias("anchor"), F.col("l_orderkey").alias("row"))
    return c


@query(f"""WITH {CAND_SQL}, p AS (SELECT doc, field, count(DISTINCT value) FILTER (value <> '无') AS n, count(DISTINCT value) FILTER (value <> '无' AND kind = 'table') AS s, max((value = '无' AND anchor IS NOT NULL)::INT) AS e FROM c WHERE value <> '' GROUP BY 1, 2),
g AS (SELECT doc, f AS field FROM (SELECT DISTINCT l_orderkey % 500 AS doc FROM lineitem) x, (VALUES ('name'), ('date'), ('score')) v(f))
SELECT g.doc, g.field, CASE WHEN n IS NULL OR (n = 0 AND e = 0) THEN 'missing' WHEN n = 0 THEN 'explicit_none' WHEN n = 1 OR s = 1 THEN 'extracted' ELSE 'ambiguous' END AS state FROM g LEFT JOIN p ON p.doc = g.doc AND p.field = g.field""")
def audit_states(spark, d):
    docs = load(spark, d, "lineitem").select((F.col("l_orderkey") % 500).alias("doc")).distinct()
    return audit.audit_states(_candidates(spark, d), docs, ["doc"], ["name", "date", "score"], ["table"])


@query("""WITH e AS (SELECT DISTINCT s_name || '.docx' AS name FROM supplier WHERE s_suppkey % 5 <> 0), a AS (SELECT name, count(*) AS n FROM (SELECT CASE s_suppkey % 8 WHEN 0 THEN '../' ELSE '' END || s_name || CASE s_suppkey % 7 WHEN 0 THEN '.pdf' ELSE '.docx' END AS name FROM supplier UNION ALL SELECT s_name || '.docx' FROM supplier WHERE s_suppkey % 13 = 0) GROUP BY 1),
j AS (SELECT coalesce(e.name, a.name) AS name, e.name IS NULL AS u, n FROM e FULL JOIN a ON a.name = e.name)
SELECT name, unnest(list_filter([CASE WHEN n IS NULL THEN 'missing' END, CASE WHEN u THEN 'unexpected' END, CASE WHEN n > 1 THEN 'duplicate' END, CASE WHEN NOT ends_with(lower(name), '.docx') THEN 'ending' END, CASE WHEN contains(name, '../') THEN 'unsafe' END], lambda x: x IS NOT NULL)) AS issue FROM j""")
def name_check(spark, d):
    s, k = load(spark, d, "supplier"), F.col("s_suppkey")
    e = s.where(k % 5 != 0).select(F.concat("s_name", F.lit(".docx")).alias("name"))
    a = s.select(F.concat(F.when(k % 8 == 0, "../").otherwise(""), "s_name", F.when(k % 7 == 0, ".pdf").otherwise(".docx")).alias("name"))
    return audit.name_check(e, a.unionByName(s.where(k % 13 == 0).select(F.concat("s_name", F.lit(".docx")).alias("name"))), "name", ".docx")


@query("""WITH c AS (SELECT l_suppkey AS doc, l_partkey % 20 AS tab, l_orderkey AS row, l_returnflag || l_linestatus AS x FROM lineitem), r AS (SELECT doc, tab, row, bool_or(contains(x, 'R')) AND bool_or(contains(x, 'F')) AS ok FROM c GROUP BY 1, 2, 3), t AS (SELECT doc, tab, count(*) AS n_rows, bool_or(ok) AS ok FROM r GROUP BY 1, 2)
SELECT doc, tab, n_rows FROM t WHERE ok QUALIFY row_number() OVER (PARTITION BY doc ORDER BY n_rows DESC, tab) = 1""")
def best_table(spark, d):
    c = load(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc"), (F.col("l_partkey") % 20).alias("tab"), F.col("l_orderkey").alias("row"), F.concat("l_returnflag", "l_linestatus").alias("x"))
    return audit.best_table(c, ["doc"], "tab", "row", "x", ["R", "F"])


@query("""WITH c AS (SELECT l_orderkey AS row, l_suppkey % 7 AS tab, ['score', 'grade'][l_linenumber % 2 + 1] AS field, l_returnflag AS value FROM lineitem) SELECT a.row, a.tab, a.value AS score, b.value AS grade FROM c a JOIN c b ON a.row = b.row AND a.tab = b.tab AND a.field = 'score' AND b.field = 'grade'""")
def on_one_row(spark, d):
    c = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("row"), (F.col("l_suppkey") % 7).alias("tab"), pick(("score", "grade"), "l_linenumber")[0]().alias("field"), F.col("l_returnflag").alias("value"))
    return audit.on_one_row(c, ["row"], ["tab"], "score", "grade")


@query("""WITH s AS (SELECT o_custkey AS doc, o_orderkey AS no, left(o_orderpriority, (o_orderkey % 6)::INT) AS t FROM orders WHERE o_orderkey % 2 = 0), f AS (SELECT o_custkey AS doc, o_orderkey AS id, left(o_orderpriority, (o_orderkey % 5)::INT) AS f FROM orders WHERE o_orderkey % 2 = 1),
j AS (SELECT s.doc, s.no, string_agg(DISTINCT id::VARCHAR, ',' ORDER BY id::VARCHAR) AS e FROM s JOIN f ON s.doc = f.doc AND t <> '' AND f <> '' AND (contains(t, f) OR contains(f, t)) GROUP BY 1, 2) SELECT s.doc, s.no, coalesce(e, '-1') AS evidence FROM s LEFT JOIN j ON j.doc = s.doc AND j.no = s.no""")
def supporting_facts(spark, d):
    o, n = load(spark, d, "orders"), F.col("o_orderkey")
    cut = lambda m: F.left("o_orderpriority", (n % m).cast("int"))
    s = o.where(n % 2 == 0).select(F.col("o_custkey").alias("doc"), n.alias("no"), cut(6).alias("t"))
    f = o.where(n % 2 == 1).select(F.col("o_custkey").alias("doc"), n.alias("id"), cut(5).alias("f"))
    out = audit.supporting(s, f, ["doc"], "no", "t", "id", "f", F.lit(-1).cast("long"))
    return out.select("doc", "no", F.array_join(F.array_sort(F.col("evidence").cast("array<string>")), ",").alias("evidence"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 2 = 0 THEN 'own' ELSE 'last' END AS label FROM customer")
def first_labels(spark, d):
    k = F.col("c_custkey")
    own = F.create_map(F.lit("a"), F.when(k % 2 == 0, "own").otherwise(" "), F.lit("b"), F.lit("last"))
    given = F.when(k % 3 == 0, F.create_map(F.lit("a"), F.col("c_mktsegment"))).otherwise(F.create_map().cast("map<string,string>"))
    return load(spark, d, "customer").select("c_custkey", audit.first_labels(own, given, ["a", "b"]).alias("label"))


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') QUALIFY (o_orderstatus = 'O') = min(o_orderstatus = 'O') OVER (PARTITION BY o_custkey)")
def tiered_evidence(spark, d):
    o = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return audit.lowest_tier_evidence(o, ["o_custkey"], [("F", 0), ("O", 1)], "o_orderstatus").select("o_custkey", "o_orderkey")
