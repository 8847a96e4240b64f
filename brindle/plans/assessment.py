"""Queries of scores, diagnoses, alignment, gates and retrieval, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import vocabulary as V
from brindle.operators import quality, retrieval, scoring
from brindle.plans.catalogue import load, query
from brindle.plans.reports import COUNT_SQL, NOTES_SQL, _summaries, has, pick, quoted

# ---- section scores

SECTIONS = tuple(V.SECTION_WEIGHTS)
SECTION, SECTION_SQL = pick(SECTIONS, "l_linenumber")
PRF = """round_even(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END, 6) AS precision, round_even(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END, 6) AS recall,
round_even(CASE WHEN 2 * tp + fp + fn = 0 THEN 1.0 WHEN tp = 0 THEN 0.0 ELSE 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) END, 6) AS f1"""
WEIGHT_SQL = "CASE section " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.SECTION_WEIGHTS.items()) + " END"
SCORES_SQL = f"""c AS (SELECT l_suppkey % 40 AS sample, {SECTION_SQL} AS section, count(*) FILTER (l_partkey % 3 <> 0 AND l_partkey % 5 <> 0)::BIGINT AS tp, count(*) FILTER (l_partkey % 3 = 0 AND l_partkey % 5 <> 0)::BIGINT AS fp, count(*) FILTER (l_partkey % 5 = 0)::BIGINT AS fn FROM lineitem GROUP BY 1, 2),
x AS (SELECT *, {PRF} FROM c), s AS (SELECT *, round_even(f1 * {WEIGHT_SQL}, 6) AS score FROM x)"""


def _scores(spark, d):
    five, three = F.col("l_partkey") % 5 == 0, F.col("l_partkey") % 3 == 0
    x = load(spark, d, "lineitem").select((F.col("l_suppkey") % 40).alias("sample"), SECTION().alias("section"), (~three & ~five).alias("a"), (three & ~five).alias("b"), five.alias("c"))
    counts = x.groupBy("sample", "section").agg(F.count_if("a").alias("tp"), F.count_if("b").alias("fp"), F.count_if("c").alias("fn"))
    return scoring.section_scores(counts, "sample", "section")


@query(f"WITH {SCORES_SQL} SELECT * FROM s")
def section_scores(spark, d):
    return _scores(spark, d)


@query(f"WITH {SCORES_SQL} SELECT sample, round_even(sum(score), 6) AS total FROM s GROUP BY 1")
def record_totals(spark, d):
    return scoring.record_totals(_scores(spark, d), "sample")


@query(f"WITH {SCORES_SQL} SELECT sample, round_even(sum(score) / 70.0 * 100, 6) AS total FROM s WHERE section IN ('summary', 'recommendations', 'defects') GROUP BY 1")
def partial_totals(spark, d):
    return scoring.partial_total(_scores(spark, d), "sample", "section")


@query(f"""WITH {SCORES_SQL}, p AS (SELECT section, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round_even(avg(f1), 6) AS macro_f1 FROM s GROUP BY 1), q AS (SELECT section, tp, fp, fn, {PRF}, macro_f1 FROM p),
e AS (SELECT *, round_even(f1 * {WEIGHT_SQL}, 6) AS micro_score, round_even(macro_f1 * {WEIGHT_SQL}, 6) AS macro_score FROM q), w AS (SELECT sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round_even(sum(micro_score), 6) AS micro_score FROM e)
SELECT * FROM e UNION ALL BY NAME SELECT NULL AS section, tp, fp, fn, {PRF}, NULL AS macro_f1, micro_score, (SELECT round_even(avg(t), 6) FROM (SELECT round_even(sum(score), 6) AS t FROM s GROUP BY sample)) AS macro_score FROM w""")
def dataset_scores(spark, d):
    return scoring.dataset_scores(_scores(spark, d), "sample", "section")


# ---- tolerant pairing of rows

FIELDS = ["location", "defect_type", "description"]
ROWS_SQL = """og AS (SELECT o_custkey AS doc, o_orderkey AS no, (o_orderkey % 5)::VARCHAR AS idx, [lower(o_orderstatus), lower(replace(o_orderpriority, ' ', '')), strftime(o_orderdate, '%Y-%m')] AS v FROM orders),
op AS (SELECT doc, no, idx, CASE WHEN no % 11 = 0 THEN [v[2], v[1], v[3]] WHEN no % 5 = 0 THEN [v[1], '1-urgent', v[3]] WHEN no % 13 = 0 THEN ['', v[2], v[3] || 'x'] ELSE v END AS v FROM og WHERE no % 7 <> 0),
ls AS (SELECT doc, g, coalesce(p, []) AS p FROM (SELECT doc, list({'no': no, 'idx': idx, 'v': v} ORDER BY no) AS g FROM og GROUP BY 1) LEFT JOIN (SELECT doc, list({'no': no, 'idx': idx, 'v': v} ORDER BY no) AS p FROM op GROUP BY 1) USING (doc))"""
CLOSE = {
    "a": "len(list_filter([1, 2], lambda i: e.x.v[i] <> '' AND e.x.v[i] = y.v[i]))", "b": "len(list_filter([1, 2, 3], lambda i: e.x.v[i] <> '' AND e.x.v[i] = y.v[i]))",
    "c": "len(list_filter([1, 2, 3], lambda i: y.v[i] <> '' AND len(list_filter([1, 2, 3], lambda j: j <> i AND e.x.v[j] = y.v[i])) > 0))",
    "d": "coalesce(list_sum(list_transform(list_distinct(list_filter(e.x.v, lambda z: z <> '')), lambda z: least(len(list_filter(e.x.v, lambda q: q = z)), len(list_filter(y.v, lambda q: q = z))))), 0)::BIGINT",
    "e": "(e.x.idx <> '' AND e.x.idx = y.idx)::BIGINT",
}
TUPLES = f"list_filter(list_transform(list_filter(e.p, lambda y: len(list_filter(a.acc, lambda q: q.p = y.no)) = 0), lambda y: [{', '.join(CLOSE[k] for k in 'abcde')}, -y.no]), lambda t: t[1] > 0 OR t[2] > 0 OR t[3] > 0 OR (t[5] > 0 AND t[4] > 0))"
CELL = "{{'acc': {acc}, 'x': {x}, 'p': {p}}}"
KIND = "STRUCT(g BIGINT, p BIGINT, ties BOOLEAN)[]"
STEP = f"CASE WHEN len({TUPLES}) = 0 THEN a.acc ELSE list_append(a.acc, {{'g': e.x.no, 'p': -list_sort({TUPLES}, 'DESC')[1][6], 'ties': len(list_filter({TUPLES}, lambda t: t[1:5] = list_sort({TUPLES}, 'DESC')[1][1:5])) > 1}}) END"
PAIRS_SQL = f"""{ROWS_SQL}, fo AS (SELECT doc, g, p, list_reduce(list_prepend({CELL.format(acc=f"[]::{KIND}", x="g[1]", p="p")}, list_transform(g, lambda r: {CELL.format(acc=f"[]::{KIND}", x="r", p="p")})), lambda a, e: {CELL.format(acc=STEP, x="e.x", p="e.p")}).acc AS prs FROM ls),
pr AS (SELECT doc, unnest(prs) AS q FROM fo), al AS (SELECT pr.doc, q.g AS gold_no, q.p AS predicted_no, q.ties AS ambiguous FROM pr UNION ALL SELECT og.doc, no, NULL, false FROM og WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.doc = og.doc AND q.g = no)
UNION ALL SELECT op.doc, NULL, no, false FROM op WHERE NOT EXISTS (SELECT 1 FROM pr WHERE pr.doc = op.doc AND q.p = no)),
w AS (SELECT al.*, og.v AS gv, op.v AS pv FROM al LEFT JOIN og ON og.doc = al.doc AND og.no = gold_no LEFT JOIN op ON op.doc = al.doc AND op.no = predicted_no)"""


def _row_pairs(spark, d):
    status, priority, month, no = F.col("o_orderstatus"), F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM"), F.col("o_orderkey")
    o = load(spark, d, "orders").select(F.col("o_custkey").alias("doc"), no.alias("no"), (no % 5).alias("idx"), status.alias("location"), priority.alias("defect_type"), month.alias("description"))
    n = F.col("no")
    swap, urgent, cut = n % 11 == 0, n % 5 == 0, n % 13 == 0
    p = o.where(n % 7 != 0).select(
        "doc", "no", "idx", F.when(swap, F.col("defect_type")).when(~urgent & cut, "").otherwise(F.col("location")).alias("location"),
        F.when(swap, F.col("location")).when(urgent, "1-URGENT").otherwise(F.col("defect_type")).alias("defect_type"), F.when(~swap & ~urgent & cut, F.concat("description", F.lit("x"))).otherwise(F.col("description")).alias("description"),
    )
    return scoring.pair_rows(o, p, "doc", "no", "idx", FIELDS)


@query(f"WITH {PAIRS_SQL} SELECT doc, gold_no, predicted_no, ambiguous FROM al")
def tolerant_row_diag(spark, d):
    """True rows choose the closest predicted row left, in order; all rows of a customer take part."""
    return _row_pairs(spark, d).select("doc", "gold_no", "predicted_no", "ambiguous")


MOVES = lambda i: f"((pv[{i}] <> '' AND len(list_filter([1, 2, 3], lambda j: j <> {i} AND gv[j] = pv[{i}])) > 0) OR (gv[{i}] <> '' AND len(list_filter([1, 2, 3], lambda j: j <> {i} AND pv[j] = gv[{i}])) > 0))"
STATUS_SQL = " UNION ALL ".join(f"SELECT doc, gold_no, predicted_no, '{f}' AS field, CASE WHEN predicted_no IS NULL THEN 'missing' WHEN gold_no IS NULL THEN 'extra' WHEN gv[{i}] = pv[{i}] THEN 'matched' WHEN {MOVES(i)} THEN 'wrong_column' ELSE '{'description_difference' if f == 'description' else 'value_difference'}' END AS status FROM w" for i, f in enumerate(FIELDS, 1))


@query(f"WITH {PAIRS_SQL}, t AS ({STATUS_SQL}) SELECT field, status, count(*) AS n FROM t GROUP BY 1, 2")
def field_statuses(spark, d):
    return scoring.field_statuses(_row_pairs(spark, d), "doc", FIELDS).groupBy("field", "status").agg(F.count("*").alias("n"))


@query(f"""WITH {PAIRS_SQL}, k AS (SELECT *, gold_no IS NOT NULL AND predicted_no IS NOT NULL AS two, coalesce(gv = pv, false) AS same FROM w)
SELECT doc, count(*) FILTER (two AND same) AS tp, count(*) FILTER ((two AND NOT same) OR gold_no IS NULL) AS fp, count(*) FILTER ((two AND NOT same) OR predicted_no IS NULL) AS fn, count(*) FILTER (two AND same) AS matched_rows, count(*) FILTER (two AND NOT same) AS paired_rows,
count(*) FILTER (predicted_no IS NULL) AS missing_rows, count(*) FILTER (gold_no IS NULL) AS extra_rows, count(*) FILTER (ambiguous) AS ambiguous FROM k GROUP BY 1""")
def row_counts(spark, d):
    return scoring.row_counts(_row_pairs(spark, d), "doc")


@query(f"""WITH {PAIRS_SQL}, k AS (SELECT doc, count(*) FILTER (gold_no IS NOT NULL) AS n_gold, count(*) FILTER (predicted_no IS NULL) AS lost FROM w GROUP BY 1), b AS (SELECT *, CASE WHEN n_gold <= 0 THEN '0' WHEN n_gold <= 10 THEN '1-10' WHEN n_gold <= 50 THEN '11-50' ELSE '51+' END AS bucket, CASE WHEN doc % 2 = 0 THEN 'bridge' ELSE 'tunnel' END AS facility FROM k)
SELECT bucket, facility, count(*) AS n, sum(lost)::BIGINT AS lost FROM b GROUP BY GROUPING SETS ((bucket), (facility), ())""")
def bucket_summary(spark, d):
    k = _row_pairs(spark, d).groupBy("doc").agg(F.count_if(F.col("gold_no").isNotNull()).alias("n_gold"), F.count_if(F.col("predicted_no").isNull()).alias("lost"))
    x = k.withColumn("facility", F.when(F.col("doc") % 2 == 0, "bridge").otherwise("tunnel"))
    return scoring.bucketed(x, scoring.size_bucket(F.col("n_gold")), ["facility"], ["lost"]).withColumnRenamed("n_records", "n")


@query("WITH x AS (SELECT user_id, event_type AS k, event_id % 4 AS n FROM events WHERE event_type IS NOT NULL), s AS (SELECT user_id, k, sum(n)::BIGINT AS n FROM x GROUP BY 1, 2) SELECT user_id, string_agg(k || '=' || n, ',' ORDER BY k) AS counts FROM s GROUP BY 1")
def summed_maps(spark, d):
    x = load(spark, d, "events").where("event_type IS NOT NULL").select("user_id", F.create_map(F.col("event_type"), F.col("event_id") % 4).alias("counts"))
    return scoring.summed_maps(x, ["user_id"], "counts").select("user_id", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("counts"))


# ---- alignment

PATHS_SQL = """m AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN './' ELSE '' END || CASE s_suppkey % 3 WHEN 0 THEN 'a/' ELSE '' END || s_name || '.docx' AS s FROM supplier),
p AS (SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'other/' ELSE 'root/' || CASE WHEN s_suppkey % 3 = 0 THEN 'a/' ELSE '' END END || s_name || '.docx' AS f FROM supplier WHERE s_suppkey % 11 <> 0 UNION ALL SELECT 'second/a/' || s_name || '.docx' FROM supplier WHERE s_suppkey % 9 = 0)"""


@query(f"""WITH {PATHS_SQL}, n AS (SELECT s_suppkey, regexp_replace(s, '^(\\./)+', '') AS s FROM m), j AS (SELECT n.s_suppkey, n.s, f FROM n JOIN p ON f = s OR ends_with(f, '/' || s) OR ends_with(s, '/' || f)), k AS (SELECT s_suppkey, s, count(*) AS n, min(f) AS f FROM j GROUP BY 1, 2), c AS (SELECT f, count(*) AS claims FROM k GROUP BY 1),
t AS (SELECT n.s_suppkey, n.s, k.f, CASE WHEN k.n IS NULL THEN 'missing' WHEN k.n > 1 OR claims > 1 THEN 'ambiguous' ELSE 'aligned' END AS status FROM n LEFT JOIN k ON k.s_suppkey = n.s_suppkey LEFT JOIN c ON c.f = k.f) SELECT s_suppkey, s AS source, CASE WHEN status = 'aligned' THEN f END AS file, status FROM t""")
def align_paths(spark, d):
    s, k = load(spark, d, "supplier"), F.col("s_suppkey")
    a = F.when(k % 3 == 0, "a/").otherwise("")
    m = s.select("s_suppkey", F.concat(F.when(k % 4 == 0, "./").otherwise(""), a, "s_name", F.lit(".docx")).alias("source"))
    p = s.where(k % 11 != 0).select(F.concat(F.when(k % 5 == 0, F.lit("other/")).otherwise(F.concat(F.lit("root/"), a)), "s_name", F.lit(".docx")).alias("file"))
    return scoring.align_paths(m, p.unionByName(s.where(k % 9 == 0).select(F.concat(F.lit("second/a/"), "s_name", F.lit(".docx")).alias("file"))), "s_suppkey", "source", "file")


@query("SELECT g.s_suppkey AS gold_key, p.s_suppkey AS predicted_key, CASE WHEN g.s_suppkey IS NULL THEN 'extra' WHEN p.s_suppkey IS NULL THEN 'missing' ELSE 'aligned' END AS status FROM (SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 <> 0) g FULL JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 5 <> 0) p ON g.s_suppkey = p.s_suppkey")
def align_by_id(spark, d):
    s = load(spark, d, "supplier")
    return scoring.align_records(s.where("s_suppkey % 7 <> 0"), s.where("s_suppkey % 5 <> 0"), "s_suppkey", "s_name")


@query("""WITH g AS (SELECT nullif(s_suppkey, 3) AS k, row_number() OVER (ORDER BY s_name) AS r FROM supplier WHERE s_suppkey % 7 <> 0), p AS (SELECT s_suppkey AS k, row_number() OVER (ORDER BY s_name) AS r FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT g.k AS gold_key, p.k AS predicted_key, CASE WHEN g.r IS NULL THEN 'extra' WHEN p.r IS NULL THEN 'missing' ELSE 'aligned' END AS status FROM g FULL JOIN p ON g.r = p.r""")
def align_by_position(spark, d):
    s = load(spark, d, "supplier")
    return scoring.align_records(s.where("s_suppkey % 7 <> 0").withColumn("s_suppkey", F.nullif("s_suppkey", F.lit(3))), s.where("s_suppkey % 5 <> 0"), "s_suppkey", "s_name")


@query("""WITH o AS (SELECT DISTINCT n_nationkey AS owner, unnest([n_name, left(n_name, 3), 'all ' || n_regionkey]) AS a FROM nation), i AS (SELECT s_suppkey AS item, CASE s_suppkey % 4 WHEN 0 THEN 'all 1' WHEN 1 THEN left(n_name, 3) WHEN 2 THEN n_name ELSE '?' END AS a FROM supplier JOIN nation ON s_nationkey = n_nationkey),
p AS (SELECT item, count(owner) AS n, min(owner) AS owner FROM i LEFT JOIN o USING (a) GROUP BY 1), c AS (SELECT owner, count(*) AS claims FROM p WHERE n = 1 GROUP BY 1), t AS (SELECT item, p.owner, CASE WHEN n = 0 THEN 'missing' WHEN n > 1 THEN 'ambiguous' WHEN claims > 1 THEN 'duplicate' ELSE 'matched' END AS status FROM p LEFT JOIN c ON c.owner = p.owner)
SELECT item, CASE WHEN status IN ('matched', 'duplicate') THEN owner END AS owner, status FROM t""")
def alias_matches(spark, d):
    n = load(spark, d, "nation")
    owners = n.select(F.col("n_nationkey").alias("owner"), F.array("n_name", F.left("n_name", F.lit(3)), F.concat(F.lit("all "), F.col("n_regionkey").cast("string"))).alias("names"))
    s = load(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    k = F.col("s_suppkey") % 4
    items = s.select(F.col("s_suppkey").alias("item"), F.when(k == 0, "all 1").when(k == 1, F.left("n_name", F.lit(3))).when(k == 2, F.col("n_name")).otherwise("?").alias("name"))
    return scoring.match_aliases(owners, items, "owner", "names", "item", "name")


# ---- gates

EXTRA = ("无。本次检测未见异常", "综上，报告建议维修", "已有证据为空", "影响安全", "不满足要求", "无往年检测评分", "暂不影响结构安全", "正常")
MORE, MORE_SQL = pick(EXTRA, "o_custkey")
RECORD_SQL = f"""{COUNT_SQL}, lines AS (SELECT *, n0 || '条' || '{V.CATEGORIES[0]}' || '、' || n1 || '条' || '{V.CATEGORIES[1]}' || '、' || n2 || '条' || '{V.CATEGORIES[2]}' AS line FROM k), {NOTES_SQL.replace("s0 AS", "s0x AS").replace("FROM s0)", "FROM s0x)").replace(", s AS", ", sx AS")}, f AS (SELECT o_custkey, string_agg(note, '' ORDER BY o_orderkey) AS all_notes, arg_min(note, o_orderkey) AS note FROM n GROUP BY 1),
rec AS (SELECT f.o_custkey, CASE WHEN f.o_custkey % 3 = 0 THEN line ELSE 'x' || line END AS said, line, left(all_notes, 300) AS overall, note AS risk, [note, {MORE_SQL}] AS detailed, [{MORE_SQL.replace("o_custkey", "(f.o_custkey + 3)")}, note] AS safety, n0 + n1 + n2 AS n_rows, f.o_custkey % 4 AS n_blank FROM f JOIN lines l ON l.o_custkey = f.o_custkey)"""
CODES = [
    ("blank_recommendation_category", "n_blank > 0"), ("recommendation_summary_mismatch", "n_rows > 0 AND said <> line"), ("missing_value_sentence_splice", "contains(j, '无。本次检测')"), ("generic_composer_marker", has("j", V.MADE_UP)),
    ("overall_conclusion_too_long", "length(overall) > 250"), ("overall_conclusion_contains_action", has("overall", ("建议", "维修", "修复", "处治", "处置"))), ("risk_points_too_long", "length(risk) > 200"),
    ("risk_points_contains_action", has("risk", ("建议", "维修", "修复", "处治", "处置", "可直接用", "环氧砂浆"))), ("detailed_conclusion_contains_recommendation", "contains(d, '综上，报告建议')"), ("unsupported_no_history_statement", "contains(d, '无往年检测评分')"),
    ("safety_meta_text", has("s", ("已有证据为", "报告未明确"))), ("safety_conclusion_conflict", has("s", V.REASSURING) + " AND regexp_matches(regexp_replace(s, '(暂不|不|未)\\s*影响(结构)?(安全|承载能力|承载)', '', 'g'), '影响安全|影响承载|承载能力不足|不满足要求')"),
]


@query(f"""WITH {RECORD_SQL.replace("[" + quoted(EXTRA) + "][(o_custkey)", "[" + quoted(EXTRA) + "][(f.o_custkey)")}, t AS (SELECT *, array_to_string(detailed, chr(10)) AS d, array_to_string(safety, chr(10)) AS s, overall || chr(10) || risk || chr(10) || array_to_string(detailed, chr(10)) || chr(10) || '' || chr(10) || array_to_string(safety, chr(10)) AS j FROM rec)
SELECT o_custkey, unnest(list_filter([{", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in CODES)}], lambda x: x IS NOT NULL)) AS code FROM t""")
def consistency_issues(spark, d):
    from brindle.plans.reports import _notes

    n = _notes(spark, d)
    f = n.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list(F.struct("o_orderkey", "note")))["note"], "").alias("notes"), F.min_by("note", "o_orderkey").alias("note"))
    later = F.get(F.array(*[F.lit(x) for x in EXTRA]), F.expr("cast((o_custkey + 3) % 8 as int)"))
    r = f.join(_summaries(spark, d), "o_custkey").select(
        "o_custkey", F.when(F.col("o_custkey") % 3 == 0, F.col("line")).otherwise(F.concat(F.lit("x"), "line")).alias("recommendations_summary"), F.col("line").alias("expected_summary"), F.left("notes", F.lit(300)).alias("overall_conclusion"), F.col("note").alias("risk_points"),
        F.array("note", MORE()).alias("detailed"), F.array().cast("array<string>").alias("causes"), F.array(later, F.col("note")).alias("safety"), (F.col("n0") + F.col("n1") + F.col("n2")).alias("n_rows"), (F.col("o_custkey") % 4).alias("n_blank"),
    )
    return quality.consistency_issues(r, ["o_custkey"])


@query(f"""WITH r AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN '无' WHEN 1 THEN '87' END AS sc, CASE c_custkey % 4 WHEN 0 THEN '' ELSE 'B' END AS gr, CASE c_custkey % 5 WHEN 0 THEN '不适用' ELSE '新增裂缝' END AS tr, CASE c_custkey % 7 WHEN 0 THEN '本次为首次检测' ELSE 'x' END AS de, c_custkey % 2 AS st, c_custkey % 6 AS co FROM customer),
b AS (SELECT *, coalesce(sc, '') IN ('', '无', '不适用') AS b1, gr = '' AS b2, tr = '不适用' AS b3 FROM r)
SELECT c_custkey, unnest(list_filter([CASE WHEN b1 AND b2 AND NOT b3 THEN 'trend_without_previous_score' END, CASE WHEN contains(de, '首次') AND NOT b3 THEN 'first_inspection_with_trend' END, CASE WHEN st <> co THEN 'recommendation_count_mismatch' END], lambda x: x IS NOT NULL)) AS code FROM b""")
def label_issues(spark, d):
    k = F.col("c_custkey")
    r = load(spark, d, "customer").select(
        "c_custkey", F.when(k % 3 == 0, "无").when(k % 3 == 1, "87").alias("sc"), F.when(k % 4 == 0, "").otherwise("B").alias("gr"), F.when(k % 5 == 0, "不适用").otherwise("新增裂缝").alias("tr"), F.when(k % 7 == 0, "本次为首次检测").otherwise("x").alias("de"),
        F.create_map(F.lit("尽快维修"), k % 2).alias("st"), F.create_map(F.lit("尽快维修"), k % 6).alias("co"),
    )
    return quality.label_issues(r, ["c_custkey"], "sc", "gr", "tr", "de", "st", "co")


# ---- retrieval

KINDS = ("knowledge", "label", "report_evidence")
INDEX_SQL = """ix AS (SELECT vec_id AS entry_id, ['knowledge', 'label', 'report_evidence'][label % 3 + 1] AS kind, vec_id % 20 AS sample_id, CASE vec_id % 3 WHEN 0 THEN 'fit' WHEN 1 THEN 'holdout' END AS split, ['bridge', '', 'Tunnel'][vec_id % 3 + 1] AS facility, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
qs AS (SELECT vec_id AS query_id, vec_id % 20 AS q_sample, ['fit', 'holdout', ''][(vec_id // 50) % 3 + 1] AS q_split, list_transform(embedding, lambda x: x::DOUBLE) AS qe FROM embeddings WHERE vec_id % 50 = 0),
sc AS (SELECT query_id, entry_id, kind, list_inner_product(e, qe) / (sqrt(list_inner_product(e, e)) * sqrt(list_inner_product(qe, qe))) AS score FROM ix JOIN qs ON entry_id <> query_id WHERE lower(facility) IN ('bridge', '') AND (kind <> 'report_evidence' OR sample_id = q_sample) AND NOT (kind = 'label' AND sample_id = q_sample)
AND NOT (kind = 'label' AND q_split IN ('fit', 'holdout') AND coalesce(split, '') <> 'fit'))"""


def _retrieval(spark, d, **kw):
    e, v = load(spark, d, "embeddings"), F.col("vec_id")
    index = e.select(v.alias("entry_id"), pick(KINDS, "label")[0]().alias("kind"), (v % 20).alias("sample_id"), F.when(v % 3 == 0, "fit").when(v % 3 == 1, "holdout").alias("split"), pick(("bridge", "", "Tunnel"), "vec_id")[0]().alias("facility"), "embedding")
    queries = e.where(v % 50 == 0).select(v.alias("query_id"), (v % 20).alias("q_sample"), pick(("fit", "holdout", ""), "vec_id div 50")[0]().alias("q_split"), F.col("embedding").alias("query_embedding"))
    admit = retrieval.admits(F.col("facility"), F.array(F.lit("bridge")), F.col("kind"), F.col("sample_id"), F.col("q_sample"), F.col("split"), F.col("q_split")) & (F.col("entry_id") != F.col("query_id"))
    return retrieval.retrieve(index, queries, admit, **kw)


@query(f"WITH {INDEX_SQL} SELECT query_id, entry_id, kind, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY sc.score DESC, entry_id)::INT AS rank FROM sc QUALIFY rank <= 6")
def retrieve_admitted(spark, d):
    return _retrieval(spark, d).select("query_id", "entry_id", "kind", F.round("score", 6).alias("score"), "rank")


@query(f"""WITH {INDEX_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY query_id, kind ORDER BY score DESC, entry_id) AS r FROM sc) SELECT query_id, entry_id, kind, round(score, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY CASE kind WHEN 'label' THEN 0 ELSE 1 END, r)::INT AS rank
FROM k WHERE (kind = 'label' AND r <= 2) OR (kind = 'knowledge' AND r <= 5) QUALIFY rank <= 6""")
def retrieve_by_quota(spark, d):
    return _retrieval(spark, d, quotas={"label": 2, "knowledge": 5}).select("query_id", "entry_id", "kind", F.round("score", 6).alias("score"), "rank")


RERANK_SQL = "rr AS (SELECT q.vec_id AS query_id, i.vec_id AS entry_id, (i.vec_id * 7 % 11)::DOUBLE AS s, i.vec_id % 5 AS place FROM embeddings q JOIN embeddings i ON q.vec_id % 50 = 0 AND i.vec_id % 3 <> 2)"


@query(f"""WITH {INDEX_SQL}, {RERANK_SQL}, k AS (SELECT query_id, entry_id FROM sc QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, entry_id) <= 8)
SELECT k.query_id, k.entry_id, s AS score, row_number() OVER (PARTITION BY k.query_id ORDER BY s DESC, place, k.entry_id)::INT AS rank FROM k JOIN rr ON rr.query_id = k.query_id AND rr.entry_id = k.entry_id QUALIFY rank <= 6""")
def retrieve_reranked(spark, d):
    """A stated query set's rerank scores for entries; a live reranker would return such a table."""
    e, v = load(spark, d, "embeddings"), F.col("vec_id")
    answers = e.where(v % 3 != 2).select(v.alias("entry_id"), (v * 7 % 11).cast("double").alias("rerank_score"), (v % 5).alias("place"), F.explode(F.array(*[F.lit(q) for q in sorted(r[0] for r in e.where(v % 50 == 0).select("vec_id").collect())])).alias("query_id"))
    return _retrieval(spark, d, reranked=answers).select("query_id", "entry_id", "score", "rank")


@query("""SELECT vec_id AS entry_id FROM embeddings WHERE NOT (label % 3 = 1 AND vec_id % 20 = 4) AND (label % 3 <> 1 OR vec_id % 3 = 0) AND vec_id % 13 <> 0""")
def index_entries(spark, d):
    v = F.col("vec_id")
    e = load(spark, d, "embeddings").select(v.alias("entry_id"), pick(KINDS, "label")[0]().alias("kind"), (v % 20).cast("string").alias("sample_id"), F.when(v % 3 == 0, "fit").when(v % 3 == 1, "holdout").alias("split"), F.when(v % 13 == 0, " ").otherwise("text").alias("text"))
    return retrieval.buildable(e, "4", True).select("entry_id")


@query("SELECT item_id AS entry_id, length(text)::BIGINT AS n FROM benchmark")
def reused_vectors(spark, d):
    b = load(spark, d, "benchmark").select(F.col("item_id").alias("entry_id"), "text")
    return retrieval.reusable(b, b.withColumn("embedding", F.array(F.length("text").cast("double")))).select("entry_id", F.col("embedding")[0].cast("long").alias("n"))


@query("""WITH h AS (SELECT l_orderkey, l_partkey % 50 AS entry_id, l_returnflag AS kind, CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS t, l_linenumber AS r FROM lineitem), f AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY l_orderkey, entry_id ORDER BY t, r, kind) = 1),
c AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY l_orderkey, kind ORDER BY t, r, entry_id) <= CASE kind WHEN 'A' THEN 2 WHEN 'N' THEN 3 ELSE 1 END) SELECT l_orderkey, entry_id, kind, row_number() OVER (PARTITION BY l_orderkey ORDER BY t, r, entry_id)::INT AS rank FROM c""")
def merged_hits(spark, d):
    h = load(spark, d, "lineitem").select("l_orderkey", (F.col("l_partkey") % 50).alias("entry_id"), F.col("l_returnflag").alias("kind"), "l_linestatus", F.col("l_linenumber").alias("rank"))
    return retrieval.merge_hits(h, ["l_orderkey"], F.when(F.col("l_linestatus") == "O", 0).otherwise(1), {"A": 2, "N": 3})


@query("""WITH f AS (SELECT user_id, event_id, event_type, value, length(props) AS n FROM events WHERE value IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) <= CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END AS reserved FROM f)
SELECT user_id, event_id, reserved, used FROM (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY reserved DESC, value DESC, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS used FROM r) WHERE used <= 120""")
def context_facts(spark, d):
    x = load(spark, d, "events").where("value IS NOT NULL")
    return retrieval.context_facts(x, ["user_id"], "event_type", {"click": 2, "view": 1}, "value", "event_id", F.length("props"), 120).select("user_id", "event_id", "reserved", "used")
