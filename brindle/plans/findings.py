"""Queries of defect rows and summary fields, over records made from the driver's tables, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import vocabulary as V
from brindle.operators import defects, summary
from brindle.plans.catalogue import load, query
from brindle.plans.reports import has, pick

KEY = lambda x: f"regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"

# ---- tables of defects

CELLS = ("序号", "病害部位", "病害类型", "病害描述", "1", "主梁", "裂缝", "2#墩 裂缝，见图3-1", "描述", "缺陷 位置", "发展趋势", "渗水", "左幅", "无", "类型", "具体描述", "部位/位置")
CELL, CELL_SQL = pick(CELLS, "l_orderkey * 3 + l_linenumber * 5")
TABLE_SQL = f"tb AS (SELECT l_orderkey % 400 AS doc, l_orderkey AS row, l_linenumber AS col, (l_partkey % 3)::INT AS span, {CELL_SQL} AS x FROM lineitem)"
NAMED_SQL = "[" + ", ".join(f"CASE WHEN {' OR '.join((f'''k = '{a}' ''' if a in V.EXACT_HEADERS else f'''contains(k, '{a}')''') for a in names)} THEN '{f}' END" for f, names in V.DEFECT_HEADERS) + "]"
HEAD_SQL = f"{TABLE_SQL}, hd AS (SELECT doc, row, f AS field, min(col) AS col, count(DISTINCT col) > 1 AS ambiguous FROM (SELECT doc, row, col, unnest({NAMED_SQL}) AS f FROM (SELECT *, {KEY('x')} AS k FROM tb)) WHERE f IS NOT NULL GROUP BY 1, 2, 3)"


def _cells(spark, d):
    return load(spark, d, "lineitem").select((F.col("l_orderkey") % 400).alias("doc"), F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("col"), (F.col("l_partkey") % 3).cast("int").alias("span"), CELL().alias("x"))


@query(f"WITH {HEAD_SQL} SELECT * FROM hd")
def header_rows(spark, d):
    return defects.header_rows(_cells(spark, d), ["doc"], "row", "col", "x")


@query(f"""WITH {TABLE_SQL}, c AS (SELECT DISTINCT doc, row, unnest(range(col, col + greatest(span, 1))) AS c FROM tb), r AS (SELECT doc, row, list(c ORDER BY c) AS cs FROM c GROUP BY 1, 2), w AS (SELECT doc, arg_max(cs, len(cs) * 1000000000 - row) AS cs FROM r GROUP BY 1)
SELECT doc, unnest(['index', 'location', 'defect_type'][1:len(cs)]) AS field, unnest(cs[1:3])::INT AS "column" FROM w""")
def positional_columns(spark, d):
    return defects.positional_columns(_cells(spark, d), ["doc"], "row", "col", "span", ["index", "location", "defect_type"])


@query(f"""WITH {HEAD_SQL}, b AS (SELECT DISTINCT doc, row FROM tb WHERE NOT EXISTS (SELECT 1 FROM hd WHERE hd.doc = tb.doc AND hd.row = tb.row)),
l AS (SELECT b.doc, b.row, hd.field, arg_max(hd.col, hd.row) AS cl FROM b JOIN hd ON hd.doc = b.doc AND hd.row < b.row GROUP BY 1, 2, 3)
SELECT l.doc, l.row, l.field, arg_min(x, col) AS x FROM l JOIN tb ON tb.doc = l.doc AND tb.row = l.row AND col <= cl AND cl < col + greatest(span, 1) GROUP BY 1, 2, 3""")
def carried_columns(spark, d):
    c = _cells(spark, d)
    return defects.carried_columns(c, defects.header_rows(c, ["doc"], "row", "col", "x"), ["doc"], "row", "col", "span", "x")


PLACES = ("主梁", "2#墩", "左幅", "桥面铺装", "", "K1+20护栏", "顶板", "右幅2#跨")
KINDS = ("裂缝", "渗水", "现状", "无", "", "露筋锈蚀", "良好")
DETAIL = ("左侧 裂缝L=2m，图1", "渗水泛碱", "未见病害", "图3 裂缝", "", "裂缝L=2m", "混凝土破损，照片2", "无", "单位：mm", "外观完好", "裂缝L=2m，见图1", "左幅渗水泛碱面积大", "图3-1")
PLACE, PLACE_SQL = pick(PLACES, "o_orderkey")
KIND, KIND_SQL = pick(KINDS, "o_orderkey * 5 + o_custkey")
WORDS, WORDS_SQL = pick(DETAIL, "o_orderkey * 3 + o_custkey * 7")
INDEX, INDEX_SQL = pick(("1", "", "图3-1", "2"), "o_orderkey")
ROWS_SQL = f"rw AS (SELECT o_custkey AS doc, o_orderkey AS no, {INDEX_SQL} AS i, {PLACE_SQL} AS l, {KIND_SQL} AS k, {WORDS_SQL} AS d FROM orders)"


def _rows(spark, d):
    return load(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("no"), INDEX().alias("i"), PLACE().alias("l"), KIND().alias("k"), WORDS().alias("d"))


@query(f"""WITH {ROWS_SQL}, t AS (SELECT *, i || l || k || d AS w, trim(k || ' ' || d) AS b FROM rw)
SELECT no, CASE WHEN w = '' THEN 'placeholder' WHEN no % 17 = 0 THEN 'repeated_header' WHEN regexp_matches(i, '{V.CAPTION}') AND (d = '' OR d = i) THEN 'photo_caption' WHEN regexp_matches(w, '{V.UNIT_ROW}') OR regexp_matches(w, '{V.PLACEHOLDER}') THEN 'unit_or_placeholder'
WHEN NOT CASE WHEN b = '' OR regexp_matches(k, '{V.PLACEHOLDER}') THEN false WHEN {has("b", V.NO_DEFECT)} THEN {has("k", V.DEFECT_TERMS)} OR k IN ({", ".join(f"'{x}'" for x in V.FORMAL_STATES)}) ELSE {has("b", V.DEFECT_TERMS)} OR k IN ({", ".join(f"'{x}'" for x in V.FORMAL_STATES)}) END AND no % 19 <> 0 THEN 'non_defect_state' END AS issue FROM t""")
def row_issues(spark, d):
    c = F.col
    return _rows(spark, d).select("no", defects.row_issue(c("i"), c("l"), c("k"), c("d"), c("no") % 17 == 0, c("no") % 19 == 0).alias("issue"))


@query(f"""WITH {ROWS_SQL}, s AS (SELECT no, l, regexp_extract(d, '^(左幅|右幅|左侧|右侧)', 1) AS s, CASE no % 3 WHEN 0 THEN '上部结构' ELSE '' END AS c FROM rw), t AS (SELECT no, c, CASE WHEN l <> '' AND s <> '' AND NOT regexp_matches(l, '^(左幅|右幅|左侧|右侧)') THEN s || l ELSE l END AS l FROM s)
SELECT no, CASE WHEN l IN ('左幅', '右幅') AND c <> '' THEN l || c ELSE l END AS location FROM t""")
def sided_locations(spark, d):
    return _rows(spark, d).select("no", defects.with_side(F.col("l"), F.col("d"), F.when(F.col("no") % 3 == 0, "上部结构").otherwise("")).alias("location"))


@query(f"WITH {ROWS_SQL} SELECT no, CASE WHEN trim(i) = '' THEN (row_number() OVER (PARTITION BY doc ORDER BY no))::VARCHAR ELSE i END AS i FROM rw")
def numbered_rows(spark, d):
    return defects.numbered(_rows(spark, d), ["doc"], ["no"], "i").select("no", "i")


FIGS = lambda x: f"list_distinct(regexp_extract_all({x}, '{V.FIGURE}', 1))"
ITEM = "{{'no': {no}, 'core': {core}, 'f': {f}, 'e': {e}}}"
SAME = "(y.core <> '' AND y.core = e[1].core) OR len(list_intersect(y.f, e[1].f)) > 0 OR (length(y.core) >= 4 AND length(e[1].core) >= 4 AND (contains(y.core, e[1].core) OR contains(e[1].core, y.core)))"
KEPT = f"list_filter(a, lambda y: {SAME})[1].no"


@query(f"""WITH {ROWS_SQL}, k AS (SELECT doc, {KEY("l")} AS kl, {KEY("k")} AS kk, list([{ITEM.format(no="no", core=KEY("d"), f=FIGS("d"), e="[no]")}] ORDER BY no) AS items FROM rw GROUP BY ALL),
r AS (SELECT doc, list_reduce(items, lambda a, e: CASE WHEN len(list_filter(a, lambda y: {SAME})) = 0 THEN list_concat(a, e) ELSE list_transform(a, lambda y: CASE WHEN y.no = {KEPT} THEN {ITEM.format(no="y.no", core="y.core", f="y.f", e="list_concat(y.e, e[1].e)")} ELSE y END) END) AS kept FROM k), u AS (SELECT doc, unnest(kept) AS y FROM r)
SELECT doc, y.no AS no, array_to_string(list_transform(list_sort(y.e), lambda v: v::VARCHAR), ',') AS evidence FROM u""")
def distinct_observations(spark, d):
    out = defects.distinct_observations(_rows(spark, d).withColumn("ev", F.col("no")), ["doc"], ["no"], "l", "k", "d", "ev")
    return out.select("doc", "no", F.array_join(F.array_sort("ev").cast("array<string>"), ",").alias("evidence"))


@query(f"""SELECT no, CASE {" ".join(f"WHEN {has('l', ws)} THEN '{c}'" for c, ws in V.COMPONENT_TERMS)} END AS component, array_to_string(terms, ',') AS terms FROM (SELECT no, l, list_reduce(list_prepend([]::VARCHAR[], list_transform(list_filter([{", ".join(f"'{t}'" for t in sorted((t for t in V.DEFECT_TERMS if not t.startswith("无")), key=lambda t: (-len(t), t)))}],
lambda w: contains(x, w)), lambda w: [w])), lambda a, e: CASE WHEN len(list_filter(a, lambda k: contains(k, e[1]))) > 0 THEN a ELSE list_concat(a, e) END)[1:6] AS terms FROM (SELECT o_orderkey AS no, {PLACE_SQL} AS l, {WORDS_SQL} || '，' || {KIND_SQL} || '，露筋' AS x FROM orders))""")
def components_and_terms(spark, d):
    x = _rows(spark, d).withColumn("x", F.concat_ws("，", "d", "k", F.lit("露筋")))
    return x.select("no", defects.component(F.col("l")).alias("component"), F.array_join(defects.disease_terms(F.col("x")), ",").alias("terms"))


HIST = ("2#墩裂缝有发展", "裂缝稳定", "渗水加剧", "无变化", "护栏K1+20破损", "露筋锈蚀扩大")
HNOW, HNOW_SQL = pick(HIST, "l_orderkey + l_linenumber")
HPLACE, HPLACE_SQL = pick(("上部结构", "下部结构", "桥面系", ""), "l_linenumber")


@query(f"""WITH {ROWS_SQL}, h AS (SELECT l_orderkey % 1500 AS doc, l_orderkey * 10 + l_linenumber AS hno, {HPLACE_SQL} AS place, {HNOW_SQL} || ' ' || CASE WHEN l_linenumber % 2 = 0 THEN '裂缝' ELSE '' END || ' ' AS told FROM lineitem),
t AS (SELECT doc, no, k, CASE {" ".join(f"WHEN {has('l', ws)} THEN '{c}'" for c, ws in V.COMPONENT_TERMS)} END AS comp, list_transform(list_distinct(regexp_extract_all(l, '{V.LOCATION_TOKEN}')), lambda p: p) AS ps, l || ' ' || k || ' ' || d AS x FROM rw),
w AS (SELECT *, list_reduce(list_prepend([]::VARCHAR[], list_transform(list_filter([{", ".join(f"'{t}'" for t in sorted((t for t in V.DEFECT_TERMS if not t.startswith("无")), key=lambda t: (-len(t), t)))}], lambda w: contains(x, w)), lambda w: [w])), lambda a, e: CASE WHEN len(list_filter(a, lambda k: contains(k, e[1]))) > 0 THEN a ELSE list_concat(a, e) END)[1:6] AS ws FROM t),
j AS (SELECT w.doc, no, hno, len(list_filter(ws, lambda v: contains(told, v))) AS hits, k <> '' AND contains(told, k) AS typed, comp IS NOT NULL AND contains(place, comp) AS ofc, len(list_filter(ps, lambda p: contains(replace(told, ' ', ''), p))) > 0 AS placed FROM w JOIN h ON h.doc = w.doc),
s AS (SELECT doc, no, hno, CASE WHEN ofc THEN 8 ELSE 0 END + CASE WHEN placed THEN 12 ELSE 0 END + 3 * hits + CASE WHEN typed THEN 5 ELSE 0 END AS score FROM j WHERE hits > 0 OR typed)
SELECT doc, no, hno, score::INT AS score FROM s QUALIFY row_number() OVER (PARTITION BY doc, no ORDER BY s.score DESC, hno) = 1""")
def best_history(spark, d):
    n = F.col("l_linenumber")
    h = load(spark, d, "lineitem").select((F.col("l_orderkey") % 1500).alias("doc"), (F.col("l_orderkey") * 10 + n).alias("hno"), HPLACE().alias("location"), F.lit("").alias("previous"), HNOW().alias("current"), F.when(n % 2 == 0, "裂缝").otherwise("").alias("development"))
    r = _rows(spark, d).withColumnsRenamed({"l": "location", "k": "defect_type", "d": "description"})
    return defects.best_history(r, h, ["doc"], "no", "hno")


@query(f"""WITH {ROWS_SQL}, f AS (SELECT doc, no, {FIGS("d")} AS fs, {KEY(f"regexp_replace(d, '{V.FIGURE}', '', 'g')")} AS core FROM rw), c AS (SELECT * FROM f WHERE no % 4 = 0), e AS (SELECT * FROM f WHERE no % 4 <> 0),
j AS (SELECT c.doc, c.no AS caption, e.no AS owner, CASE WHEN len(list_intersect(c.fs, e.fs)) > 0 THEN 0 WHEN c.no >= e.no THEN 1 ELSE 2 END AS tier, CASE WHEN len(list_intersect(c.fs, e.fs)) > 0 THEN -e.no WHEN c.no >= e.no THEN (c.no - e.no) * 1000000 + e.no ELSE e.no END AS o FROM c JOIN e ON c.doc = e.doc
WHERE len(list_intersect(c.fs, e.fs)) > 0 OR (length(e.core) >= 4 AND c.core <> '' AND (contains(c.core, e.core) OR contains(e.core, c.core)))) SELECT doc, caption, owner FROM j QUALIFY row_number() OVER (PARTITION BY doc, caption ORDER BY tier, o) = 1""")
def caption_owner(spark, d):
    r = _rows(spark, d).withColumnRenamed("d", "description")
    c = r.where("no % 4 = 0").select("doc", F.col("no").alias("caption"), F.col("no").alias("row"), "description")
    return defects.caption_owner(c, r.where("no % 4 <> 0").select("doc", F.col("no").alias("owner"), F.col("no").alias("row"), "description"), ["doc"], "caption", "row", "owner")


@query("""WITH t AS (SELECT o_custkey AS doc, o_orderkey AS no, o_orderkey % 5 = 0 AS routed, o_orderkey % 7 = 0 AS looks FROM orders), g AS (SELECT *, bool_or(routed AND looks) OVER (PARTITION BY doc) AS good, bool_or(looks) OVER (PARTITION BY doc) AS sm FROM t)
SELECT doc, no, NOT good AS used_fallback FROM g WHERE CASE WHEN good THEN routed AND looks WHEN sm THEN looks ELSE routed END""")
def located_tables(spark, d):
    n = F.col("o_orderkey")
    t = load(spark, d, "orders").select(F.col("o_custkey").alias("doc"), n.alias("no"), (n % 5 == 0).alias("routed"), (n % 7 == 0).alias("looks"))
    return defects.located_tables(t, ["doc"], "routed", "looks").select("doc", "no", "used_fallback")


ADV = ("建议及时修补主梁裂缝", "1、修补主梁裂缝", "对主梁裂缝进行灌浆封闭处理", "（2）主梁裂缝进行灌浆封闭处理并定期观测", "加强观测", "按《规范》修补主梁裂缝", "应加强观测。")
AWORD, AWORD_SQL = pick(ADV, "o_orderkey * 3 + o_custkey")
APLACE, APLACE_SQL = pick(("主梁", "", "全桥主梁", "桥墩"), "o_orderkey")
ACAT, ACAT_SQL = pick(("", "尽快维修", "预防性养护"), "o_orderkey")
BARE = lambda x: f"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '{V.ITEM_LABEL}', ''), '《[^》]+》', '', 'g'), '^(建议|应|需|须|及时|尽快|立即|对|对于|针对)', ''), '[，,。；;：:、（）()\\s]', '', 'g')"
RITEM = "{{'no': {no}, 'c': {c}, 'l': {l}, 'g': {g}, 'key': {key}}}"
RSAME = "(y.key = e[1].key OR (least(length(y.key), length(e[1].key)) >= 8 AND (contains(y.key, e[1].key) OR contains(e[1].key, y.key)))) AND (contains(y.l, e[1].l) OR contains(e[1].l, y.l))"
RKEEP = "length(y.c) >= length(e[1].c)"
GROWN = RITEM.format(no="y.no", c=f"CASE WHEN {RKEEP} THEN y.c ELSE e[1].c END", l="CASE WHEN length(e[1].l) > length(y.l) THEN e[1].l ELSE y.l END", g="CASE WHEN y.g = '' THEN e[1].g ELSE y.g END", key=f"CASE WHEN {RKEEP} THEN y.key ELSE e[1].key END")


@query(f"""WITH a AS (SELECT o_custkey AS doc, o_orderkey AS no, {AWORD_SQL} AS c, {APLACE_SQL} AS l, {ACAT_SQL} AS g FROM orders), k AS (SELECT doc, list([{RITEM.format(no="no", c="c", l="l", g="g", key=BARE("c"))}] ORDER BY no) AS items FROM a GROUP BY 1),
r AS (SELECT doc, list_reduce(items, lambda a, e: CASE WHEN len(list_filter(a, lambda y: {RSAME})) = 0 THEN list_concat(a, e) ELSE list_transform(a, lambda y: CASE WHEN y.no = list_filter(a, lambda y: {RSAME})[1].no THEN {GROWN} ELSE y END) END) AS kept FROM k), u AS (SELECT doc, unnest(kept) AS y FROM r) SELECT doc, y.no AS no, y.c AS content, y.l AS location, y.g AS category FROM u""")
def distinct_recommendations(spark, d):
    a = load(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("no"), AWORD().alias("content"), APLACE().alias("location"), ACAT().alias("category"))
    return defects.distinct_recommendations(a, ["doc"], ["no"], "content", "location", "category")


# ---- summary fields

LINES = ("桥梁名称：东湖大桥 桥梁编号：D-12", "报告日期=2021年3月5日；总体评分（分）为87.5，总体等级：B级", "检测日期 是2020年", "桥 名:西山桥。总体评分91.0", "设施名称：", "桥梁编号：", "没有标签的文字", "总体技术状况评分为92 总体等级A", "工程名称：甲；项目名称：乙路改造")
LINE, LINE_SQL = pick(LINES, "s_suppkey")
WANT = {0: [("bridge_name", "桥梁名称", "东湖大桥"), ("bridge_id", "桥梁编号", "D-12")], 1: [("report_date", "报告日期", "2021年3月5日"), ("overall_score", "总体评分", "87.5"), ("overall_grade", "总体等级", "B级")], 2: [("inspection_date", "检测日期", "2020年")], 3: [("bridge_name", "桥 名", "西山桥"), ("overall_score", "总体评分", "91.0")], 5: [("bridge_id", "桥梁编号", "")], 7: [("overall_score", "总体技术状况评分", "92"), ("overall_grade", "总体等级", "A")], 8: [("bridge_name", "工程名称", "甲"), ("bridge_name", "项目名称", "乙路改造")]}
WANT_SQL = " UNION ALL ".join(f"SELECT s_suppkey, {i} AS place, '{f}' AS field, '{n}' AS label, '{v}' AS value FROM supplier WHERE s_suppkey % 9 = {k}" for k, xs in WANT.items() for i, (f, n, v) in enumerate(xs))


@query(WANT_SQL)
def labelled_values(spark, d):
    return summary.labelled_values(load(spark, d, "supplier").select("s_suppkey", LINE().alias("t")), ["s_suppkey"], "t")


LABELS = ("桥梁名称", "桥 梁 编 号", "总体评分（分）", "桥名:", "备注", "桥梁id", "检测 时间 (年)")
LABEL, LABEL_SQL = pick(LABELS, "s_suppkey")


@query(f"SELECT s_suppkey, CASE s_suppkey % 7 WHEN 0 THEN 'bridge_name' WHEN 1 THEN 'bridge_id' WHEN 2 THEN 'overall_score' WHEN 3 THEN 'bridge_name' WHEN 5 THEN 'bridge_id' WHEN 6 THEN 'inspection_date' END AS field FROM supplier")
def field_of_label(spark, d):
    return load(spark, d, "supplier").select("s_suppkey", summary.field_of_label(LABEL()).alias("field"))


FIELD, FIELD_SQL = pick(("bridge_name", "deck_score", "overall_score", "deck_grade", "report_date"), "l_linenumber + l_partkey")
VKIND, VKIND_SQL = pick(("table", "bci", "paired_score_grade", "paragraph"), "l_suppkey")
VALUE, VALUE_SQL = pick(("87.0", "87", "东湖大桥", "", "B", "87.00", "检测项目大桥"), "l_partkey * 3 + l_suppkey")
SCOPE, SCOPE_SQL = pick(("", "主桥", "引桥", ""), "l_partkey")
BASE, SCORE, GRADE = {"table": 400, "bci": 300, "paragraph": 100, "paired_score_grade": 350}, {"table": 650, "bci": 500}, {"bci": 500, "table": 400}
TO_SQL = lambda t: "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in t.items()) + " END"
CAND_SQL = f"""cd AS (SELECT l_orderkey % 1000 AS doc, {FIELD_SQL} AS field, {VALUE_SQL} AS value, {VKIND_SQL} AS kind, l_linenumber % 3 AS anchor, {SCOPE_SQL} AS scope, min(l_orderkey * 10 + l_linenumber) AS seq FROM lineitem GROUP BY ALL),
pc AS (SELECT *, coalesce(CASE WHEN field = 'deck_score' THEN {TO_SQL(SCORE)} WHEN field IN ('deck_grade', 'overall_score') THEN {TO_SQL(GRADE)} END, {TO_SQL(BASE)}, 0) AS priority FROM cd WHERE NOT (field IN ('deck_score', 'deck_grade') AND kind = 'paired_score_grade'))"""


def _cands(spark, d):
    n = F.col("l_linenumber")
    c = load(spark, d, "lineitem").select((F.col("l_orderkey") % 1000).alias("doc"), FIELD().alias("field"), VALUE().alias("value"), VKIND().alias("kind"), (n % 3).alias("anchor"), SCOPE().alias("scope"), (F.col("l_orderkey") * 10 + n).alias("seq"))
    return summary.with_priority(summary.producible(summary.distinct_candidates(c, ["doc"], "seq")), BASE, SCORE, GRADE)


@query(f"WITH {CAND_SQL} SELECT doc, field, value, kind, anchor, scope, seq, priority::INT AS priority FROM pc")
def summary_candidates(spark, d):
    return _cands(spark, d)


@query(f"""WITH {CAND_SQL}, q AS (SELECT *, trim(value) = '' AS blank, CASE WHEN field = 'bridge_name' THEN -priority ELSE 0 END AS n0, CASE WHEN field = 'bridge_name' THEN {" + ".join(f"contains(value, '{w}')::INT" for w in V.NAME_NOISE)} ELSE 0 END AS n1, CASE WHEN field = 'bridge_name' THEN length(value) ELSE 0 END AS n2, CASE WHEN ends_with(field, '_score') AND regexp_matches(value, '^[0-9.]+$') THEN '87' END AS num FROM pc WHERE NOT (field = 'overall_score' AND scope <> '')),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY doc, field ORDER BY blank, n0, n1, n2, priority DESC, seq, kind, value) = 1),
s AS (SELECT doc, field, num, value AS spelled FROM q WHERE num IS NOT NULL AND contains(value, '.') QUALIFY row_number() OVER (PARTITION BY doc, field, num ORDER BY kind <> 'bci', blank, n0, n1, n2, priority DESC, seq, kind, value) = 1)
SELECT b.doc, b.field, coalesce(spelled, b.value) AS value, b.kind FROM b LEFT JOIN s ON s.doc = b.doc AND s.field = b.field AND s.num = b.num""")
def selected_values(spark, d):
    return summary.selected(_cands(spark, d), ["doc"], "seq")


@query(f"""WITH {CAND_SQL}, t AS (SELECT doc, field, count(DISTINCT value) AS n FROM pc WHERE trim(value) <> '' GROUP BY 1, 2) SELECT doc, field, 'conflicting_candidates' AS code FROM t WHERE n > 1
UNION ALL SELECT doc, f, 'missing_value' FROM (SELECT DISTINCT l_orderkey % 1000 AS doc FROM lineitem), (VALUES ('bridge_name'), ('report_date'), ('deck_score')) v(f) WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc = l_orderkey % 1000 AND t.field = f)""".replace("WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc = l_orderkey % 1000 AND t.field = f)", "x WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc = z.doc AND t.field = v.f)").replace("FROM lineitem), (VALUES", "FROM lineitem) z, (VALUES").replace("v(f) x WHERE", "v(f) WHERE"))
def summary_flags(spark, d):
    docs = load(spark, d, "lineitem").select((F.col("l_orderkey") % 1000).alias("doc")).distinct()
    return summary.quality_flags(_cands(spark, d), docs, ["doc"], ["bridge_name", "report_date", "deck_score"])


@query("""WITH x AS (SELECT o_custkey AS doc, o_orderkey AS no, CASE o_orderkey % 2 WHEN 0 THEN 'previous_overall_score' ELSE 'overall_score' END AS field, CASE o_orderkey % 3 WHEN 0 THEN '' ELSE o_orderstatus END AS value FROM orders), a AS (SELECT DISTINCT o_custkey AS doc FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 4 = 0)
SELECT no, CASE WHEN s THEN '' ELSE value END AS value, s AS suppressed FROM (SELECT *, field = 'previous_overall_score' AND value <> '' AND NOT EXISTS (SELECT 1 FROM a WHERE a.doc = x.doc) AS s FROM x)""")
def anchored_history(spark, d):
    n = F.col("o_orderkey")
    o = load(spark, d, "orders")
    x = o.select(F.col("o_custkey").alias("doc"), n.alias("no"), F.when(n % 2 == 0, "previous_overall_score").otherwise("overall_score").alias("field"), F.when(n % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("value"))
    a = o.where("o_orderpriority = '1-URGENT' AND o_orderkey % 4 = 0").select(F.col("o_custkey").alias("doc"))
    return summary.anchored_history(x, a, ["doc"], "field", "value").select("no", "value", "suppressed")


@query("""WITH x AS (SELECT o_custkey AS doc, year(o_orderdate) AS y, o_orderkey AS no, CASE o_orderkey % 3 WHEN 0 THEN '主桥' WHEN 1 THEN '引桥' END AS scope, o_orderstatus AS v FROM orders), f AS (SELECT * FROM x WHERE y < 1997 AND scope IS NOT NULL),
g AS (SELECT doc, y, arg_max(v, no) FILTER (scope = '主桥') AS a, arg_max(v, no) FILTER (scope = '引桥') AS b FROM f GROUP BY 1, 2) SELECT doc, y::INT AS y, '主桥' || a || '；引桥' || b AS v FROM g WHERE a IS NOT NULL AND b IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc ORDER BY y DESC) = 1""")
def latest_scoped(spark, d):
    n = F.col("o_orderkey")
    x = load(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.year("o_orderdate").alias("y"), n.alias("no"), F.when(n % 3 == 0, "主桥").when(n % 3 == 1, "引桥").alias("scope"), F.col("o_orderstatus").alias("v"))
    return summary.latest_scoped(x, ["doc"], "y", ["no"], F.lit(1997), "scope", ("主桥", "引桥"), "v")
