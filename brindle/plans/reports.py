"""Queries of the report rules, over records made from the driver's tables, with their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import reports as R
from brindle.functions import vocabulary as V
from brindle.operators import routing
from brindle.plans.catalogue import load, query


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def pick(words, key: str):
    """One of the words, by a whole number: as a function that makes a Spark column, and as SQL."""
    return lambda: F.get(F.array(*[F.lit(w) for w in words]), F.expr(f"cast(({key}) % {len(words)} as int)")), f"[{quoted(words)}][({key}) % {len(words)} + 1]"


def has(x: str, words) -> str:
    """SQL for whether a text holds one of the words."""
    return f"regexp_matches({x}, '{'|'.join(words)}')"


NUMBERING = V.NUMBERING.replace("'", "''")
COMPACT = lambda x: f"regexp_replace({x}, '\\s', '', 'g')"
DISPLAY = lambda x: f"trim(regexp_replace({x}, '[\\s\u3000]+', ' ', 'g'))"
TITLE_KEY = lambda x: f"regexp_replace(translate({COMPACT(x)}, '．（）：', '.():'), '{NUMBERING}', '')"
EDGE = R.EDGE

# ---- sections

HEADS = (
    "第一章 概述", "2.1 技术状况评分", "（三）病害明细表", "3.2.1 病害成因分析", "检测结论：", "四、处理建议", "5.4 安全性评估", "6 结论与建议", "普通段落，没有标题", "序号 病害部位 病害类型",
    "总体评分 等级 分数", "养护建议", "本次检测的桥梁位于城区", "处置措施", "桥梁概况部分", "建议", "评分章节", "建议类别 建议内容", "安全评估表", "病害\n结论",
)
BODY, BODY_SQL = pick(HEADS, "o_orderkey * 7 + o_custkey * 3")
STYLE, STYLE_SQL = pick(("Normal", "heading 2", "标题1", "Title", "正文", "Heading_3"), "o_orderkey * 5 + o_custkey")
BLOCKS_SQL = f"""b0 AS (SELECT o_custkey AS doc, o_orderkey AS pos, {BODY_SQL} AS text, o_orderkey % 6 = 4 AS is_table, CASE o_orderkey % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 0 END AS lv, {STYLE_SQL} AS style FROM orders),
b1 AS (SELECT *, CASE WHEN NOT is_table THEN coalesce(CASE WHEN lv IS NOT NULL THEN greatest(lv, 1) END, CASE style WHEN 'heading 2' THEN 2 WHEN '标题1' THEN 1 WHEN 'Title' THEN 1 WHEN 'Heading_3' THEN 3 END) END AS level, {TITLE_KEY("text")} AS k, {COMPACT("text")} AS c FROM b0),
kw AS (SELECT * FROM (VALUES {", ".join(f"({n}, '{c}', '{w}')" for n, (c, ws) in enumerate(V.TITLES) for w in ws)}) v(ord, cat, word)),
tc AS (SELECT k, arg_max(cat, length(word) * 100 - ord) AS tcat FROM (SELECT DISTINCT k FROM b1) JOIN kw ON contains(k, word) AND NOT (cat = 'defect_table' AND {has("k", V.CAUSE_WORDS)}) GROUP BY 1),
b2 AS (SELECT b1.*, tcat, CASE WHEN is_table THEN CASE WHEN {has("c", V.TABLE_DEFECTS)} THEN 'defect_table' WHEN {has("c", V.TABLE_SCORES)} AND {has("c", V.TABLE_SCORE_UNITS)} THEN 'scoring' WHEN {has("c", V.TABLE_RECOMMENDATIONS)} THEN 'recommendations'
    WHEN {has("c", V.TABLE_TREATMENTS)} THEN 'treatment_recommendations' WHEN {has("c", V.TABLE_SAFETY)} THEN 'safety_assessment' WHEN {has("c", V.TABLE_CONCLUSIONS)} THEN 'inspection_conclusion' WHEN NOT contains(text, chr(10)) THEN tcat END
  WHEN level IS NOT NULL OR (NOT contains(text, chr(10)) AND (EXISTS (SELECT 1 FROM kw WHERE ends_with(rtrim(b1.k, '：:。.;；，,、'), word)) OR (regexp_matches(rtrim(b1.k, '：:。.;；，,、'), '(章节|部分)$') AND tcat IS NOT NULL))) THEN tcat END AS category FROM b1 LEFT JOIN tc USING (k)),
r0 AS (SELECT s.doc, s.category, s.pos AS start, s.is_table, s.text, CASE WHEN s.is_table THEN s.pos + 1 ELSE coalesce((SELECT min(e.pos) FROM b2 e WHERE e.doc = s.doc AND e.pos > s.pos AND CASE WHEN e.level IS NOT NULL THEN s.level IS NULL OR e.level <= s.level ELSE NOT e.is_table AND e.category IS NOT NULL END),
    (SELECT max(e.pos) + 1 FROM b2 e WHERE e.doc = s.doc)) END AS "end" FROM b2 s WHERE category IS NOT NULL),
r AS (SELECT * FROM r0 t WHERE NOT is_table OR NOT EXISTS (SELECT 1 FROM r0 p WHERE p.doc = t.doc AND p.category = t.category AND NOT p.is_table AND p.start < t.start AND p."end" > t.start))"""


def _blocks(spark, d):
    lv = F.expr("CASE o_orderkey % 9 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 0 END")
    x = load(spark, d, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("pos"), BODY().alias("text"), (F.col("o_orderkey") % 6 == 4).alias("is_table"), lv.alias("heading_level"), STYLE().alias("style"))
    return routing.candidates(x)


@query(f"WITH {BLOCKS_SQL} SELECT doc, pos, level::INT AS level, category FROM b2")
def section_candidates(spark, d):
    return _blocks(spark, d).select("doc", "pos", "level", "category")


@query(f"""WITH {BLOCKS_SQL} SELECT doc, category, start, "end", is_table, NOT is_table AND regexp_matches(trim({TITLE_KEY("text")}, '：:。.;；，,、'), '({"|".join(V.CONTAINER_TITLES)})$') AS is_container FROM r""")
def route_sections(spark, d):
    return routing.route_sections(_blocks(spark, d), ["doc"], "pos")


@query(f"""WITH {BLOCKS_SQL} SELECT b.doc, b.pos, coalesce((SELECT string_agg(DISTINCT r.category, ',' ORDER BY r.category) FROM r WHERE r.doc = b.doc AND r.start <= b.pos AND r."end" > b.pos), '') AS categories FROM b2 b""")
def block_categories(spark, d):
    b = _blocks(spark, d)
    return routing.block_categories(b, routing.route_sections(b, ["doc"], "pos"), ["doc"], "pos").select("doc", "pos", F.array_join("categories", ",").alias("categories"))


@query(f"""WITH {BLOCKS_SQL} SELECT b.doc, string_agg(b.text, chr(10) ORDER BY b.pos) AS text FROM b2 b WHERE NOT b.is_table AND b.category IS NULL AND EXISTS (SELECT 1 FROM r WHERE r.category = 'inspection_conclusion' AND r.doc = b.doc AND r.start <= b.pos AND r."end" > b.pos) GROUP BY 1""")
def section_text(spark, d):
    b = _blocks(spark, d)
    return routing.route_text(routing.block_categories(b, routing.route_sections(b, ["doc"], "pos"), ["doc"], "pos"), ["doc"], "pos", "inspection_conclusion")


@query(f"""WITH {BLOCKS_SQL} SELECT doc, pos, coalesce(pos < (SELECT min(f.pos) FROM b2 f WHERE f.doc = b2.doc AND (f.level IS NOT NULL OR f.category IS NOT NULL)), true) AS is_cover FROM b2""")
def cover_zone(spark, d):
    return routing.cover(_blocks(spark, d), ["doc"], "pos").select("doc", "pos", "is_cover")


@query(f"""WITH {BLOCKS_SQL}, f AS (SELECT doc, min(pos) AS a, arg_min(level, pos) AS lv FROM b2 WHERE level IS NOT NULL AND regexp_matches(k, '检测结论|处置') GROUP BY 1),
t AS (SELECT f.doc, a, lv, (SELECT min(e.pos) FROM b2 e WHERE e.doc = f.doc AND e.pos > a AND e.level <= f.lv) AS z FROM f) SELECT b2.doc, pos, coalesce(pos >= a AND (z IS NULL OR pos < z), false) AS is_earlier FROM b2 LEFT JOIN t ON t.doc = b2.doc""")
def earlier_period(spark, d):
    return routing.earlier_period(_blocks(spark, d), ["doc"], "pos", "检测结论|处置").select("doc", "pos", "is_earlier")


@query(f"""WITH {BLOCKS_SQL}, s AS (SELECT doc, max(pos) AS a FROM b0 WHERE contains(text, '病害') GROUP BY 1),
u AS (SELECT b0.doc, pos, a, CASE WHEN pos = a THEN regexp_extract(text, '(?s)^.*病害(.*)$', 1) ELSE text END AS t FROM b0 JOIN s ON s.doc = b0.doc AND pos >= a),
e AS (SELECT doc, min(pos) AS z FROM u WHERE contains(t, '建议') GROUP BY 1)
SELECT doc, string_agg(c, chr(10) ORDER BY pos) AS text FROM (SELECT u.doc, pos, CASE WHEN pos = z THEN split_part(t, '建议', 1) ELSE t END AS c FROM u LEFT JOIN e ON e.doc = u.doc WHERE z IS NULL OR pos <= z) WHERE c <> '' GROUP BY 1""")
def text_window(spark, d):
    return routing.text_window(_blocks(spark, d), ["doc"], "pos", "text", "病害", "建议")


@query(f"""WITH {BLOCKS_SQL} SELECT doc, pos, regexp_matches(t, '({"|".join(V.CONTAINER_TITLES)})$') AS holds, NOT regexp_matches(t, '({"|".join(V.CONTAINER_TITLES)})$') AND regexp_matches(t, '({"|".join(V.LEAF_TITLES)})$') AS leaf FROM (SELECT doc, pos, trim(k, '：:。.;；，,、') AS t FROM b1)""")
def heading_kinds(spark, d):
    return _blocks(spark, d).select("doc", "pos", routing.is_container(F.col("text")).alias("holds"), routing.is_leaf(F.col("text")).alias("leaf"))


# ---- texts

SAID = (
    "桥梁总体技术状况为B级，满足正常使用要求。", "主梁存在多条裂缝，影响结构耐久性。", "桥面铺装破损，建议及时修补。", "建议加强日常养护。", "由于雨水长期渗入，支座锈蚀。", "混凝土强度检测结果表明合格。", "2019年检测时已维修伸缩缝。",
    "栏杆缺失,危及行人安全；", "承载能力满足要求，不影响结构安全。", "桥台沉降；", "排水孔堵塞，及时清理。", "整体外观良好。", "裂缝宽度:0.2mm，会降低承载力！", "车辆荷载引起的病害有待观测，应及时处理。", "无明显异常。", "综合评定安全性评估为二级。",
    "渗水泛碱降低耐久性，影响行车安全。", "露筋", "检测依据见附录。", "不存在既有病害扩展情况。",
)
NOTE = [pick(SAID, f"o_orderkey * {k + 3} + o_custkey * {k} + {k * 5}") for k in range(7)]
NOTE_SQL = " || ".join(s for _, s in NOTE)
SENTENCES = lambda x: f"list_filter(list_transform(regexp_extract_all({DISPLAY(x)}, '[^。；;！？!?]*[。；;！？!?]|[^。；;！？!?]+$'), lambda s: trim(s, '{EDGE}')), lambda s: s <> '')"


def distinct_sql(xs: str) -> str:
    return f"list_transform(list_filter(list_zip({xs}, range(len({xs}))), lambda p: list_position({xs}, p[1]) = p[2] + 1), lambda p: p[1])"


def budget_sql(xs: str, cap: int, total: int, least: int, most: int, glue: int = 1, distinct: bool = True) -> str:
    """The fold over items as a list_reduce whose accumulator has the items' type."""
    cell = "{{'out': {o}, 'used': {u}, 'done': {d}, 'x': {x}}}"
    first = cell.format(o="[]::VARCHAR[]", u="0::BIGINT", d="false", x="''")
    rest = f"list_transform({xs}, lambda v: {cell.format(o='[]::VARCHAR[]', u='0::BIGINT', d='false', x='v')})"
    tail = lambda x: f"rtrim({x}, '，,；; ')"
    whole = tail(f"left(e.x, {cap})")
    sep = f"(CASE WHEN len(a.out) > 0 THEN {glue} ELSE 0 END)"
    room = f"({total} - a.used - {sep})"
    over = f"(length({whole}) > {room})"
    stop = f"(a.done OR ({over} AND {room} < {least}))"
    kept = f"(CASE WHEN {over} THEN {tail(f'left({whole}, greatest({room}, 0))')} ELSE {whole} END)"
    takes = f"(NOT {stop} AND {kept} <> ''" + (f" AND NOT list_contains(a.out, {kept}))" if distinct else ")")
    out = f"(CASE WHEN {takes} THEN list_append(a.out, {kept}) ELSE a.out END)"
    used = f"(a.used + CASE WHEN {takes} THEN length({kept}) + {sep} ELSE 0 END)"
    done = f"({stop} OR len({out}) >= {most}" + (f" OR {used} >= {total})" if glue else ")")
    return f"list_reduce(list_prepend({first}, {rest}), lambda a, e: {cell.format(o=out, u=used, d=done, x='e.x')}).out"


def _notes(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_custkey", F.concat(*[c() for c, _ in NOTE]).alias("note"))


NOTES_SQL = f"n AS (SELECT o_orderkey, o_custkey, {NOTE_SQL} AS note FROM orders), s0 AS (SELECT *, {SENTENCES('note')} AS s1 FROM n), s AS (SELECT *, {distinct_sql('s1')} AS ss FROM s0)"
BEFORE = lambda x: f"(CASE WHEN regexp_matches({x}, '{V.ACTION_HEAD}') THEN '' ELSE trim(regexp_replace({x}, '(?s){V.ACTION_TAIL}.*$', ''), '{EDGE}') END)"


@query(f"""WITH {NOTES_SQL}, h AS (SELECT o_orderkey, list_filter(list_transform(list_filter(ss, lambda x: NOT {has("x", V.NOISE)}), lambda x: {BEFORE("x")}), lambda x: x <> '' AND {has("x", V.OVERALL + V.DEFECTS)}) AS hs FROM s),
m AS (SELECT o_orderkey, list_transform(hs, lambda x: translate(x, ',:', '，：')) AS ms FROM h) SELECT o_orderkey, array_to_string({budget_sql("ms", 180, 250, 24, 4)}, '；') AS conclusion FROM m""")
def overall_conclusion(spark, d):
    return _notes(spark, d).select("o_orderkey", R.overall_conclusion(F.col("note")).alias("conclusion"))


@query(f"""WITH {NOTES_SQL}, h AS (SELECT o_orderkey, list_filter(ss, lambda x: NOT {has("x", V.NOISE + V.ACTIONS + V.MADE_UP)} AND NOT regexp_matches(x, '{V.PAST_WORK}') AND {has("x", V.DEFECTS)} AND {has("x", V.CONSEQUENCES)}) AS hs FROM s),
g AS (SELECT o_orderkey, list_filter(list_transform(list_filter(ss, lambda x: NOT {has("x", V.NOISE + V.MADE_UP)} AND NOT regexp_matches(x, '{V.PAST_WORK}')), lambda x: {BEFORE("x")}), lambda x: x <> '' AND {has("x", V.DEFECTS)} AND NOT ({has("x", V.CAUSES)} AND NOT ({has("x", V.STRONG_CONSEQUENCES)} OR regexp_matches(x, '{V.IMPACT}')))) AS gs FROM s),
p AS (SELECT o_orderkey, list_transform(gs, lambda x: rtrim(left(translate(x, ',:', '，：'), 120), '，,；; ')) AS f0, list_transform(list_filter(gs, lambda x: {has("x", V.SPECIFIC_DEFECTS)} AND ({has("x", V.STRONG_CONSEQUENCES)} OR regexp_matches(x, '{V.IMPACT}'))), lambda x: rtrim(left(translate(x, ',:', '，：'), 120), '，,；; ')) AS t0 FROM g),
q AS (SELECT o_orderkey, CASE WHEN len(t0) > 0 THEN t0 ELSE f0 END AS c0 FROM p), c AS (SELECT o_orderkey, {distinct_sql("c0")} AS cs FROM q)
SELECT o_orderkey, array_to_string({budget_sql("hs", 120, 200, 24, 3)}, '；') AS strict_points, array_to_string({budget_sql("cs", 120, 200, 24, 3)}, '；') AS public_points FROM h JOIN c USING (o_orderkey)""")
def risk_points(spark, d):
    return _notes(spark, d).select("o_orderkey", R.risk_points(F.col("note"), False).alias("strict_points"), R.risk_points(F.col("note")).alias("public_points"))


LISTED = lambda extra: f"list_filter(list_transform(vs, lambda v: trim({DISPLAY('v')}, '{EDGE}')), lambda x: x <> '' AND NOT {has('x', V.MADE_UP)}{extra})"


@query(f"""WITH n AS (SELECT o_orderkey, [{", ".join(s for _, s in NOTE)}] AS vs FROM orders), l AS (SELECT o_orderkey, {LISTED("")} AS dl, {LISTED(f" AND regexp_matches(x, '{V.CAUSE_PHRASE}')")} AS cl, {LISTED(f" AND NOT {has('x', V.ACTIONS)} AND {has('x', V.CONSEQUENCES)}")} AS sl FROM n)
SELECT o_orderkey, array_to_string(list_transform({budget_sql("dl", 520, 900, 30, 4, 0, False)}, lambda x: x || '。'), '|') AS detailed, array_to_string(list_transform(cl[1:4], lambda x: x || '。'), '|') AS causes, array_to_string(list_transform(sl[1:4], lambda x: x || '。'), '|') AS safety FROM l""")
def statement_lists(spark, d):
    x = load(spark, d, "orders").select("o_orderkey", F.array(*[c() for c, _ in NOTE]).alias("vs"))
    return x.select("o_orderkey", *[F.array_join(R.text_list(F.col("vs"), k), "|").alias(n) for n, k in (("detailed", "detailed"), ("causes", "cause"), ("safety", "safety"))])


TOPIC_SQL = "CASE " + " ".join(f"WHEN {has('x', ws)} THEN '{t}'" for t, ws in V.SAFETY_TOPICS) + " ELSE '结构安全' END"
RANK_SQL = "-(" + " + ".join(f"CASE WHEN {has('x', ws)} THEN {n} ELSE 0 END" for n, ws in V.SAFETY_RANK) + ")"


@query(f"""WITH {NOTES_SQL}, u AS (SELECT o_custkey, o_orderkey, unnest(ss) AS x, unnest(range(len(ss))) AS i FROM s), c AS (SELECT *, {TOPIC_SQL} AS topic, {RANK_SQL} AS rank, length({COMPACT("x")}) AS n, {has("x", V.REASSURING)} AS calm FROM u),
t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY o_custkey, topic ORDER BY rank, n, calm DESC, o_orderkey, i) = 1)
SELECT o_custkey, topic, x AS statement, rank::INT AS rank FROM t QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY rank, n, topic) <= 3""")
def safety_topics(spark, d):
    """The best statement of each topic, a reassuring one where two are equally good; three topics a record."""
    from brindle.operators import ranking

    x = _notes(spark, d).select("o_custkey", "o_orderkey", F.posexplode(R.sentences(F.col("note"))).alias("i", "x"))
    return ranking.topic_statements(x, ["o_custkey"], "x", ["o_orderkey", "i"], R.safety_topic(F.col("x")), R.safety_rank(F.col("x")), R.contains_any(R.compact(F.col("x")), V.REASSURING), 3).select("o_custkey", "topic", F.col("x").alias("statement"), F.col("rank.rank").alias("rank"))


TRENDS = ("上部结构:新增病害:裂缝2条,渗水1处;", "下部结构：新增病害：无;桥面系:无明显变化", "总体:稳定;总体:稳定", "无", "局部加重,需关注；；", "桥面系：", "整体:新增病害:新增坑槽", " 暂无 ")
TREND, TREND_SQL = pick(TRENDS, "o_orderkey")


@query(f"""WITH t AS (SELECT o_orderkey, trim({DISPLAY(TREND_SQL)}, '{EDGE}') AS w FROM orders), p AS (SELECT o_orderkey, w, list_filter(list_transform(regexp_split_to_array(w, '[；;]+'), lambda x: replace(trim(x, '{EDGE}'), ':', '：')), lambda x: x <> '') AS ps FROM t),
c AS (SELECT o_orderkey, w, list_transform(ps, lambda x: CASE WHEN regexp_matches(x, '^({"|".join(V.COMPONENTS)})\\s*：') THEN regexp_extract(x, '^([^：]*?)\\s*：', 1) || CASE WHEN trim(regexp_extract(x, '：\\s*(.*)$', 1), '：{EDGE}') = '' THEN '' ELSE '：' || replace(CASE WHEN regexp_matches(x, '^[^：]*：\\s*新增病害') THEN
  CASE WHEN starts_with(trim(regexp_extract(x, '新增病害\\s*：?\\s*(.*)$', 1), '：{EDGE}'), '无') THEN '无新增病害' || substr(trim(regexp_extract(x, '新增病害\\s*：?\\s*(.*)$', 1), '：{EDGE}'), 2) ELSE '新增' || regexp_replace(trim(regexp_extract(x, '新增病害\\s*：?\\s*(.*)$', 1), '：{EDGE}'), '^新增', '') END
  ELSE trim(regexp_extract(x, '：\\s*(.*)$', 1), '：{EDGE}') END, ',', '、') END ELSE replace(x, ',', '、') END) AS cs FROM p)
SELECT o_orderkey, CASE WHEN w IN ('', '无', '暂无', '不适用') OR len(cs) = 0 THEN w ELSE array_to_string({distinct_sql("cs")}, '；') END AS trend FROM c""")
def trend_clauses(spark, d):
    return load(spark, d, "orders").select("o_orderkey", R.trend(TREND()).alias("trend"))


SHOWN = ("主梁底板 裂缝L=2m（单位：mm）", "支座锈蚀，见照片3-12", "伸缩缝堵塞； 图5、图6", "1、裂缝/渗水", "（2）露筋,锈蚀＋剥落", "③ 清理排水孔", "十二、更换支座", "墩身\u3000蜂窝  麻面。", "裂缝，详见图 3.2和图3.3。", "护栏缺失 见附图二")
CELL, CELL_SQL = pick(SHOWN, "p_partkey")
FIG = rf"[，,；;。\s]+(详见|参见|见)?\s*{V.FIGURE_WORD}\s*{V.FIGURE_NO}(\s*[、,，及和至~～\-]\s*({V.FIGURE_WORD}\s*)?{V.FIGURE_NO})*\s*[）)]?\s*[。．.]?$"


@query(f"""WITH c AS (SELECT p_partkey, {CELL_SQL} AS x FROM part), d AS (SELECT p_partkey, {DISPLAY("x")} AS x FROM c)
SELECT p_partkey, trim(regexp_replace(trim(regexp_replace(x, '{V.UNIT_NOTE}', ''), '{EDGE}'), '{FIG}', ''), '{EDGE}') AS description, trim(regexp_replace(x, '{V.UNIT_NOTE}', ''), '{EDGE}') AS with_figures,
trim(regexp_replace(regexp_replace(x, '\\s*[,，/＋+]\\s*', '、', 'g'), '、+', '、', 'g'), '、{EDGE}') AS kinds, trim(regexp_replace(x, '{V.ITEM_LABEL}', '')) AS item FROM d""")
def display_forms(spark, d):
    x = load(spark, d, "part").select("p_partkey", CELL().alias("x"))
    return x.select("p_partkey", R.description(F.col("x")).alias("description"), R.description(F.col("x"), F.lit(True)).alias("with_figures"), R.defect_type(F.col("x")).alias("kinds"), R.item_text(F.col("x")).alias("item"))


# ---- names, paths, grades

FILES = ("养护一所-东湖大桥（原B现C）检测报告.docx", "./a/b/南门 人行天桥报告.docx", "K12+300匝道桥无对比年度的信息提取报告", "西山隧道-信息提取报告报告.doc", "b/南门 人行天桥报告.docx", "Lake-Side_Bridge 检测报告", "北站人行地通道", "二号涵洞（现三类）.docx", "x/y/z")
FILE, FILE_SQL = pick(FILES, "s_suppkey")


@query(f"""WITH k AS (SELECT s_suppkey, trim(regexp_replace({FILE_SQL}, '[\\s\u00a0]+', ' ', 'g')) AS f FROM supplier), e AS (SELECT *, regexp_replace(f, '([ _．。-]*({"|".join(V.LABEL_ENDINGS)}))+$', '') AS g FROM k)
SELECT s_suppkey, regexp_replace(lower(CASE WHEN g <> f THEN trim(g, ' -_．。') ELSE f END), '[^0-9a-z\u4e00-\u9fff]+', '', 'g') AS key FROM e""")
def file_name_key(spark, d):
    return load(spark, d, "supplier").select("s_suppkey", R.name_key(FILE()).alias("key"))


@query(f"""WITH c AS (SELECT s_suppkey, regexp_replace(trim({FILE_SQL}), '^(\\./)+', '') AS p FROM supplier), n AS (SELECT *, string_split(p, '/') AS ps FROM c), m AS (SELECT *, ps[-1] AS name, CASE WHEN length(ps[-1]) > 1 THEN regexp_replace(ps[-1], '(.)\\.[^.]*$', '\\1') ELSE ps[-1] END AS stem FROM n)
SELECT s_suppkey, array_to_string(list_transform(list_filter(list_zip(l, range(len(l))), lambda q: list_position(l, q[1]) = q[2] + 1), lambda q: q[1]), '|') AS names FROM (SELECT s_suppkey, [p, name, stem, CASE WHEN len(ps) > 1 THEN ps[-2] || '/' || stem ELSE stem END] AS l FROM m)""")
def file_aliases(spark, d):
    return load(spark, d, "supplier").select("s_suppkey", F.array_join(R.aliases(FILE()), "|").alias("names"))


@query(f"""SELECT s_suppkey, CASE {" ".join(f"WHEN ends_with(x, '{r}') THEN '{r}/{t}/{n}'" for r, t, n in V.FACILITIES)} ELSE '//' END AS facility FROM (SELECT s_suppkey, {COMPACT(f"regexp_replace({FILE_SQL}, '(检测|信息提取)?报告.*$', '')")} AS x FROM supplier)""")
def facility_semantics(spark, d):
    f = R.facility(F.regexp_replace(FILE(), "(检测|信息提取)?报告.*$", ""))
    return load(spark, d, "supplier").select("s_suppkey", F.concat_ws("/", f["raw_type"], f["type"], f["noun"]).alias("facility"))


@query(f"""WITH f AS (SELECT s_suppkey, regexp_extract_all({FILE_SQL}, '原\\s*([A-Ea-e一二三四五六])', 1)[-1] AS p, regexp_extract_all({FILE_SQL}, '现\\s*([A-Ea-e一二三四五六])', 1)[-1] AS c FROM supplier)
SELECT s_suppkey, upper(p) || CASE WHEN regexp_matches(upper(p), '^[A-E]$') THEN '级' ELSE '类' END AS previous, upper(c) || CASE WHEN regexp_matches(upper(c), '^[A-E]$') THEN '级' ELSE '类' END AS current FROM f""")
def filename_grades(spark, d):
    g = R.filename_grades(FILE())
    return load(spark, d, "supplier").select("s_suppkey", g["previous"].alias("previous"), g["current"].alias("current"))


VALUES = ("087.060分", " B 级", "二类", "－", "12", "b级", "裂缝, 渗水。", "+3.", "－5")
VALUE, VALUE_SQL = pick(VALUES, "c_custkey")
FIELD, FIELD_SQL = pick(("overall_score", "overall_grade", "defect_type"), "c_custkey * 2 + c_nationkey")


@query(f"""WITH v AS (SELECT c_custkey, {FIELD_SQL} AS f, {COMPACT(VALUE_SQL)} AS x FROM customer)
SELECT c_custkey, CASE WHEN ends_with(f, '_score') THEN CASE regexp_replace(x, '分$', '') WHEN '087.060' THEN '87.06' WHEN '+3.' THEN '3' ELSE regexp_replace(x, '分$', '') END WHEN ends_with(f, '_grade') THEN upper(regexp_replace(x, '[级类]$', '')) ELSE regexp_replace(lower(x), '[^\\p{{L}}\\p{{N}}]+', '', 'g') END AS value FROM v""")
def canonical_values(spark, d):
    return load(spark, d, "customer").select("c_custkey", R.canonical_value(FIELD(), VALUE()).alias("value"))


GRADE, GRADE_SQL = pick(("B级", "三类", "", "d 级"), "c_custkey")
CSCORE = "CAST(c_acctbal AS DECIMAL(18,2)) / 100"


@query(f"""SELECT c_custkey, CASE WHEN ends_with({COMPACT(GRADE_SQL)}, '类') OR c_custkey % 3 = 0 THEN {GRADE_SQL} ELSE CASE WHEN {CSCORE} >= 90 THEN 'A' WHEN {CSCORE} >= 80 THEN 'B' WHEN {CSCORE} >= 70 THEN 'C' WHEN {CSCORE} >= 60 THEN 'D' ELSE 'E' END || '级' END AS grade FROM customer""")
def grade_by_mode(spark, d):
    score = (F.col("c_acctbal").cast("decimal(18,2)") / 100).cast("decimal(18,6)")
    return load(spark, d, "customer").select("c_custkey", R.grade_by_mode(score, GRADE(), F.col("c_custkey") % 3 != 0).alias("grade"))


# ---- recommendations

ADVICE = (
    "立即修复破损护栏", "及时清理排水孔堵塞", "参照养护技术规范进行日常养护维修", "对裂缝进行灌浆修补", "加强日常观测", "定期清理桥面", "支座变形严重，更换支座", "该处存在安全隐患", "对其他常规缺陷进行养护维修", "参照养护规范处理裂缝", "小修处理", "请关注", "封闭裂缝并定期观测", "限制通行",
)
HINTS = ("", "尽快维修", "立即维修", "预防性养护、尽快维修", "预防性养护", "其他")
WORDS_, WORDS_SQL = pick(ADVICE, "o_orderkey * 3 + o_custkey")
HINT, HINT_SQL = pick(HINTS, "o_orderkey + o_custkey * 5")
SOON, FAST, ROUTINE = V.CATEGORIES
INFER_SQL = f"""CASE WHEN regexp_matches(x, '立即(维修|修复|修|处置|处理|进行)') OR {has("x", V.SAFETY_RISK)} OR (contains(x, '变形严重') AND {has("x", ("立即", "更换"))}) THEN '{SOON}' WHEN {has("x", V.CLEANING)} AND {has("x", V.CLOGGED)} THEN '{FAST}'
WHEN {has("x", V.ROUTINE_REPAIR)} OR (contains(x, '其他常规缺陷') AND contains(x, '养护维修')) OR (contains(x, '参照') AND {has("x", V.STANDARDS)} AND NOT {has("x", V.NAMED_DEFECTS)}) THEN '{ROUTINE}' WHEN {has("x", V.CONCRETE_REPAIR)} THEN '{FAST}' WHEN {has("x", V.MONITORING)} THEN '{ROUTINE}' WHEN {has("x", V.LOOSE_REPAIR)} THEN '{FAST}' END"""
NAMED_SQL = lambda x: f"list_filter([{', '.join(f'''CASE WHEN contains(replace({x}, '立即维修', '立即处置'), '{c}') THEN '{c}' END''' for c in V.CATEGORIES)}], lambda c: c IS NOT NULL)"


def _advice(spark, d):
    return load(spark, d, "orders").select("o_orderkey", "o_custkey", WORDS_().alias("x"), HINT().alias("h"))


@query(f"SELECT o_orderkey, {INFER_SQL} AS category FROM (SELECT o_orderkey, {WORDS_SQL} AS x FROM orders)")
def inferred_category(spark, d):
    return _advice(spark, d).select("o_orderkey", R.inferred_category(F.col("x")).alias("category"))


SETTLED_SQL = f"CASE WHEN h = '立即维修' THEN '立即处置' WHEN h IN ({quoted(V.CATEGORIES)}) THEN h WHEN {has('x', V.URGENT_WORDS)} THEN '{SOON}' WHEN {has('x', V.REPAIR_WORDS)} THEN '{FAST}' ELSE '{ROUTINE}' END"


@query(f"SELECT o_orderkey, {SETTLED_SQL} AS category FROM (SELECT o_orderkey, {WORDS_SQL} AS x, {HINT_SQL} AS h FROM orders)")
def settled_category(spark, d):
    return _advice(spark, d).select("o_orderkey", R.settled_category(F.col("h"), F.col("x")).alias("category"))


@query(f"""WITH a AS (SELECT o_orderkey, {WORDS_SQL} AS x, {HINT_SQL} AS h FROM orders), b AS (SELECT o_orderkey, {NAMED_SQL("h")} AS hs, {NAMED_SQL("x")} AS cs, {INFER_SQL} AS i FROM a),
c AS (SELECT o_orderkey, CASE WHEN len(hs) > 1 OR (len(hs) = 1 AND len(cs) > 0 AND hs <> cs) OR (len(hs) = 0 AND len(cs) > 1) THEN '' WHEN len(hs) = 1 THEN coalesce(i, hs[1]) WHEN len(cs) = 1 THEN cs[1] ELSE coalesce(i, '') END AS category FROM b) SELECT o_orderkey, category, category = '' AS unresolved FROM c""")
def resolved_category(spark, d):
    r = R.resolved_category(F.col("h"), F.col("x"))
    return _advice(spark, d).select("o_orderkey", r["category"].alias("category"), r["unresolved"].alias("unresolved"))


COUNT_SQL = f"""a AS (SELECT o_custkey, {SETTLED_SQL} AS category FROM (SELECT o_custkey, {WORDS_SQL} AS x, {HINT_SQL} AS h FROM orders)), k AS (SELECT o_custkey, {", ".join(f"count(*) FILTER (category = '{c}') AS n{i}" for i, c in enumerate(V.CATEGORIES))} FROM a GROUP BY 1)"""


@query(f"WITH {COUNT_SQL} SELECT o_custkey, n0 || '条{SOON}、' || n1 || '条{FAST}、' || n2 || '条{ROUTINE}' AS line FROM k")
def recommendation_summary(spark, d):
    return _summaries(spark, d).select("o_custkey", "line")


def _summaries(spark, d):
    counts = [F.count_if(F.col("category") == c).alias(f"n{i}") for i, c in enumerate(V.CATEGORIES)]
    k = _advice(spark, d).select("o_custkey", R.settled_category(F.col("h"), F.col("x")).alias("category")).groupBy("o_custkey").agg(*counts)
    return k.select("o_custkey", "n0", "n1", "n2", R.counts_text([F.col("n0"), F.col("n1"), F.col("n2")]).alias("line"))


@query(f"""WITH {COUNT_SQL}, l AS (SELECT *, CASE WHEN o_custkey % 4 = 0 THEN (n0 + 1) || ' 条立即维修、2条其他' ELSE n0 || '条{SOON}、' || n1 || '条{FAST}' END AS stated FROM k),
s AS (SELECT o_custkey, n0, n1, n2, CASE WHEN o_custkey % 4 = 0 THEN n0 + 1 ELSE n0 END AS s0, CASE WHEN o_custkey % 4 <> 0 THEN n1 END AS s1 FROM l)
SELECT o_custkey, s0::BIGINT AS stated_soon, s1::BIGINT AS stated_fast, coalesce(s0 <> n0, false) OR coalesce(s1 <> n1, false) AS mismatch FROM s""")
def stated_counts(spark, d):
    """What a summary line states against what the rows hold."""
    k = _summaries(spark, d)
    line = F.when(F.col("o_custkey") % 4 == 0, F.concat((F.col("n0") + 1).cast("string"), F.lit(" 条立即维修、2条其他"))).otherwise(F.concat(F.col("n0").cast("string"), F.lit(f"条{SOON}、"), F.col("n1").cast("string"), F.lit(f"条{FAST}")))
    m = R.stated_counts(line)
    x = k.withColumn("m", m)
    differs = [F.coalesce(F.try_element_at("m", F.lit(c)) != F.col(f"n{i}"), F.lit(False)) for i, c in enumerate(V.CATEGORIES)]
    return x.select("o_custkey", F.try_element_at("m", F.lit(SOON)).alias("stated_soon"), F.try_element_at("m", F.lit(FAST)).alias("stated_fast"), (differs[0] | differs[1] | differs[2]).alias("mismatch"))
