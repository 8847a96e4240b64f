"""Every registered query over the driver's tables, with its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.functions import classify, text
from brindle.operators import extraction, matching, quality, ranking, retrieval, scoring, selection, sequence

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def longs(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


# ---- scalar functions

FOLDED = "regexp_replace(replace(lower(coalesce(text, '')), 'ß', 'ss'), '\\s+', '', 'g')"


@query(f"SELECT doc_id, md5({FOLDED}) AS norm_md5, length({FOLDED})::BIGINT AS norm_chars FROM documents")
def normalize_text(spark, d):
    norm = text.normalize_text(F.col("text"))
    return load(spark, d, "documents").select("doc_id", norm.alias("n")).select("doc_id", F.md5("n").alias("norm_md5"), F.length("n").cast("long").alias("norm_chars"))


@query("SELECT p_partkey, regexp_replace(lower(p_name || p_brand), '[^a-z0-9]', '', 'g') AS key FROM part")
def semantic_key(spark, d):
    return load(spark, d, "part").select("p_partkey", text.semantic_key(F.concat("p_name", "p_brand")).alias("key"))


@query("""SELECT doc_id, CASE WHEN lang <> 'en' AND l.id IS NULL THEN 'not_applicable' WHEN l.id IS NULL THEN 'not_extracted' WHEN quality = 0 THEN 'explicit_none' ELSE 'present' END AS state
FROM documents LEFT JOIN (SELECT doc_id AS id, quality FROM labels) l ON doc_id = l.id""")
def missing_states(spark, d):
    x = load(spark, d, "documents").select("doc_id", "lang").join(load(spark, d, "labels").select("doc_id", "quality", F.lit(True).alias("seen")), "doc_id", "left")
    seen = F.col("seen").isNotNull()
    return x.select("doc_id", text.field_state(seen, seen | (F.col("lang") == "en"), F.col("quality"), 0).alias("state"))


SCORE = "CAST(c_acctbal AS DECIMAL(18,2)) / 100"
BAND = f"CASE WHEN {SCORE} >= 90 THEN 'A' WHEN {SCORE} >= 80 THEN 'B' WHEN {SCORE} >= 70 THEN 'C' WHEN {SCORE} >= 60 THEN 'D' ELSE 'E' END"


@query(f"SELECT c_mktsegment, {BAND} AS grade, count(*) AS n FROM customer GROUP BY ALL")
def grade_bands(spark, d):
    score = (F.col("c_acctbal").cast("decimal(18,2)") / 100).cast("decimal(18,6)")
    return load(spark, d, "customer").groupBy("c_mktsegment", text.grade(score).alias("grade")).agg(F.count("*").alias("n"))


@query(f"""SELECT c_mktsegment, CASE WHEN r = '' THEN 'filled' WHEN r = g THEN 'preserved' ELSE 'mapped' END AS kind, count(*) AS n, count(DISTINCT c_nationkey) AS n_nations
FROM (SELECT *, {BAND} AS g, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' ELSE 'E' END AS r FROM customer) GROUP BY ALL""")
def grade_mode_diff(spark, d):
    score = (F.col("c_acctbal").cast("decimal(18,2)") / 100).cast("decimal(18,6)")
    reported = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, "A").otherwise("E")
    return load(spark, d, "customer").groupBy("c_mktsegment", text.grade_change(score, reported).alias("kind")).agg(F.count("*").alias("n"), F.countDistinct("c_nationkey").alias("n_nations"))


KEYWORDS = [("tion", "abstract"), ("the", "english"), ("heit", "german"), ("keit", "german"), ("mente", "spanish"), ("aux", "french"), ("token", "secret"), ("@mail", "contact")]


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(text, '{k}') THEN '{c}'" for k, c in sorted(KEYWORDS, key=lambda x: -len(x[0]))) + " END AS category FROM documents")
def keyword_classify(spark, d):
    return load(spark, d, "documents").select("doc_id", classify.longest_keyword(F.col("text"), KEYWORDS).alias("category"))


CASCADE = [("(?i)token = ", "immediate"), ("[0-9]{13,19}", "soon"), ("\\+[0-9]", "soon"), ("@", "routine")]


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)token = ') THEN 'immediate' WHEN regexp_matches(text, '[0-9]{13,19}') OR regexp_matches(text, '\\+[0-9]') THEN 'soon' WHEN contains(text, '@') THEN 'routine' ELSE 'preventive' END AS category FROM documents")
def keyword_cascade(spark, d):
    return load(spark, d, "documents").select("doc_id", classify.cascade(F.col("text"), CASCADE, "preventive").alias("category"))


@query("SELECT p_partkey, CASE WHEN p_name LIKE '%ring' THEN 'ring' WHEN p_name LIKE '%widget' THEN 'widget' WHEN p_name LIKE '%t' THEN 'other t' END AS kind FROM part")
def suffix_semantics(spark, d):
    return load(spark, d, "part").select("p_partkey", classify.by_suffix(F.col("p_name"), [("ring", "ring"), ("widget", "widget"), ("t", "other t")]).alias("kind"))


@query("SELECT page_id, 'sha256:' || left(sha256(url), 16) AS safe_url FROM pages")
def redact(spark, d):
    return load(spark, d, "pages").select("page_id", text.redact_paths(F.col("url")).alias("safe_url"))


@query("""SELECT page_id, 'page:' || left(sha256('["' || page_id::VARCHAR || '","' || url || '"]'), 20) AS id FROM pages""")
def stable_id(spark, d):
    return load(spark, d, "pages").select("page_id", text.stable_id("page", F.col("page_id"), F.col("url")).alias("id"))


@query("SELECT item_id, CASE WHEN length(text) <= 80 THEN text ELSE left(text, 56) || '…' || right(text, 23) END AS short FROM benchmark")
def shorten(spark, d):
    return load(spark, d, "benchmark").select("item_id", text.shorten(F.col("text"), 80).alias("short"))


FACT_TOKENS = lambda x: f"(CASE WHEN {x} = '' THEN [] WHEN len(regexp_extract_all({x}, '[a-z0-9]+(?:[._/-][a-z0-9]+)*|[\u3400-\u9fff]+')) = 0 THEN [{x}] ELSE regexp_extract_all({x}, '[a-z0-9]+(?:[._/-][a-z0-9]+)*|[\u3400-\u9fff]+') END)"  # noqa: E731  the tables hold no ideographs, whose runs would be cut into pairs


@query(f"WITH n AS (SELECT doc_id, {FOLDED} AS n FROM documents) SELECT doc_id, len(t)::BIGINT AS n_tokens, len(list_distinct(t))::BIGINT AS n_distinct FROM (SELECT doc_id, {FACT_TOKENS('n')} AS t FROM n)")
def fact_tokens(spark, d):
    x = load(spark, d, "documents").select("doc_id", text.fact_tokens(text.normalize_text(F.col("text"))).alias("t"))
    return x.select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.size(F.array_distinct("t")).cast("long").alias("n_distinct"))


# ---- ordered rows

LINES_SQL = """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents),
b AS (SELECT doc_id, pos, CASE WHEN length(line) <= 12 THEN 1 WHEN length(line) <= 40 THEN 2 END AS level FROM l)"""


def _lines(spark, d):
    x = load(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    level = F.when(F.length("line") <= 12, 1).when(F.length("line") <= 40, 2)
    return x.select("doc_id", F.col("pos").cast("long").alias("pos"), level.alias("level"))


@query(LINES_SQL + """, n AS (SELECT doc_id, max(pos) + 1 AS last FROM b GROUP BY 1)
SELECT s.doc_id, s.pos AS start_block, coalesce((SELECT min(e.pos) FROM b e WHERE e.doc_id = s.doc_id AND e.pos > s.pos AND e.level <= s.level), n.last)::BIGINT AS end_block, s.level FROM b s JOIN n USING (doc_id) WHERE s.level IS NOT NULL""")
def section_intervals(spark, d):
    return sequence.section_intervals(_lines(spark, d), ["doc_id"], "pos", "level", 2)


@query(LINES_SQL + """SELECT doc_id, pos, (SELECT max(h.pos) FROM b h WHERE h.doc_id = b.doc_id AND h.pos <= b.pos AND h.level = 1) AS in_level_1,
(SELECT CASE WHEN max(h.pos) FILTER (h.level = 2) > coalesce(max(h.pos) FILTER (h.level = 1), -1) THEN max(h.pos) FILTER (h.level = 2) END FROM b h WHERE h.doc_id = b.doc_id AND h.pos <= b.pos) AS in_level_2 FROM b""")
def block_membership(spark, d):
    return sequence.block_membership(_lines(spark, d), ["doc_id"], "pos", "level", 2).select("doc_id", "pos", "in_level_1", "in_level_2")


@query("""WITH s AS (SELECT conv_id, max(turn) FILTER (role = 'user') AS start_block FROM conversations GROUP BY 1)
SELECT c.conv_id, any_value(start_block) AS start_block, min(turn) FILTER (role = 'assistant' AND turn > start_block) AS end_block FROM conversations c JOIN s USING (conv_id) GROUP BY 1""")
def last_marker_window(spark, d):
    return sequence.last_marker_window(load(spark, d, "conversations"), ["conv_id"], "turn", F.col("role") == "user", F.col("role") == "assistant")


def _gappy(spark, d):
    return load(spark, d, "events").select("event_id", "user_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("value"))


@query("SELECT event_id, last_value(CASE WHEN event_id % 3 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS value FROM events")
def forward_fill(spark, d):
    return sequence.forward_fill(_gappy(spark, d), ["user_id"], ["event_id"], ["value"]).select("event_id", "value")


@query("""SELECT event_id, CASE WHEN v IS NULL AND event_type = 'click' THEN last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) ELSE v END AS value
FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN value END AS v FROM events)""")
def conditional_fill(spark, d):
    return sequence.conditional_fill(_gappy(spark, d), ["user_id"], ["event_id"], "value", F.col("event_type") == "click").select("event_id", "value")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS last_error FROM events")
def asof_label(spark, d):
    return sequence.as_of(load(spark, d, "events"), ["user_id"], ["event_id"], F.col("event_type") == "error", F.col("event_id"), "last_error").select("event_id", "last_error")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'error' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS recent_error FROM events")
def lookback_scope(spark, d):
    return sequence.look_back(load(spark, d, "events"), ["user_id"], ["event_id"], F.col("event_type") == "error", F.col("event_id"), 3, "recent_error").select("event_id", "recent_error")


@query("""SELECT conv_id, island, string_agg(text, chr(10) ORDER BY turn) AS text, count(*) AS n_rows
FROM (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS island FROM conversations) GROUP BY ALL""")
def continuation_islands(spark, d):
    return sequence.merge_continuations(load(spark, d, "conversations"), ["conv_id"], ["turn"], F.col("role") == "user", "text", "\n")


@query("""SELECT event_id, sum(n) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS run FROM (SELECT event_id, user_id,
CASE WHEN row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))""")
def run_groups(spark, d):
    return sequence.runs(load(spark, d, "events"), ["user_id"], ["event_id"], F.col("event_type")).select("event_id", "run")


@query("""WITH f AS (SELECT event_id, user_id, last_value(CASE WHEN event_id % 2 = 0 THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events)
SELECT event_id, sum(n) OVER (PARTITION BY user_id ORDER BY event_id)::BIGINT AS display_index FROM (SELECT *, CASE WHEN row_number() OVER w = 1 OR k IS DISTINCT FROM lag(k) OVER w THEN 1 ELSE 0 END AS n FROM f WINDOW w AS (PARTITION BY user_id ORDER BY event_id))""")
def dense_display_index(spark, d):
    return sequence.dense_index(load(spark, d, "events"), ["user_id"], ["event_id"], F.when(F.col("event_id") % 2 == 0, F.col("event_type"))).select("event_id", "display_index")


@query("""SELECT conv_id, turn, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations QUALIFY role = 'user'""")
def next_value_lookup(spark, d):
    return sequence.next_value(load(spark, d, "conversations"), ["conv_id"], "turn", F.col("role") == "user", "text", "answer").select("conv_id", "turn", "answer")


@query("""SELECT doc_id, item_no, item FROM (SELECT doc_id, unnest(string_split(text, '. ')) AS item, unnest(range(len(string_split(text, '. '))))::INT AS item_no FROM documents) WHERE trim(item) <> ''""")
def split_items(spark, d):
    return sequence.split_items(load(spark, d, "documents"), "text", "\\. ", ["doc_id"])


# ---- joins and matching


def _names(spark, d):
    left = load(spark, d, "customer").select(F.concat(F.regexp_extract("c_name", "0*([0-9]+)$", 1), F.when(F.col("c_custkey") % 5 == 0, "-name").otherwise("")).alias("key"))
    right = load(spark, d, "supplier").select(F.regexp_extract("s_name", "0*([0-9]+)$", 1).alias("key"))
    return left, right


@query("""WITH l AS (SELECT regexp_extract(c_name, '0*([0-9]+)$', 1) || CASE WHEN c_custkey % 5 = 0 THEN '-name' ELSE '' END AS key, count(*) AS nl FROM customer GROUP BY 1),
r AS (SELECT regexp_extract(s_name, '0*([0-9]+)$', 1) AS key, count(*) AS nr FROM supplier GROUP BY 1),
f AS (SELECT l.key, count(DISTINCT r.key) AS nf FROM l JOIN r ON contains(l.key, r.key) OR contains(r.key, l.key) WHERE NOT EXISTS (SELECT 1 FROM r x WHERE x.key = l.key) GROUP BY 1)
SELECT l.key, CASE WHEN nl > 1 THEN 'duplicate' WHEN nr = 1 THEN 'paired_exact' WHEN nr > 1 THEN 'ambiguous' WHEN nf = 1 THEN 'paired_fuzzy' WHEN nf > 1 THEN 'ambiguous' ELSE 'missing' END AS status FROM l LEFT JOIN r ON l.key = r.key LEFT JOIN f ON l.key = f.key""")
def pair_entities(spark, d):
    left, right = _names(spark, d)
    return matching.pair_entities(left, right, "key")


@query("""SELECT url, any_value(n)::BIGINT AS n_found, CASE any_value(n) WHEN 0 THEN 'missing' WHEN 1 THEN 'aligned' ELSE 'ambiguous' END AS status FROM (SELECT p.url, count(f.url) AS n FROM (SELECT DISTINCT url FROM pages) p LEFT JOIN (SELECT url FROM pages WHERE page_id % 7 <> 0) f ON p.url = f.url GROUP BY 1) GROUP BY 1""")
def align_fail_closed(spark, d):
    pages = load(spark, d, "pages")
    return matching.align_unique(pages.select("url").distinct(), pages.where("page_id % 7 <> 0"), "url")


@query("""SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN a.doc_id IS NULL THEN 'extra' WHEN b.doc_id IS NULL THEN 'missing' ELSE 'aligned' END AS status
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id % 11 <> 0) a FULL JOIN (SELECT DISTINCT doc_id FROM labels) b ON a.doc_id = b.doc_id""")
def full_outer_align(spark, d):
    return matching.full_outer_align(load(spark, d, "documents").where("doc_id % 11 <> 0"), load(spark, d, "labels"), "doc_id")


@query("""WITH a AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS t FROM benchmark), b AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS t FROM documents),
s AS (SELECT item_id, doc_id, count(*) AS shared FROM a JOIN b USING (t) GROUP BY ALL) SELECT item_id, doc_id, shared, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id)::INT AS rank FROM s QUALIFY rank <= 3""")
def best_match(spark, d):
    tokens = F.regexp_extract_all(F.lower("text"), F.lit("[\\p{L}\\p{N}]+"), F.lit(0)).alias("tokens")
    return matching.best_match(load(spark, d, "benchmark").select("item_id", tokens), load(spark, d, "documents").select("doc_id", tokens), "item_id", "doc_id", "tokens", 3)


@query("SELECT doc_id, text FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains(' ' || d.text || ' ', ' ' || b.text || ' '))")
def covered_anti(spark, d):
    docs, items = load(spark, d, "documents"), load(spark, d, "benchmark")
    needles = items.select("item_id", F.col("text").alias("needle"))
    covered = matching.containing(docs, needles, "doc_id", "text", "item_id", "needle").select("doc_id").distinct()
    return docs.select("doc_id", "text").join(covered, "doc_id", "left_anti")


GOLD_PRED = """g AS (SELECT *, 1 AS g, 0 AS p FROM lineitem UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN l_orderkey % 11 = 0 THEN l_quantity + 1000 ELSE l_quantity END, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate, 0, 1 FROM lineitem WHERE l_orderkey % 7 <> 0),
c AS (SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_quantity, sum(g) AS g, sum(p) AS p FROM g GROUP BY ALL)"""
SIGNATURE = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
PRF = """round_even(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 1.0 END, 6) AS precision, round_even(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 1.0 END, 6) AS recall,
round_even(CASE WHEN 2 * tp + fp + fn = 0 THEN 1.0 WHEN tp = 0 THEN (CASE WHEN tp + fp = 0 OR tp + fn = 0 THEN 0.0 ELSE 0.0 END) ELSE 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) END, 6) AS f1"""


def _sides(spark, d):
    gold = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")
    predicted = gold.where("l_orderkey % 7 <> 0").withColumn("l_quantity", F.when(F.col("l_orderkey") % 11 == 0, F.col("l_quantity") + 1000).otherwise(F.col("l_quantity")))
    return gold, predicted


@query(f"WITH {GOLD_PRED}, s AS (SELECT l_returnflag, sum(least(g, p))::BIGINT AS tp, sum(p - least(g, p))::BIGINT AS fp, sum(g - least(g, p))::BIGINT AS fn FROM c GROUP BY 1) SELECT *, {PRF} FROM s")
def row_match_score(spark, d):
    out = matching.multiset_match(*_sides(spark, d), SIGNATURE, ["l_returnflag"])
    return out.select("l_returnflag", *longs("tp", "fp", "fn"), *matching.metrics(F.col("tp"), F.col("fp"), F.col("fn")))


@query(f"""WITH {GOLD_PRED}, e AS (SELECT l_returnflag, l_orderkey % 50 AS sample, sum(least(g, p))::BIGINT AS tp, sum(p - least(g, p))::BIGINT AS fp, sum(g - least(g, p))::BIGINT AS fn FROM c GROUP BY 1, 2),
f AS (SELECT *, {PRF} FROM e), s AS (SELECT l_returnflag, sum(tp)::BIGINT AS tp, sum(fp)::BIGINT AS fp, sum(fn)::BIGINT AS fn, round_even(avg(f1), 6) AS macro_f1 FROM f GROUP BY 1),
t AS (SELECT l_returnflag, tp, fp, fn, {PRF}, macro_f1 FROM s)
SELECT *, round_even(f1 * w, 6) AS micro_score, round_even(macro_f1 * w, 6) AS macro_score FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 40.0 WHEN 'N' THEN 35.0 ELSE 25.0 END AS w FROM t)""".replace("SELECT *, round_even(f1 * w", "SELECT * EXCLUDE (w), round_even(f1 * w"))
def score_micro_macro(spark, d):
    gold, predicted = (x.withColumn("sample", F.col("l_orderkey") % 50) for x in _sides(spark, d))
    counts = matching.multiset_match(gold, predicted, [*SIGNATURE, "sample"], ["l_returnflag", "sample"])
    out = matching.micro_macro(counts, "sample", "l_returnflag", {"A": 40.0, "N": 35.0, "R": 25.0})
    return out.withColumns({c: F.col(c).cast("long") for c in ("tp", "fp", "fn")})


@query("""WITH g AS (SELECT c_custkey, unnest(['name', 'segment', 'balance']) AS field, unnest([c_name, c_mktsegment, c_acctbal::DECIMAL(18,2)::VARCHAR]) AS v FROM customer),
p AS (SELECT c_custkey, field, CASE WHEN c_custkey % 9 = 0 THEN v || '!' ELSE v END AS v FROM g WHERE NOT (field = 'segment' AND c_custkey % 4 = 0))
SELECT coalesce(g.field, p.field) AS field, sum(CASE WHEN g.v = p.v THEN 1 ELSE 0 END)::BIGINT AS tp, sum(CASE WHEN p.v IS NOT NULL AND g.v IS DISTINCT FROM p.v THEN 1 ELSE 0 END)::BIGINT AS fp,
sum(CASE WHEN g.v IS NOT NULL AND g.v IS DISTINCT FROM p.v THEN 1 ELSE 0 END)::BIGINT AS fn FROM g FULL JOIN p ON g.c_custkey = p.c_custkey AND g.field = p.field GROUP BY 1""")
def map_field_score(spark, d):
    c = load(spark, d, "customer")
    gold = c.select("c_custkey", F.explode(F.create_map(F.lit("name"), "c_name", F.lit("segment"), "c_mktsegment", F.lit("balance"), F.col("c_acctbal").cast("decimal(18,2)").cast("string"))).alias("field", "v"))
    pred = gold.where(~((F.col("field") == "segment") & (F.col("c_custkey") % 4 == 0))).withColumn("v", F.when(F.col("c_custkey") % 9 == 0, F.concat("v", F.lit("!"))).otherwise(F.col("v"))).withColumnRenamed("v", "w")
    return scoring.map_counts(gold, pred.withColumnRenamed("w", "v"), ["c_custkey"], "field", "v")


FACTS_SQL = f"""WITH f AS (SELECT conv_id, turn, role, {FACT_TOKENS("n")} AS ts FROM (SELECT conv_id, turn, role, {FOLDED} AS n FROM conversations)), t AS (SELECT conv_id, turn, role, unnest(ts) AS w FROM f), c AS (SELECT conv_id, turn, role, w, count(*) AS n FROM t GROUP BY ALL),
z AS (SELECT conv_id, turn, sum(n) AS total FROM c GROUP BY ALL),
pr AS (SELECT g.conv_id, g.turn AS gold_turn, p.turn AS pred_turn, sum(least(g.n, p.n))::BIGINT AS shared, 2 * sum(least(g.n, p.n)) / (any_value(a.total) + any_value(b.total)) AS dice
FROM c g JOIN c p ON g.conv_id = p.conv_id AND g.w = p.w AND g.role = 'user' AND p.role = 'assistant' JOIN z a ON a.conv_id = g.conv_id AND a.turn = g.turn JOIN z b ON b.conv_id = p.conv_id AND b.turn = p.turn GROUP BY 1, 2, 3)"""
#: One-to-one pairs in a given order as a fold: the accumulator is a list of pairs, and so is every element.
GREEDY_SQL = "list_reduce(list_prepend([]::STRUCT(g BIGINT, p BIGINT)[], {items}), lambda a, e: CASE WHEN len(list_filter(a, lambda y: y.g = e[1].g OR y.p = e[1].p)) > 0 THEN a ELSE list_concat(a, e) END)"


def _facts(spark, d):
    c = load(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return c.where("role = 'user'"), c.where("role = 'assistant'")


@query(FACTS_SQL + " SELECT conv_id, gold_turn, pred_turn, shared, round(dice, 6) AS dice FROM pr")
def fact_pair_dice(spark, d):
    pairs = scoring.fact_pairs(*_facts(spark, d), ["conv_id"], "turn", "text")
    return pairs.select("conv_id", F.col("gold_item").alias("gold_turn"), F.col("predicted_item").alias("pred_turn"), "shared", F.round("dice", 6).alias("dice"))


FACT_FOLD = FACTS_SQL + f""", l AS (SELECT conv_id, {GREEDY_SQL.format(items="list([{'g': gold_turn, 'p': pred_turn}] ORDER BY dice DESC, shared DESC, gold_turn, pred_turn)")} AS ps FROM pr GROUP BY 1), ch AS (SELECT conv_id, unnest(ps) AS q FROM l)"""


@query(FACT_FOLD + " SELECT conv_id, q.g AS gold_turn, q.p AS pred_turn FROM ch")
def fact_greedy_score(spark, d):
    pairs = scoring.fact_pairs(*_facts(spark, d), ["conv_id"], "turn", "text")
    out = matching.greedy_pairs(pairs, "conv_id", "gold_item", "predicted_item", [-F.col("dice"), -F.col("shared"), F.col("gold_item"), F.col("predicted_item")])
    return out.withColumnsRenamed({"gold_item": "gold_turn", "predicted_item": "pred_turn"})


@query(FACT_FOLD + """, tp AS (SELECT ch.conv_id, sum(shared)::BIGINT AS tp FROM ch JOIN pr ON pr.conv_id = ch.conv_id AND gold_turn = q.g AND pred_turn = q.p GROUP BY 1), s AS (SELECT conv_id, sum(CASE WHEN role = 'user' THEN len(ts) ELSE 0 END)::BIGINT AS g, sum(CASE WHEN role = 'assistant' THEN len(ts) ELSE 0 END)::BIGINT AS p FROM f WHERE role IN ('user', 'assistant') GROUP BY 1)
SELECT s.conv_id, coalesce(tp, 0)::BIGINT AS tp, p - coalesce(tp, 0)::BIGINT AS fp, g - coalesce(tp, 0)::BIGINT AS fn FROM s LEFT JOIN tp ON tp.conv_id = s.conv_id""")
def fact_counts(spark, d):
    return scoring.fact_counts(*_facts(spark, d), ["conv_id"], "turn", "text")


# ---- selection

EAV_SQL = """e AS (SELECT o_custkey, o_orderkey, 'status' AS field, o_orderstatus AS value, CASE WHEN o_orderkey % 3 = 0 THEN 'table' ELSE 'text' END AS source, o_orderkey % 10 AS priority FROM orders
UNION ALL SELECT o_custkey, o_orderkey, 'priority', o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN 'table' ELSE 'text' END, o_orderkey % 10 FROM orders)"""


def _candidates(spark, d):
    fields = F.inline(F.array(*[F.struct(F.lit(n).alias("field"), F.col(c).alias("value")) for n, c in (("status", "o_orderstatus"), ("priority", "o_orderpriority"))]))
    x = load(spark, d, "orders").select("o_custkey", "o_orderkey", fields)
    return x.withColumn("source", F.when(F.col("o_orderkey") % 3 == 0, "table").otherwise("text")).withColumn("priority", F.col("o_orderkey") % 10)


@query(f"WITH {EAV_SQL} SELECT o_custkey, field, value, source FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, field ORDER BY (source = 'table') DESC, priority DESC, o_orderkey) AS r FROM e) WHERE r = 1")
def candidate_select(spark, d):
    out = selection.select_by_priority(_candidates(spark, d), ["o_custkey", "field"], [F.desc(F.col("source") == "table"), F.desc("priority"), F.col("o_orderkey")])
    return out.select("o_custkey", "field", "value", "source")


@query(f"WITH {EAV_SQL} SELECT o_custkey, field, count(DISTINCT value) AS n_values FROM e WHERE value <> '' GROUP BY 1, 2 HAVING count(DISTINCT value) > 1")
def conflict_flags(spark, d):
    return selection.conflicts(_candidates(spark, d), ["o_custkey", "field"], "value")


@query(f"""WITH {EAV_SQL} SELECT o_custkey, field, 'table=' || min(value) FILTER (source = 'table') || '; text=' || min(value) FILTER (source = 'text') AS selected FROM e GROUP BY 1, 2
HAVING count(*) FILTER (source = 'table') > 0 AND count(*) FILTER (source = 'text') > 0""")
def scoped_select(spark, d):
    return selection.scoped_select(_candidates(spark, d), ["o_custkey", "field"], "source", ("table", "text"), "value")


SENTENCES_SQL = "s AS (SELECT doc_id, unnest(string_split(text, '. ')) AS item, unnest(range(len(string_split(text, '. '))))::INT AS item_no FROM documents)"


@query(f"WITH {SENTENCES_SQL}, u AS (SELECT doc_id, item_no, sum(length(item)) OVER (PARTITION BY doc_id ORDER BY item_no)::BIGINT AS used FROM s WHERE trim(item) <> '') SELECT * FROM u WHERE used <= 250")
def budget_select(spark, d):
    x = sequence.split_items(load(spark, d, "documents"), "text", "\\. ", ["doc_id"])
    return selection.budget_select(x, ["doc_id"], ["item_no"], F.length("item"), 250).select("doc_id", "item_no", "used")


BUDGET_CELL = "{{'out': {o}, 'used': {u}, 'done': {d}, 'x': {x}}}"
BUDGET_TAKES = "(NOT a.done AND len(a.out) < 4 AND (least(length(e.x), 180) <= 250 - a.used OR 250 - a.used >= 24))"
BUDGET_KEPT = "left(left(e.x, 180), greatest(CASE WHEN least(length(e.x), 180) <= 250 - a.used THEN 180 ELSE 250 - a.used END, 0))"
BUDGET_STEP = BUDGET_CELL.format(o=f"CASE WHEN {BUDGET_TAKES} THEN list_append(a.out, {BUDGET_KEPT}) ELSE a.out END", u=f"a.used + CASE WHEN {BUDGET_TAKES} THEN length({BUDGET_KEPT}) ELSE 0 END", d=f"a.done OR NOT ({BUDGET_TAKES} AND least(length(e.x), 180) <= 250 - a.used)", x="e.x")
BUDGET_START = BUDGET_CELL.format(o="[]::VARCHAR[]", u="0::BIGINT", d="false", x="''")
BUDGET_ITEM = BUDGET_CELL.format(o="[]::VARCHAR[]", u="0::BIGINT", d="false", x="v")


@query(f"""WITH i AS (SELECT doc_id, list_filter(string_split(text, '. '), lambda x: trim(x, ' ') <> '') AS items FROM documents)
SELECT doc_id, array_to_string(list_reduce(list_prepend({BUDGET_START}, list_transform(items, lambda v: {BUDGET_ITEM})), lambda a, e: {BUDGET_STEP}).out, '. ') AS summary FROM i""")
def budget_fold(spark, d):
    """The order-dependent budget: capped sentences, a cut tail, at most four."""
    items = F.filter(F.split("text", "\\. "), lambda x: F.trim(x) != "")
    return load(spark, d, "documents").select("doc_id", F.array_join(selection.budget_fold(items, 250, 180, 24, 4), ". ").alias("summary"))


@query("""WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY embedding[1] DESC, vec_id) <= 2 AS reserved, embedding[1] AS x FROM embeddings)
SELECT vec_id, label, reserved, row_number() OVER (ORDER BY reserved DESC, x DESC, vec_id)::INT AS rank FROM r QUALIFY rank <= 40""")
def quota_reserve(spark, d):
    x = load(spark, d, "embeddings").select("vec_id", "label", F.col("embedding")[0].alias("x"), F.lit(1).alias("one"))
    return selection.quota_reserve(x, ["one"], "label", 2, 40, [F.desc("x"), F.col("vec_id")]).select("vec_id", "label", "reserved", "rank")


@query("SELECT md5(text) AS text_md5, min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY text")
def exact_dedupe(spark, d):
    return selection.exact_dedupe(load(spark, d, "documents"), ["text"], ["doc_id"]).select(F.md5("text").alias("text_md5"), "doc_id", "n_copies")


@query("""WITH i AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[.\n] *'), lambda x: x <> '') AS items FROM documents),
k AS (SELECT doc_id, items, list_reduce(list_prepend([]::VARCHAR[], list_transform(items, lambda v: [v])), lambda a, e: CASE WHEN len(list_filter(a, lambda y: y = e[1] OR (length(y) >= 8 AND length(e[1]) >= 8 AND (contains(y, e[1]) OR contains(e[1], y))))) > 0 THEN a ELSE list_concat(a, e) END) AS kept FROM i)
SELECT doc_id, len(items)::BIGINT AS n_items, len(kept)::BIGINT AS n_kept FROM k""")
def containment_dedupe(spark, d):
    items = F.filter(F.split(F.lower("text"), "[.\n] *"), lambda x: x != "")
    kept = selection.containment_fold(items, 8)
    return load(spark, d, "documents").select("doc_id", F.size(items).cast("long").alias("n_items"), F.size(kept).cast("long").alias("n_kept"))


def _top_cosine(spark, d, admit, k=6, index=None):
    e = load(spark, d, "embeddings").select(F.col("vec_id").alias("entry_id"), "embedding", "label")
    q = e.where("entry_id % 50 = 0").select(F.col("entry_id").alias("query_id"), F.col("embedding").alias("query_embedding"), F.col("label").alias("query_label"))
    hits = retrieval.best(retrieval.scored(e if index is None else e.where(index), q, admit), ["query_id"], k)
    return hits.select("query_id", F.col("entry_id").alias("vec_id"), "label", F.round("score", 6).alias("score"), "rank")


def _other():
    return F.col("entry_id") != F.col("query_id")


COSINE = """SELECT q.vec_id AS query_id, c.vec_id, c.label, q.label AS query_label, list_inner_product(q.e, c.e) / (sqrt(list_inner_product(q.e, q.e)) * sqrt(list_inner_product(c.e, c.e))) AS s
FROM (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings) q JOIN (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings) c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id"""


@query(f"WITH s AS ({COSINE}) SELECT query_id, vec_id, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id)::INT AS rank FROM s QUALIFY rank <= 6")
def cosine_topk(spark, d):
    return _top_cosine(spark, d, _other()).drop("label")


@query(f"WITH s AS ({COSINE}) SELECT query_id, vec_id, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id)::INT AS rank FROM s WHERE vec_id % 2 = 1 AND label <> query_label QUALIFY rank <= 6")
def cosine_topk_filtered(spark, d):
    return _top_cosine(spark, d, _other() & (F.col("label") != F.col("query_label")), index="entry_id % 2 = 1").drop("label")


@query(f"""WITH s AS ({COSINE}), t AS (SELECT *, CASE WHEN label % 3 = 0 THEN 'knowledge' WHEN label % 3 = 1 THEN 'label' ELSE 'report' END AS source FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY query_id, source ORDER BY s DESC, vec_id) AS r FROM t)
SELECT query_id, vec_id, source, round(s, 6) AS score, row_number() OVER (PARTITION BY query_id ORDER BY source, r)::INT AS rank FROM n WHERE r <= CASE source WHEN 'knowledge' THEN 3 WHEN 'label' THEN 2 ELSE 1 END QUALIFY rank <= 6""")
def retrieve_quota_fallback(spark, d):
    """Quota retrieval without a reranker: each source's best, in source order rather than score order."""
    e = load(spark, d, "embeddings")
    kind = F.get(F.array(F.lit("knowledge"), F.lit("label"), F.lit("report")), F.col("label") % 3)
    index = e.select(F.col("vec_id").alias("entry_id"), "embedding", kind.alias("kind"))
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    out = retrieval.retrieve(index, q, _other(), top_k=6, quotas={"knowledge": 3, "label": 2, "report": 1})
    return out.select("query_id", F.col("entry_id").alias("vec_id"), F.col("kind").alias("source"), F.round("score", 6).alias("score"), "rank")


# ---- aggregation and reports


@query("""WITH c AS (SELECT o_custkey, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, any_value(c_mktsegment) AS segment FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
b AS (SELECT *, CASE WHEN n <= 5 THEN '1-5' WHEN n <= 10 THEN '6-10' ELSE '11+' END AS bucket FROM c)
SELECT bucket, segment, count(*) AS n_customers, sum(n)::BIGINT AS n_orders, sum(total)::DECIMAL(28,2) AS total FROM b GROUP BY GROUPING SETS ((bucket), (segment), ())""")
def bucket_rollup(spark, d):
    c = load(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total"))
    b = c.join(load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")), "o_custkey")
    b = b.withColumns({"bucket": F.lit(0), "_bucket": F.when(F.col("n") <= 5, "1-5").when(F.col("n") <= 10, "6-10").otherwise("11+")})
    out = scoring.bucketed(b.drop("bucket"), F.col("_bucket"), ["segment"], ["n", "total"])
    return out.select("bucket", "segment", F.col("n_records").alias("n_customers"), F.col("n").alias("n_orders"), F.col("total").cast("decimal(28,2)").alias("total"))


@query("""SELECT n_name, p.o_orderpriority, count(o.o_orderkey) AS n FROM nation CROSS JOIN (SELECT DISTINCT o_orderpriority FROM orders) p LEFT JOIN customer ON c_nationkey = n_nationkey
LEFT JOIN orders o ON o.o_custkey = c_custkey AND o.o_orderpriority = p.o_orderpriority GROUP BY 1, 2""")
def category_counts_zero_filled(spark, d):
    """Counts of every nation and priority over all customers; those that never occur are zero."""
    o = load(spark, d, "orders").join(load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")), "o_custkey")
    kinds = sorted(r[0] for r in load(spark, d, "orders").select("o_orderpriority").distinct().limit(100).collect())
    return ranking.counts_zero_filled(load(spark, d, "nation").select("n_nationkey", "n_name"), o, "n_nationkey", "o_orderpriority", kinds).select("n_name", "o_orderpriority", "n")


@query("SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS host, count(*) AS n_files, sum(octet_length(encode(html)))::BIGINT AS n_bytes, max(length(html))::BIGINT AS longest FROM pages GROUP BY 1")
def file_stats(spark, d):
    return ranking.file_statistics(load(spark, d, "pages"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), "html")


COVER = {"secret": "token = ", "contact": "@mail", "number": "555-"}


@query("SELECT source, category, sum(CASE WHEN contains(text, k) THEN 1 ELSE 0 END)::BIGINT AS n_rows, count(*) AS n_total FROM documents CROSS JOIN (VALUES " + ", ".join(f"('{c}', '{k}')" for c, k in COVER.items()) + ") v(category, k) GROUP BY 1, 2")
def coverage_audit(spark, d):
    return quality.coverage(load(spark, d, "documents"), "doc_id", {c: F.col("text").contains(k) for c, k in COVER.items()}, "source").withColumn("n_rows", F.col("n_rows").cast("long"))


@query("SELECT lang, count(*) FILTER (n_chars < 1000) AS short, count(*) FILTER (n_chars BETWEEN 1000 AND 4999) AS middle, count(*) FILTER (n_chars >= 5000) AS long FROM documents GROUP BY 1")
def state_matrix(spark, d):
    size = F.when(F.col("n_chars") < 1000, "short").when(F.col("n_chars") < 5000, "middle").otherwise("long")
    return ranking.state_matrix(load(spark, d, "documents").withColumn("size", size), "lang", "size", ["short", "middle", "long"])


@query("""SELECT n_name, CASE WHEN count(s_suppkey) > 0 THEN max(CAST(s_acctbal AS DECIMAL(18,2))) END AS best, count(s_suppkey) AS n, row_number() OVER (ORDER BY CASE WHEN count(s_suppkey) > 0 THEN max(CAST(s_acctbal AS DECIMAL(18,2))) END DESC NULLS LAST, count(s_suppkey) DESC, n_name)::INT AS rank
FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name""")
def leaderboard_rank(spark, d):
    from pyspark.sql.window import Window

    s = load(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.max(F.col("s_acctbal").cast("decimal(18,2)")).alias("best"), F.count("*").alias("n"))
    x = load(spark, d, "nation").join(s, "n_nationkey", "left").select("n_name", "best", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    return x.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("best"), F.desc("n"), "n_name")))


@query("""WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2), t AS (SELECT source, sum(n) AS total FROM c GROUP BY 1)
SELECT source, lang AS dominant, n::BIGINT AS n, 5 * n >= 4 * total AS warns FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS r FROM c) JOIN t USING (source) WHERE r = 1""")
def dominant_value(spark, d):
    return ranking.dominant_value(load(spark, d, "documents"), "source", "lang")


@query("""SELECT 'both' AS part, l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM (SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_orderkey % 2 = 0 INTERSECT ALL SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 0) GROUP BY ALL
UNION ALL SELECT 'first only', l_returnflag, l_linestatus, l_linenumber, count(*) FROM (SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_orderkey % 2 = 0 EXCEPT ALL SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_orderkey % 3 = 0) GROUP BY ALL""")
def multiset_intersect_except(spark, d):
    """INTERSECT ALL and EXCEPT ALL as count arithmetic: one aggregation serves both."""
    keys = ["l_returnflag", "l_linestatus", "l_linenumber"]
    c = load(spark, d, "lineitem").groupBy(*keys).agg(F.count_if(F.col("l_orderkey") % 2 == 0).alias("a"), F.count_if(F.col("l_orderkey") % 3 == 0).alias("b"))
    parts = F.inline(F.array(F.struct(F.lit("both").alias("part"), F.least("a", "b").alias("n")), F.struct(F.lit("first only").alias("part"), (F.col("a") - F.least("a", "b")).alias("n"))))
    return c.select(*keys, parts).where("n > 0").select("part", *keys, "n")


# ---- audit


@query("""WITH j AS (SELECT d.doc_id, d.text, d.n_chars, l.doc_id AS id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT doc_id, unnest([CASE WHEN id IS NULL THEN 'missing_label' END, CASE WHEN quality = 0 THEN 'low_quality' END, CASE WHEN toxic = 1 THEN 'toxic' END, CASE WHEN n_chars <> length(text) THEN 'length_mismatch' END, CASE WHEN n_chars < 50 THEN 'short' END]) AS code FROM j)
SELECT doc_id, code FROM f WHERE code IS NOT NULL""")
def gate_issues(spark, d):
    x = load(spark, d, "documents").select("doc_id", "n_chars", F.length("text").alias("len")).join(load(spark, d, "labels").withColumn("seen", F.lit(True)), "doc_id", "left")
    rules = [("missing_label", F.col("seen").isNull()), ("low_quality", F.col("quality") == 0), ("toxic", F.col("toxic") == 1), ("length_mismatch", F.col("n_chars") != F.col("len")), ("short", F.col("n_chars") < 50)]
    return quality.flags(x, ["doc_id"], rules)


@query("""WITH b AS (SELECT c_custkey, unnest(['c_name', 'c_mktsegment']) AS field, unnest([c_name, c_mktsegment]) AS old FROM customer WHERE c_custkey % 13 <> 0),
a AS (SELECT c_custkey, unnest(['c_name', 'c_mktsegment']) AS field, unnest([c_name, CASE WHEN c_custkey % 6 = 0 THEN 'NEW' ELSE c_mktsegment END]) AS new FROM customer WHERE c_custkey % 17 <> 0)
SELECT coalesce(b.c_custkey, a.c_custkey) AS c_custkey, coalesce(b.field, a.field) AS field, old, new FROM b FULL JOIN a ON b.c_custkey = a.c_custkey AND b.field = a.field WHERE old IS DISTINCT FROM new""")
def before_after_diff(spark, d):
    c = load(spark, d, "customer")
    after = c.where("c_custkey % 17 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 6 == 0, "NEW").otherwise(F.col("c_mktsegment")))
    return quality.field_diff(c.where("c_custkey % 13 <> 0"), after, "c_custkey", ["c_name", "c_mktsegment"])


@query("""SELECT conv_id, turn, CASE WHEN turn % 4 = 1 AND turn % 6 = 1 THEN 'role,text' WHEN turn % 4 = 1 THEN 'role' ELSE 'text' END AS changed FROM conversations WHERE turn % 4 = 1 OR turn % 6 = 1""")
def locked_change(spark, d):
    c = load(spark, d, "conversations")
    after = c.withColumn("role", F.when(F.col("turn") % 4 == 1, "changed").otherwise(F.col("role"))).withColumn("text", F.when(F.col("turn") % 6 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    return quality.locked_changes(c, after, ["conv_id", "turn"], ["role", "text"])


@query("""WITH t AS (SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(text, '[0-9]+')) AS n FROM conversations WHERE role = 'assistant'), k AS (SELECT DISTINCT conv_id, unnest(regexp_extract_all(text, '[0-9]+')) AS n FROM conversations WHERE role <> 'assistant')
SELECT conv_id, turn, n FROM t WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.conv_id = t.conv_id AND k.n = t.n)""")
def new_fact_audit(spark, d):
    """Numbers in answers that nothing said before supports."""
    c = load(spark, d, "conversations").select("conv_id", "turn", "role", F.explode(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("n"))
    return c.where("role = 'assistant'").select("conv_id", "turn", "n").distinct().join(c.where("role <> 'assistant'").select("conv_id", "n").distinct(), ["conv_id", "n"], "left_anti")


@query("""SELECT p.url, sha256(p.html) AS digest FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages s WHERE s.page_id % 3 <> 0 AND s.url = p.url AND sha256(CASE WHEN s.page_id % 5 = 0 THEN s.html || ' ' ELSE s.html END) = sha256(p.html))""")
def incremental_skip(spark, d):
    pages = load(spark, d, "pages")
    old = pages.where("page_id % 3 <> 0").select("url", F.sha2(F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit(" "))).otherwise(F.col("html")), 256).alias("digest"))
    return quality.stale(pages.select("url", "html"), old, "url", "html")


# ---- pieces of extraction flows


@query("""SELECT n_nationkey, pair_no::INT AS pair_no, label, value FROM (
SELECT n_nationkey, 0 AS pair_no, 'name' AS label, n_name AS value FROM nation UNION ALL SELECT n_nationkey, 1, 'region', n_regionkey::VARCHAR FROM nation WHERE n_nationkey % 3 <> 0)""")
def label_values(spark, d):
    three = F.array(F.col("n_nationkey").cast("string"), F.lit("name"), F.col("n_name"))
    four = F.array(F.lit("name"), F.col("n_name"), F.lit(" region"), F.col("n_regionkey").cast("string"))
    rows = load(spark, d, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 3 == 0, three).otherwise(four).alias("cells"))
    return extraction.label_values(rows, ["n_nationkey"], "cells")


LINES_SQL = "l AS (SELECT doc_id, unnest(string_split(text, '\n')) AS line, unnest(range(len(string_split(text, '\n'))))::INT AS row_no FROM documents)"


def _doc_lines(spark, d):
    return load(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("row_no", "line"))


@query(f"""WITH {LINES_SQL}, c AS (SELECT doc_id, row_no, unnest(string_split(line, ' ')) AS cell, unnest(range(len(string_split(line, ' '))))::INT AS col_no FROM l WHERE row_no < 4),
f AS (SELECT doc_id, row_no, col_no, CASE WHEN contains(cell, 'th') THEN 'first' WHEN contains(cell, 'e') THEN 'second' END AS field FROM c)
SELECT doc_id, field, arg_min(col_no, row_no * 1000000 + col_no)::INT AS col_no FROM f WHERE field IS NOT NULL GROUP BY 1, 2""")
def header_columns(spark, d):
    cells = _doc_lines(spark, d).where("row_no < 4").select("doc_id", "row_no", F.posexplode(F.split("line", " ")).alias("col_no", "cell"))
    return extraction.header_columns(cells, ["doc_id"], "row_no", "col_no", "cell", [("th", "first"), ("e", "second")])


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY o_orderpriority[1] = min(o_orderpriority[1]) OVER (PARTITION BY o_custkey)")
def lowest_tier(spark, d):
    return extraction.lowest_tier(load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], F.substring("o_orderpriority", 1, 1)).select("o_custkey", "o_orderkey")


@query(f"""WITH {LINES_SQL}, n AS (SELECT doc_id, count(*) FILTER (contains(line, ':')) AS t, count(*) FILTER (contains(line, ',')) AS r, count(*) FILTER (regexp_matches(line, '[0-9]')) AS m FROM l GROUP BY 1)
SELECT doc_id, CASE WHEN t = 0 THEN 'no_tables' WHEN r = 0 THEN 'no_rows' WHEN m >= r + 2 THEN 'more_numbered_text' END AS reason FROM n""")
def fallback_reason(spark, d):
    counts = _doc_lines(spark, d).groupBy("doc_id").agg(*[F.count_if(F.col("line").rlike(p)).alias(n) for n, p in (("t", ":"), ("r", ","), ("m", "[0-9]"))])
    return counts.select("doc_id", extraction.fallback_reason(F.col("t"), F.col("r"), F.col("m")).alias("reason"))


@query("""WITH n AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS a, count(*) FILTER (l_quantity > 40) AS b, count(*) FILTER (l_discount >= 0.05) AS c FROM lineitem GROUP BY 1)
SELECT l_suppkey, array_to_string(list_filter([CASE WHEN a >= 20 THEN 'many returns' END, CASE WHEN c >= 30 THEN 'high discounts' END, CASE WHEN b >= 10 THEN 'large orders' END], lambda x: x IS NOT NULL)[1:2], '; ') AS phrases FROM n""")
def rule_phrases(spark, d):
    rules = [("many returns", F.col("l_returnflag") == "R", 20, 14), ("large orders", F.col("l_quantity") > 40, 10, 8), ("high discounts", F.col("l_discount") >= 0.05, 30, 9)]
    return extraction.rule_phrases(load(spark, d, "lineitem"), ["l_suppkey"], rules, 2)


@query("""WITH f AS (SELECT user_id, value > 50 AS high, event_type, min(event_id) AS seen FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, high ORDER BY seen, event_type) AS r FROM f),
l AS (SELECT user_id, high, min(seen) AS head, string_agg(event_type, '/' ORDER BY r) AS t FROM r WHERE r <= 3 GROUP BY 1, 2)
SELECT user_id, string_agg(high::VARCHAR || ':' || t, '; ' ORDER BY head) AS line FROM l GROUP BY 1""")
def grouped_tokens(spark, d):
    x = load(spark, d, "events").select("event_id", "user_id", "event_type", (F.col("value") > 50).alias("high"))
    return extraction.grouped_tokens(x, ["user_id"], "high", "event_type", ["event_id"], 3)


@query("""SELECT o_custkey, o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) <= 3""")
def first_fragments(spark, d):
    x = load(spark, d, "orders")
    have = x.where("o_totalprice > 400000").select("o_custkey").distinct()
    return extraction.first_fragments(x.select("o_custkey", "o_orderkey", "o_orderstatus"), ["o_custkey"], ["o_orderkey"], F.col("o_orderstatus") != "F", have).select("o_custkey", "o_orderkey")


@query("""SELECT doc_id, len(regexp_extract_all(text, '[0-9]+')) >= 3 AND NOT regexp_matches(text, 'good|poor|fair') AS raw_data FROM documents""")
def raw_data_reject(spark, d):
    return load(spark, d, "documents").select("doc_id", extraction.is_raw_data(F.col("text"), "[0-9]+", "good|poor|fair").alias("raw_data"))


@query("SELECT page_id, regexp_extract_all(url, '/([a-z0-9-]+)', 1)[-1] AS last_part FROM pages")
def last_match(spark, d):
    return load(spark, d, "pages").select("page_id", extraction.last_match(F.col("url"), "/([a-z0-9-]+)").alias("last_part"))


@query("""SELECT conv_id, turn, CASE WHEN regexp_matches(text, '[0-9]') THEN list_sum(list_transform(regexp_extract_all(text, '[0-9]+'), lambda x: x::HUGEINT))::BIGINT
WHEN regexp_matches(text, 'none|no ') THEN 0 END AS stated FROM conversations""")
def stated_count(spark, d):
    return load(spark, d, "conversations").select("conv_id", "turn", extraction.stated_count(F.col("text"), "none|no ").alias("stated"))


# ---- ranked picks


@query("""WITH b AS (SELECT user_id, event_type, event_id, floor(value)::BIGINT AS rank FROM events WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY floor(value), event_id) = 1)
SELECT user_id, event_type, event_id, rank FROM b QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rank, event_type) <= 3""")
def best_per_topic(spark, d):
    return ranking.best_per_topic(load(spark, d, "events"), ["user_id"], "event_type", F.floor("value"), "event_id", 3).select("user_id", "event_type", "event_id", "rank")


@query(f"""WITH {SENTENCES_SQL}, r AS (SELECT doc_id, item, item_no FROM s WHERE trim(item) <> '' QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(item) DESC, item_no) <= 4)
SELECT doc_id, md5(string_agg(item, ' | ' ORDER BY item_no)) AS summary_md5, count(*) AS n_items FROM r GROUP BY 1""")
def top_in_order(spark, d):
    items = F.filter(F.split("text", "\\. "), lambda x: F.trim(x) != "")
    x = load(spark, d, "documents").select("doc_id", ranking.top_in_order(items, F.length, 4).alias("top")).where(F.size("top") > 0)
    return x.select("doc_id", F.md5(F.array_join("top", " | ")).alias("summary_md5"), F.size("top").cast("long").alias("n_items"))


@query("""WITH c AS (SELECT o_custkey, o_orderkey, o_orderkey % 4 AS p, o_orderkey % 3 = 0 AS t, o_orderkey % 10 AS n FROM orders), k AS (SELECT * FROM c QUALIFY p = max(p) OVER (PARTITION BY o_custkey))
SELECT o_custkey, (CASE WHEN bool_and(t) THEN sum(n) ELSE min_by(n, o_orderkey) END)::BIGINT AS count FROM k GROUP BY 1""")
def leading_count(spark, d):
    x = load(spark, d, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 4).alias("p"), (F.col("o_orderkey") % 3 == 0).alias("t"), (F.col("o_orderkey") % 10).alias("n"))
    return ranking.leading_count(x, ["o_custkey"], "p", F.col("t"), "n", "o_orderkey")


@query("""WITH s AS (SELECT l_orderkey, min(l_discount * 5) AS al, max(l_discount * 5) AS ah, sum(l_discount * 5) AS s1, min(l_tax * 10) AS bl, max(l_tax * 10) AS bh, sum(l_tax * 10) AS s2, min(l_quantity) AS cl, max(l_quantity) AS ch, sum(l_quantity) AS s3 FROM lineitem GROUP BY 1),
f AS (SELECT l_orderkey, al >= 0 AND ah <= 1 AND abs(s1 - 1) <= 0.02 AS a, bl >= 0 AND bh <= 1 AND abs(s2 - 1) <= 0.02 AS b, cl >= 0 AND ch <= 1 AND abs(s3 - 1) <= 0.02 AS c, ch > 1 AND ch <= 100 AS c_score FROM s)
SELECT l_orderkey, CASE WHEN a::INT + b::INT + c::INT = 1 THEN CASE WHEN a THEN 'a' WHEN b THEN 'b' ELSE 'c' END END AS weight_column, CASE WHEN c_score THEN 'c' END AS score_column FROM f""")
def weight_and_score_columns(spark, d):
    columns = {"a": F.col("l_discount") * 5, "b": F.col("l_tax") * 10, "c": F.col("l_quantity")}
    return ranking.weight_and_score_columns(load(spark, d, "lineitem"), ["l_orderkey"], columns)


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'unresolved' WHEN c_custkey % 3 = 2 THEN 'unknown_evidence' ELSE 'accepted' END AS status FROM customer")
def judge_decisions(spark, d):
    c, n = load(spark, d, "customer"), F.col("c_nationkey").cast("long")
    candidates = c.select("c_custkey", F.array(n, n + 1).alias("allowed"))
    decisions = c.where("c_custkey % 5 <> 0").select("c_custkey", F.array(n, n + F.col("c_custkey") % 3).alias("evidence"))
    return quality.judge_decisions(candidates, decisions, "c_custkey", "allowed", "evidence")


@query("""WITH t AS (SELECT conv_id, turn, role, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}]+')) AS token FROM conversations)
SELECT DISTINCT conv_id, turn, token FROM t WHERE role = 'assistant' AND NOT EXISTS (SELECT 1 FROM t u WHERE u.role = 'user' AND u.conv_id = t.conv_id AND u.token = t.token)""")
def unsupported_tokens(spark, d):
    c = load(spark, d, "conversations")
    said = c.where("role = 'assistant'").select("conv_id", "turn", "text")
    return quality.unsupported_tokens(said, c.where("role = 'user'"), ["conv_id"], "text", "[\\p{L}\\p{N}]+", "token").select("conv_id", "turn", "token")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN year(e) || '年' || month(e) || '月' || day(e) || '日' END AS day
FROM (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::DATE + 9 ELSE o_orderdate::DATE END AS e FROM orders)""")
def normal_date(spark, d):
    day = F.to_date("o_orderdate")
    one, end = F.date_format(day, "yyyy-MM-dd"), F.date_format(F.date_add(day, 9), "yyyy年MM月dd日")
    stated = F.when(F.col("o_orderkey") % 7 == 0, "none").when(F.col("o_orderkey") % 2 == 0, F.concat(one, F.lit(" - "), end)).otherwise(one)
    return load(spark, d, "orders").select("o_orderkey", text.normal_date(stated).alias("day"))
