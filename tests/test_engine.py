"""Operators on small frames, the DOCX source, streaming, and the registered queries against DuckDB."""

from __future__ import annotations

import io
import unicodedata
import zipfile

import pytest
from pyspark.sql import functions as F

from brindle.functions import classify, text
from brindle.operators import extraction, matching, quality, ranking, selection, sequence
from brindle.plans import catalogue
from brindle.sources import docx, records

ODD = ["", None, "  ", "　", "\xa0x", "ＡＢ１２", "87.060", "100.00", "-0.0", ".5", "5.", "+1", "1e3", "NaN", "ß", "İ", "桥", "桥梁", "桥梁面", "桥a梁b", "a-b_c.d", "!?", "😀", "a\n\tb", "007", "-.50"]


def plain_normal(x):
    import re
    from decimal import Decimal

    t = "".join(unicodedata.normalize("NFKC", x or "").casefold().split())
    if not re.fullmatch(r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)", t):
        return t
    n = format(Decimal(t), "f")
    if "." in n:
        n = n.rstrip("0").rstrip(".")
    return n.lstrip("+") or "0"


def test_normalize_text(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ODD)], "i int, x string")
    got = {r.i: r.n for r in df.select("i", text.normalize_text(F.col("x")).alias("n")).collect()}
    for i, x in enumerate(ODD):
        assert got[i] == plain_normal(x), x


def test_fact_tokens(spark):
    df = spark.createDataFrame([("桥梁面a-b_c.d", 1), ("桥", 2), ("!?", 3), ("", 4)], "x string, i int")
    got = [r[0] for r in df.orderBy("i").select(text.fact_tokens(F.col("x"))).collect()]
    assert got[0][:2] == ["桥梁", "梁面"] and got[0][2:] == ["a-b_c.d"]
    assert got[1:] == [["桥"], ["!?"], []]


@pytest.mark.parametrize("score, band", [("90", "A"), ("89.99", "B"), ("80", "B"), ("79.9", "C"), ("70", "C"), ("60", "D"), ("59.999", "E"), (None, None)])
def test_grades(spark, score, band):
    df = spark.createDataFrame([(score,)], "s string").select(text.grade(F.col("s").cast("decimal(18,6)")).alias("g"))
    assert df.first().g == band


def test_longest_keyword(spark):
    df = spark.createDataFrame([("ab abc",), ("ab",), ("zz",), (None,)], "x string")
    got = [r[0] for r in df.select(classify.longest_keyword(F.col("x"), [("ab", "short"), ("abc", "long"), ("xyz", "other")])).collect()]
    assert got == ["long", "short", None, None]


def test_forward_fill_before_filter(spark):
    rows = [(1, "a", True), (2, "b", False), (3, None, True)]
    df = spark.createDataFrame(rows, "i int, v string, ok boolean").withColumn("t", F.lit(1))
    assert [r.v for r in sequence.forward_fill(df, ["t"], ["i"], ["v"]).where("ok").orderBy("i").collect()] == ["a", "b"]


def test_section_intervals(spark):
    levels = [1, None, 2, None, 3, 2, None, 1, None]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(levels)], "d string, i int, level int")
    got = {r.start_block: r.end_block for r in sequence.section_intervals(df, ["d"], "i", "level", 3).collect()}
    assert got == {0: 7, 2: 5, 4: 5, 5: 7, 7: 9}


def test_multiset_match_is_metamorphic(spark):
    gold = spark.createDataFrame([("a", 1)] * 3 + [("b", 2)], "k string, v int")
    of = lambda p: matching.multiset_match(gold.withColumn("s", F.lit(1)), p.withColumn("s", F.lit(1)), ["s", "k", "v"], ["s"]).first()
    assert of(gold)[1:] == (4, 0, 0)
    assert of(gold.where("k = 'b'"))[1:] == (1, 0, 3)
    assert of(gold.unionByName(gold.limit(1)))[1:] == (4, 1, 0)


def test_metrics_of_nothing(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 0, 2), (1, 1, 1)], "tp int, fp int, fn int")
    got = [tuple(r) for r in df.select(*matching.metrics(F.col("tp"), F.col("fp"), F.col("fn"))).collect()]
    assert got == [(1.0, 1.0, 1.0), (1.0, 0.0, 0.0), (0.5, 0.5, 0.5)]


def test_greedy_pairs(spark):
    rows = [(1, 0, 0, 0.9), (1, 0, 1, 0.8), (1, 1, 0, 0.85), (1, 1, 1, 0.1), (2, 5, 5, 0.5)]
    df = spark.createDataFrame(rows, "s int, g long, p long, f double")
    got = {tuple(r) for r in matching.greedy_pairs(df, "s", "g", "p", [-F.col("f"), F.col("g"), F.col("p")]).collect()}
    assert got == {(1, 0, 0), (1, 1, 1), (2, 5, 5)}


def test_containment_is_greedy_not_transitive(spark):
    df = spark.createDataFrame([(["abcdefgh", "xx abcdefgh yy", "abcdefgh", "short", "shor", "xx abcdefg"],)], "xs array<string>")
    assert df.select(selection.containment_fold(F.col("xs"), 8)).first()[0] == ["abcdefgh", "short", "shor", "xx abcdefg"]


def test_budget_fold(spark):
    df = spark.createDataFrame([(["a" * 30, "b" * 30, "c" * 30, "d"],)], "xs array<string>")
    got = df.select(selection.budget_fold(F.col("xs"), 80, 25, 10, 4)).first()[0]
    assert got == ["a" * 25, "b" * 25, "c" * 25, "d"]
    assert df.select(selection.budget_fold(F.col("xs"), 60, 40, 20, 4)).first()[0] == ["a" * 30, "b" * 30]


def test_alignment_fails_closed(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("x",), ("x",)], "k string")
    assert {r.k: r.status for r in matching.align_unique(a, b, "k").collect()} == {"x": "ambiguous", "y": "missing"}
    with pytest.raises(Exception, match="not aligned"):
        matching.align_unique(a, b, "k", strict=True).collect()


def test_containing(spark):
    texts = spark.createDataFrame([(1, "a b c d e"), (2, "b c"), (3, "ab cd"), (4, None)], "i int, t string")
    needles = spark.createDataFrame([(1, "b c"), (2, "a b c d e"), (3, "e"), (4, "")], "n int, x string")
    assert sorted(map(tuple, matching.containing(texts, needles, "i", "t", "n", "x", words=2).collect())) == [(1, 1), (1, 2), (1, 3), (2, 1)]


def test_flags(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "i int, v int")
    assert {tuple(r) for r in quality.flags(df, ["i"], [("big", F.col("v") > 3), ("none", F.col("v").isNull())]).collect()} == {(1, "big"), (2, "none")}


W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'


def make_docx(body: str, styles: str = "") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        if styles:
            z.writestr("word/styles.xml", f"<w:styles {W}>{styles}</w:styles>")
    return out.getvalue()


def test_docx(spark, tmp_path):
    p = lambda t, s="": f"<w:p>{f'<w:pPr><w:pStyle w:val={chr(34)}{s}{chr(34)}/></w:pPr>' if s else ''}<w:r><w:t>{t}</w:t></w:r></w:p>"
    c = lambda t, x="": f"<w:tc><w:tcPr>{x}</w:tcPr>{p(t)}</w:tc>"
    table = f"<w:tbl><w:tr>{c('a', '<w:gridSpan w:val=\"2\"/>')}{c('b', '<w:vMerge w:val=\"restart\"/>')}</w:tr><w:tr>{c('c')}{c('d')}{c('', '<w:vMerge/>')}</w:tr></w:tbl>"
    styles = '<w:style w:styleId="H"><w:name w:val="heading 2"/></w:style>'
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.docx").write_bytes(make_docx(p("Title", "H") + table + p("end"), styles))
    (tmp_path / "bad.docx").write_bytes(b"not a zip")
    blocks = docx.read_blocks(spark, str(tmp_path))
    ok = blocks.where("status = 'succeeded'").orderBy("block_index").collect()
    assert [(b.kind, b.raw_text, b.heading_level) for b in ok] == [("paragraph", "Title", 2), ("table", "a\tb\nc\td\t", None), ("paragraph", "end", None)]
    assert blocks.where("status = 'failed'").count() == 1
    got = {(x.row_index, x.column_index): (x.column_span, x.row_span, x.is_cont, x.origin_row) for x in docx.cells(blocks).collect()}
    assert got == {(0, 0): (2, 1, False, 0), (0, 2): (1, 2, False, 0), (1, 0): (1, 1, False, 1), (1, 1): (1, 1, False, 1), (1, 2): (1, 1, True, 0)}


def test_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"records": [{"b": 1, "a": 2}, {"b": 3, "a": 4}]}')
    df = records.read_records(spark, str(tmp_path / "a.json"), multi_line=True)
    assert {(r.a, r.b) for r in df.collect()} == {(2, 1), (4, 3)}
    records.write_records(df, str(tmp_path / "out"))
    assert records.read_records(spark, str(tmp_path / "out")).count() == 2
    (tmp_path / "m.csv").write_text("sample_id\nx\nx\n")
    with pytest.raises(ValueError, match="repeated"):
        records.read_manifest(spark, str(tmp_path / "m.csv"), "csv")
    with pytest.raises(ValueError):
        records.validate_weights({"a": 50, "b": 49})


def test_incremental_stream(spark, tmp_path):
    from brindle.streaming.incremental import run_incrementally

    src, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    flow = lambda b: b.withColumn("y", F.col("id") * 2)
    spark.range(5).write.mode("append").parquet(src)
    run_incrementally(spark, src, "id long", flow, out, mark)
    spark.range(5, 8).write.mode("append").parquet(src)
    run_incrementally(spark, src, "id long", flow, out, mark)
    run_incrementally(spark, src, "id long", flow, out, mark)
    assert sorted(r.y for r in spark.read.parquet(out).collect()) == [2 * i for i in range(8)]


def test_extraction_pieces(spark):
    rows = spark.createDataFrame([(1, ["1", "name", "x"]), (2, ["a", "b", " c "]), (3, ["a", "1", "b", None]), (4, ["a"]), (5, ["", "v"]), (6, []), (7, None)], "id int, cells array<string>")
    got = sorted(tuple(r) for r in extraction.label_values(rows, ["id"], "cells").collect())
    assert got == [(1, 0, "name", "x"), (2, 0, "b", "c"), (3, 0, "a", "1"), (3, 1, "b", ""), (4, 0, "a", "")]

    cells = spark.createDataFrame([(1, 0, 0, "site"), (1, 1, 1, "where"), (1, 1, 2, "what"), (1, 5, 3, "state"), (2, 0, 0, None), (2, 0, 1, "what")], "t int, r int, c int, x string")
    heads = extraction.header_columns(cells, ["t"], "r", "c", "x", [("site", "place"), ("where", "place"), ("what", "kind"), ("state", "state")])
    assert sorted(tuple(r) for r in heads.collect()) == [(1, "kind", 2), (1, "place", 0), (2, "kind", 1)]
    assert [r.t for r in extraction.complete_tables(heads, ["t"], ["place", "kind"]).collect()] == [1]

    one = spark.createDataFrame([("main 87.5 then ramp none, main 60; ramp 70",), ("nothing",), (None,)], "x string")
    assert [r.m for r in one.select(extraction.split_scopes(F.col("x"), ["main", "ramp"], "([0-9.]+)").alias("m")).collect()] == [{"main": "87.5", "ramp": "70"}, {}, None]
    assert [r.n for r in one.select(extraction.stated_count(F.col("x"), "nothing").alias("n")).collect()] == [87 + 5 + 60 + 70, 0, None]
    maps = one.limit(1).select(extraction.overlay(F.expr("map('a', '1', 'b', '2')"), F.expr("map('a', '9', 'b', ' ', 'c', '3')"), ["a", "b"]).alias("m"), extraction.overlay(F.expr("map('a', '1')"), F.expr("cast(null as map<string,string>)"), ["a"]).alias("k")).first()
    assert maps.m == {"a": "9", "b": "2"}
    assert maps.k == {"a": "1"}


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, sf_dir, name):
    import duckdb

    df = catalogue.QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    assert len(set(df.columns)) == len(df.columns)
    if name not in catalogue.ORACLE_SQL:
        assert got
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql(catalogue.ORACLE_SQL[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    shape = lambda rows, cols: sorted(repr([r[cols.index(c)] for c in order]) for r in rows)
    assert shape(got, df.columns) == shape(want.fetchall(), want.columns)


def test_ranked_picks_edges(spark):
    items = spark.createDataFrame([(1, ["aa", "b", "cc", "d"]), (2, []), (3, None)], "id int, items array<string>")
    got = {r.id: r.top for r in items.select("id", ranking.top_in_order(F.col("items"), F.length, 2).alias("top")).collect()}
    assert got == {1: ["aa", "cc"], 2: [], 3: None}
    dates = spark.createDataFrame([("2024年03月05日",), ("2024.3.1 - 2024.03.10",), ("none",), (None,)], "d string")
    assert [r[0] for r in dates.select(text.normal_date(F.col("d"))).collect()] == ["2024年3月5日", "2024年3月10日", None, None]
    rows = spark.createDataFrame([(1, "t", None, 1), (1, "t", 3, 2), (1, "t", 3, 1)], "k int, topic string, r int, id int")
    assert [tuple(r) for r in ranking.best_per_topic(rows, ["k"], "topic", F.col("r"), "id", 3).collect()] == [(1, "t", 1, 3)]
    assert ranking.leading_count(rows.limit(0), ["k"], "r", F.lit(True), "id", "id").count() == 0
