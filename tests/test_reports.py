"""Report rules, sections, scores, retrieval and the flows from documents to records."""

from __future__ import annotations

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from brindle.functions import reports as R
from brindle.operators import defects, quality, retrieval, routing, scoring, summary
from brindle.plans import flows
from brindle.sources import docx

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def one(spark, column, **values):
    """What a column expression gives over one row of texts."""
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("out")).first().out


@pytest.mark.parametrize(
    "rule, text, want",
    [
        (R.title_key, " 3.2.1 病害 明细表：", "病害明细表:"), (R.title_key, "（三）检测结论", "检测结论"), (R.title_key, "第二章评分", "评分"), (R.title_key, None, ""),
        (R.name_key, "东湖大桥 检测报告报告", "东湖大桥"), (R.name_key, "A-1桥的信息提取报告", "a1桥"), (R.name_key, "", ""),
        (R.description, "裂缝L=2m（单位：mm）", "裂缝L=2m"), (R.description, "锈蚀，见照片3-12", "锈蚀"), (R.description, "渗水。", "渗水"),
        (R.defect_type, "裂缝/渗水,露筋", "裂缝、渗水、露筋"), (R.item_text, "（2）清理排水孔", "清理排水孔"), (R.item_text, "12月检查", "12月检查"),
        (R.trend, "上部结构:新增病害:裂缝,渗水;下部结构：新增病害：无", "上部结构：新增裂缝、渗水；下部结构：无新增病害"), (R.trend, "暂无", "暂无"), (R.trend, None, ""),
        (R.inferred_category, "立即修复护栏", "立即处置"), (R.inferred_category, "清理堵塞的排水孔", "尽快维修"), (R.inferred_category, "日常养护维修", "预防性养护"), (R.inferred_category, "封闭裂缝并定期观测", "尽快维修"), (R.inferred_category, "限制通行", None),
        (R.safety_topic, "行车安全", "通行安全"), (R.safety_topic, "其他", "结构安全"),
        (R.overall_conclusion, "桥梁总体良好。建议维修。目录。主梁裂缝,建议修补。", "桥梁总体良好；主梁裂缝"), (R.overall_conclusion, None, ""),
        (R.risk_points, "栏杆缺失危及行人安全。由于渗水锈蚀。桥台沉降。", "栏杆缺失危及行人安全"), (R.risk_points, "桥台沉降。", "桥台沉降"),
    ],
)
def test_text_rules(spark, rule, text, want):
    assert one(spark, rule(F.col("x")), x=text) == want


def test_budget_cuts_and_stops(spark):
    df = spark.createDataFrame([(["a" * 200, "b" * 60, "c" * 60, "d"],), ([],), (["a" * 170, "b" * 40, "x" * 50],)], "xs array<string>")
    got = [r.out for r in df.select(R.budget(F.col("xs"), 180, 250, 24, 4).alias("out")).collect()]
    assert [[len(x) for x in r] for r in got] == [[180, 60], [], [170, 40, 38]]


def test_categories(spark):
    r = R.resolved_category(F.col("h"), F.col("c"))
    assert one(spark, r["category"], h="预防性养护", c="修补裂缝") == "尽快维修"
    assert one(spark, r["unresolved"], h="预防性养护、尽快维修", c="x") is True
    assert one(spark, R.settled_category(F.col("h"), F.col("c")), h="立即维修", c="") == "立即处置"
    assert one(spark, R.settled_category(F.col("h"), F.col("c")), h=None, c=None) == "预防性养护"
    assert one(spark, R.facility(F.col("h"))["type"], h="南 门人行天桥") == "pedestrian_overpass"
    assert one(spark, R.same_path(F.col("a"), F.col("b")), a="x/y.docx", b="y.docx") is True
    assert one(spark, R.same_path(F.col("a"), F.col("b")), a="xy.docx", b="y.docx") is False


BLOCKS = "doc long, pos long, is_table boolean, text string, heading_level int, style string"


def test_sections(spark):
    rows = [(1, 0, False, "封面", None, None), (1, 1, False, "1 检测结论", 1, None), (1, 2, False, "总体良好", None, None), (1, 3, False, "1.1 病害明细表", 2, None), (1, 4, True, "病害部位 病害类型", None, None), (1, 5, False, "2 处理建议", None, "Heading 1"), (1, 6, False, "建议表", None, None), (1, 7, True, "总体评分 等级", None, None), (2, 0, False, "无关", None, None)]
    blocks = routing.candidates(spark.createDataFrame(rows, BLOCKS))
    got = {(r.category, r.start): r.end for r in routing.route_sections(blocks, ["doc"], "pos").collect()}
    assert got == {("inspection_conclusion", 1): 5, ("defect_table", 3): 5, ("treatment_recommendations", 5): 6, ("recommendations", 6): 8, ("scoring", 7): 8}
    inside = {r.pos: r.categories for r in routing.block_categories(blocks, routing.route_sections(blocks, ["doc"], "pos"), ["doc"], "pos").where("doc = 1").collect()}
    assert inside[2] == ["inspection_conclusion"] and inside[4] == ["defect_table", "inspection_conclusion"] and inside[0] == []
    assert routing.route_sections(blocks.where("1 = 0"), ["doc"], "pos").count() == 0


def test_text_window_is_exact(spark):
    rows = [(1, 0, "甲 起点 乙"), (1, 1, "丙 起点 丁"), (1, 2, "戊 终点 己"), (2, 0, "无"), (3, 0, "起点 a 终点 b 起点 c")]
    got = {r.doc: r.text for r in routing.text_window(spark.createDataFrame(rows, "doc long, pos long, t string"), ["doc"], "pos", "t", "起点", "终点").collect()}
    assert got == {1: " 丁\n戊 ", 3: " c"}


def test_rows_pair_in_order(spark):
    fields = ["location", "defect_type", "description"]
    gold = spark.createDataFrame([(1, 0, "1", "梁", "裂缝", "a"), (1, 1, "2", "墩", "渗水", "b"), (1, 2, "3", "台", "x", "y"), (2, 0, "1", "梁", "裂缝", "a")], "s long, no long, index string, location string, defect_type string, description string")
    pred = spark.createDataFrame([(1, 0, "9", "裂缝", "梁", "a"), (1, 1, "2", "墩", "渗水", "c"), (1, 2, "2", "墩", "渗水", "c"), (3, 0, "1", "q", "r", "t")], gold.schema)
    pairs = scoring.pair_rows(gold, pred, "s", "no", "index", fields)
    assert {(r.s, r.gold_no, r.predicted_no, r.ambiguous) for r in pairs.collect()} == {(1, 0, 0, False), (1, 1, 1, True), (1, 2, None, False), (1, None, 2, False), (2, 0, None, False), (3, None, 0, False)}
    status = {(r.gold_no, r.field): r.status for r in scoring.field_statuses(pairs, "s", fields).where("s = 1 AND gold_no IS NOT NULL").collect()}
    assert status[(0, "location")] == "wrong_column" and status[(0, "description")] == "matched" and status[(1, "description")] == "description_difference" and status[(2, "location")] == "missing"
    counts = {r.s: (r.tp, r.fp, r.fn, r.ambiguous) for r in scoring.row_counts(pairs, "s").collect()}
    assert counts == {1: (0, 3, 3, 1), 2: (0, 0, 1, 0), 3: (0, 1, 0, 0)}


def test_fact_counts(spark):
    g = spark.createDataFrame([(1, 0, "主梁裂缝"), (1, 1, "good state"), (2, 0, "x")], "s long, i long, t string")
    p = spark.createDataFrame([(1, 0, "主梁裂缝多"), (1, 1, "other"), (3, 0, "y")], "s long, i long, t string")
    got = {r.s: (r.tp, r.fp, r.fn) for r in scoring.fact_counts(g, p, ["s"], "i", "t").collect()}
    assert got == {1: (3, 2, 1), 2: (0, 0, 1), 3: (0, 1, 0)}


def test_alignment(spark):
    s = lambda xs: spark.createDataFrame(xs, "id string, p string")
    got = {r.id: r.status for r in scoring.align_paths(s([("a", "./x/1.docx"), ("b", "2.docx"), ("c", "3.docx"), ("d", "y/1.docx")]), s([("", "r/x/1.docx"), ("", "q/2.docx"), ("", "w/2.docx")]).select(F.col("p").alias("f")), "id", "p", "f").collect()}
    assert got == {"a": "aligned", "b": "ambiguous", "c": "missing", "d": "missing"}
    with pytest.raises(Exception, match="duplicate id"):
        scoring.align_records(s([("a", "1"), ("a", "2")]), s([("a", "1")]), "id", "p").collect()
    by_place = scoring.align_records(s([(None, "1"), ("b", "2")]), s([("x", "1")]), "id", "p").collect()
    assert sorted((r.status, r.predicted_key) for r in by_place) == [("aligned", "x"), ("missing", None)]


def test_retrieval(spark):
    index = spark.createDataFrame([(1, "label", [1.0, 0.0]), (2, "knowledge", [0.9, 0.1]), (3, "label", [0.0, 0.0]), (4, "knowledge", [0.0, 1.0])], "entry_id long, kind string, embedding array<double>")
    q = spark.createDataFrame([(9, [2.0, 0.0])], "query_id long, query_embedding array<double>")
    assert [r.entry_id for r in retrieval.retrieve(index, q, top_k=2).orderBy("rank").collect()] == [1, 2]
    assert [r.entry_id for r in retrieval.retrieve(index, q, quotas={"knowledge": 1, "label": 2}).orderBy("rank").collect()] == [2, 1, 3]
    again = spark.createDataFrame([(9, 2, 0.5, 0), (9, 1, 0.5, 1), (9, 4, 0.9, 2)], "query_id long, entry_id long, rerank_score double, place long")
    assert [r.entry_id for r in retrieval.retrieve(index, q, top_rerank=2, reranked=again).orderBy("rank").collect()] == [2, 1]
    assert retrieval.retrieve(index, q, top_k=0).count() == 0
    with pytest.raises(Exception, match="dimension"):
        retrieval.retrieve(index, spark.createDataFrame([(9, [1.0])], q.schema)).collect()


def test_gate_and_reuse(spark):
    r = spark.createDataFrame([(1, "a", "b", "维修", "x", ["综上，报告建议"], [], ["满足要求，但影响承载"], 1, 0), (2, None, None, None, None, None, None, None, 0, 0)], "id long, recommendations_summary string, expected_summary string, overall_conclusion string, risk_points string, detailed array<string>, causes array<string>, safety array<string>, n_rows long, n_blank long")
    got = sorted(x.code for x in quality.consistency_issues(r, ["id"]).collect())
    assert got == ["detailed_conclusion_contains_recommendation", "generic_composer_marker", "overall_conclusion_contains_action", "recommendation_summary_mismatch", "safety_conclusion_conflict"]
    e = spark.createDataFrame([(1, "a"), (2, "b")], "entry_id long, text string")
    old = e.withColumn("embedding", F.array(F.lit(1.0)))
    assert all(x.embedding for x in retrieval.reusable(e, old).collect())
    assert not any(x.embedding for x in retrieval.reusable(e.withColumn("text", F.when(F.col("entry_id") == 1, "z").otherwise(F.col("text"))), old).collect())


def test_duplicates_grow(spark):
    rows = [(1, 1, "对主梁裂缝进行灌浆处理", "梁", ""), (1, 2, "主梁裂缝进行灌浆处理并观测", "主梁", "尽快维修"), (1, 3, "加强观测", "", ""), (1, 4, "加强观测。", "墩", "")]
    got = {r.no: (r.c, r.l, r.g) for r in defects.distinct_recommendations(spark.createDataFrame(rows, "d long, no long, c string, l string, g string"), ["d"], ["no"], "c", "l", "g").collect()}
    assert got == {1: ("主梁裂缝进行灌浆处理并观测", "主梁", "尽快维修"), 3: ("加强观测。", "墩", "")}


def test_labels(spark):
    df = spark.createDataFrame([(1, "桥梁名称：东湖大桥 桥梁编号：；总体评分（分）为87.5，总体等级：B级"), (2, "无标签"), (3, None)], "id long, t string")
    got = [(r.field, r.value) for r in summary.labelled_values(df, ["id"], "t").orderBy("place").collect()]
    assert got == [("bridge_name", "东湖大桥"), ("bridge_id", ""), ("overall_score", "87.5"), ("overall_grade", "B级")]


# ---- documents


def paragraph(text: str, style: str = "") -> str:
    return f'<w:p>{f"""<w:pPr><w:pStyle w:val="{style}"/></w:pPr>""" if style else ""}<w:r><w:t>{text}</w:t></w:r></w:p>'


def grid(rows: list[list[str]]) -> str:
    return "<w:tbl>" + "".join("<w:tr>" + "".join(f"<w:tc>{paragraph(c)}</w:tc>" for c in r) + "</w:tr>" for r in rows) + "</w:tbl>"


def package(body: str | None, styles: str = "", rels: str = "") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{W}" xmlns:a="http://a" xmlns:r="http://r" xmlns:wp="http://wp">' + (f"<w:body>{body}</w:body>" if body is not None else "") + "</w:document>")
        z.writestr("word/styles.xml", f'<w:styles xmlns:w="{W}">{styles}</w:styles>')
        z.writestr("word/_rels/document.xml.rels", f"<Relationships>{rels}</Relationships>")
    return out.getvalue()


STYLES = (
    '<w:style w:type="paragraph" w:styleId="H1"><w:name w:val="heading 1"/></w:style><w:style w:type="paragraph" w:styleId="C2"><w:name w:val="Custom Heading 2"/></w:style>'
    '<w:style w:type="character" w:styleId="X1"><w:name w:val="heading 3"/></w:style><w:style w:type="paragraph" w:styleId="O4"><w:pPr><w:outlineLvl w:val="3"/></w:pPr></w:style>'
)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("reports")
    table = grid([["序号", "病害部位", "病害类型", "病害描述"], ["1", "主梁", "裂缝", "左侧裂缝L=2m，见图1"], ["", "", "", "渗水泛碱"], ["序号", "病害部位", "病害类型", "病害描述"], ["2", "桥墩", "露筋", "露筋锈蚀"], ["", "", "", "无"], ["2", "桥墩", "露筋", "露筋锈蚀"]])
    body = paragraph("桥梁名称：东湖大桥") + paragraph("1 概述", "H1") + paragraph("报告日期：2021年3月5日，总体评分：87.5") + grid([["总体等级", "B级"], ["桥梁编号", "D-12"]])
    body += paragraph("2 病害明细表", "H1") + table + paragraph("3 检测结论", "H1") + paragraph("桥梁总体技术状况为B级") + paragraph("栏杆缺失危及行人安全，建议维修") + paragraph("4 处理建议", "H1") + paragraph("1、立即修复栏杆") + paragraph("并设置警示") + paragraph("2、加强日常观测")
    (root / "a（现C）.docx").write_bytes(package(body, STYLES))
    (root / "empty.docx").write_bytes(package("", STYLES))
    (root / "nobody.docx").write_bytes(package(None))
    (root / "bad.docx").write_bytes(b"no zip")
    picture = '<w:p><w:r><w:t>图</w:t><wp:docPr name="n" descr="d"/><a:blip r:embed="r1"/><a:blip r:embed="r1"/><a:blip r:embed="r9"/></w:r></w:p>'
    rel = '<Relationship Id="r1" Type="http://x/image" Target="media/1.png"/><Relationship Id="r9" Type="http://x/link" Target="z"/>'
    (root / "pictures.docx").write_bytes(package(picture + "<w:tbl><w:tr><w:tc><w:p/></w:tc><w:tc>" + picture + "</w:tc></w:tr></w:tbl>" + paragraph("t", "C2") + paragraph("u", "X1") + paragraph("v", "O4"), STYLES, rel))
    return str(root)


def test_documents(spark, folder):
    blocks = docx.read_blocks(spark, folder).withColumn("f", F.element_at(F.split("source_file", "/"), -1)).cache()
    by = {(r.f, r.status, r.error) for r in blocks.collect() if r.f in ("empty.docx", "nobody.docx", "bad.docx")}
    assert by == {("empty.docx", "succeeded", None), ("nobody.docx", "failed", "ValueError"), ("bad.docx", "failed", "BadZipFile")}
    levels = {r.style_id: r.heading_level for r in blocks.where("f = 'pictures.docx' AND style_id IS NOT NULL").collect()}
    assert levels == {"C2": 2, "X1": None, "O4": 4}
    found = [(r.block_index, r.target, r.name, r.description, r.in_row, r.in_column) for r in docx.images(blocks.where("f = 'pictures.docx'")).orderBy("block_index").collect()]
    assert found == [(0, "media/1.png", "n", "d", None, None), (1, "media/1.png", "n", "d", 0, 1)]


def test_records(spark, folder):
    got = {r.source_file.rsplit("/", 1)[-1]: r for r in flows.records(docx.read_blocks(spark, folder)).collect()}
    assert len(got) == 5 and got["bad.docx"].status == "failed" and got["empty.docx"].status == "succeeded" and not got["empty.docx"].defects
    r = next(v for k, v in got.items() if v.defects)
    assert {k: r.summary[k] for k in ("bridge_name", "report_date", "overall_score", "overall_grade", "bridge_id")} == {"bridge_name": "东湖大桥", "report_date": "2021年3月5日", "overall_score": "87.5", "overall_grade": "B级", "bridge_id": "D-12"}
    assert [(d["index"], d.location, d.defect_type, d.description) for d in r.defects] == [("1", "左侧主梁", "裂缝", "左侧裂缝L=2m"), ("1", "主梁", "裂缝", "渗水泛碱"), ("2", "桥墩", "露筋", "露筋锈蚀")]
    assert [(x["index"], x.category, x.content) for x in r.recommendations] == [(1, "立即处置", "立即修复栏杆并设置警示"), (2, "预防性养护", "加强日常观测")]
    assert r.summary["recommendations_summary"] == "1条立即处置、0条尽快维修、1条预防性养护"
    assert r.summary["overall_conclusion"].startswith("桥梁总体技术状况为B级") and "建议" not in r.summary["overall_conclusion"]
    assert r.summary["risk_points"] == "栏杆缺失危及行人安全"
    assert {s.kind for s in r.statements} >= {"detailed"}


def test_audits(spark):
    from brindle.operators import audit

    df = spark.createDataFrame([(1, "如下：1、甲；2、乙1.5m。"), (2, None), (3, "无编号"), (4, "①丙②丁")], "id long, t string")
    assert sorted((r.id, r.place, r.item) for r in audit.split_numbered(df, ["id"], "t").collect()) == [(1, 0, "甲"), (1, 1, "乙1.5m"), (3, 0, "无编号"), (4, 0, "丙②丁")]
    c = spark.createDataFrame([(1, "a", "x", "table", 1), (1, "a", "y", "text", 1), (1, "b", "无", "text", 2), (1, "c", "无", "text", None), (1, "d", "x", "text", 1), (1, "d", "y", "text", 1)], "id long, field string, value string, kind string, anchor long")
    got = {r.field: r.state for r in audit.audit_states(c, c.select("id").distinct(), ["id"], ["a", "b", "c", "d", "e"], ["table"]).collect()}
    assert got == {"a": "extracted", "b": "explicit_none", "c": "missing", "d": "ambiguous", "e": "missing"}
    s = lambda xs: spark.createDataFrame([(x,) for x in xs], "name string")
    assert {(r.name, r.issue) for r in audit.name_check(s(["a.docx", "b.docx"]), s(["a.docx", "a.docx", "../c.pdf"]), "name", ".docx").collect()} == {("a.docx", "duplicate"), ("b.docx", "missing"), ("../c.pdf", "unexpected"), ("../c.pdf", "ending"), ("../c.pdf", "unsafe")}
