"""From documents to records: the flows that tie sections, tables and texts together.

Each takes blocks as ``brindle.sources.docx.read_blocks`` gives them and returns one table; ``records`` joins them to one
row a document.  A document is the unit of work, so all joins are on its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brindle.functions import reports as R
from brindle.functions import vocabulary as V
from brindle.operators import defects, routing, sequence, summary

DOC = ["source_file"]
SUMMARY_FIELDS = ("bridge_name", "bridge_id", "report_date", "inspection_date", "overall_score", "overall_grade")
#: Priority of a candidate's place: file name least, then running text, the cover, and tables.
PRIORITY = {"table": 300, "cover": 200, "paragraph": 100, "filename": 10}


def prepared(blocks: DataFrame) -> DataFrame:
    """Blocks of documents that could be read, with their level, the section they open, and the sections they lie in."""
    read = blocks.where("status = 'succeeded' AND block_index IS NOT NULL").select("source_file", "block_index", (F.col("kind") == "table").alias("is_table"), F.coalesce("raw_text", F.lit("")).alias("text"), "heading_level", F.col("style_id").alias("style"), "cells")
    x = routing.cover(routing.candidates(read), DOC, "block_index")
    return routing.block_categories(x, routing.route_sections(x, DOC, "block_index"), DOC, "block_index")


def _lined(prepared_: DataFrame) -> DataFrame:
    return prepared_.where("is_table").select("source_file", "block_index", "categories", F.inline("cells"))


def extract_defects(prepared_: DataFrame) -> DataFrame:
    """(source_file, index, location, defect_type, description, is_new, previous_status, development, block_index, row_index).

    Tables in sections of defects that have their headers, else any such table.  Blank numbers, places and types come from
    the row above, over repeated headers; rows that hold no defect go afterwards; repeats are merged and blank numbers filled.
    """
    cells = _lined(prepared_).withColumnRenamed("raw_text", "cell")
    table = ["source_file", "block_index"]
    heads = defects.header_rows(cells, table, "row_index", "column_index", "cell")
    known = heads.groupBy(*table).agg(F.array_contains(F.collect_set("field"), "description").alias("looks"))
    tables = cells.select(*table, F.array_contains("categories", "defect_table").alias("routed")).distinct().join(known, table, "left").withColumn("looks", F.coalesce("looks", F.lit(False)))
    chosen = defects.located_tables(tables, DOC, "routed", "looks").select(*table)
    cells, heads = cells.join(chosen, table, "left_semi"), heads.join(chosen, table, "left_semi")
    fields = [f for f, _ in V.DEFECT_HEADERS]
    rows = defects.carried_columns(cells, heads, table, "row_index", "column_index", "column_span", "cell").groupBy(*table, "row_index").pivot("field", fields).agg(F.first("cell"))
    rows = rows.select(*table, "row_index", *[F.nullif(F.trim(f), F.lit("")).alias(f) for f in fields])
    rows = rows.withColumn("own", F.array_compact(F.array(*fields)))
    rows = sequence.forward_fill(rows, table, ["row_index"], ["index", "location", "defect_type"]).fillna("", fields)
    no = F.lit(False)
    valid = rows.where(defects.row_issue(F.col("index"), F.col("location"), F.col("defect_type"), F.col("description"), no, no, F.col("own")).isNull()).drop("own")
    sided = valid.withColumn("location", defects.with_side(F.col("location"), F.col("description"), F.lit("")))
    at = F.struct("block_index", "row_index")
    kept = defects.distinct_observations(sided.withColumn("anchor", at), DOC, ["block_index", "row_index"], "location", "defect_type", "description", "anchor")
    out = sided.drop("location", "defect_type", "description").join(kept.drop("anchor"), [*DOC, "block_index", "row_index"])
    out = out.withColumns({"defect_type": R.defect_type(F.col("defect_type")), "description": R.description(F.col("description"))})
    return defects.numbered(out, DOC, ["block_index", "row_index"], "index").select("source_file", *fields, "block_index", "row_index")


def extract_recommendations(prepared_: DataFrame) -> DataFrame:
    """(source_file, index, category, content, location): numbered items of sections of advice, each settled into a category.

    Text of sections of recommendations counts, that of treatments only in documents without them; a paragraph without a number of its
    own continues the one above; headings and holders of sections are no advice.
    """
    inside = F.when(F.array_contains("categories", "recommendations"), 0).when(F.array_contains("categories", "treatment_recommendations"), 1)
    x = prepared_.withColumn("tier", inside).where(F.col("tier").isNotNull() & ~F.col("is_table") & F.col("level").isNull() & F.col("category").isNull() & (F.trim("text") != ""))
    x = x.withColumn("_best", F.min("tier").over(Window.partitionBy(*DOC))).where("tier = _best")
    items = sequence.merge_continuations(x, DOC, ["block_index"], F.col("text").rlike(V.ITEM_LABEL), "text", "")
    rows = items.select("source_file", "island", R.item_text(F.col("text")).alias("content"), F.lit("").alias("location"), F.lit("").alias("stated")).where("content <> ''")
    kept = defects.distinct_recommendations(rows, DOC, ["island"], "content", "location", "stated")
    return kept.select("source_file", F.row_number().over(Window.partitionBy(*DOC).orderBy("island")).alias("index"), R.settled_category(F.col("stated"), F.col("content")).alias("category"), "content", "location")


def summary_candidates(prepared_: DataFrame) -> DataFrame:
    """(source_file, field, value, kind, anchor, scope, seq): labelled values of paragraphs and of neighbouring cells, and what the file name tells."""
    text = summary.labelled_values(prepared_.where("NOT is_table"), ["source_file", "block_index", "is_cover"], "text")
    of_text = text.select("source_file", "field", "value", F.when(F.col("is_cover"), "cover").otherwise("paragraph").alias("kind"), "block_index", F.col("place").cast("int").alias("row_index"))
    cells = _lined(prepared_)
    after = F.lead("raw_text").over(Window.partitionBy("source_file", "block_index", "row_index").orderBy("column_index"))
    of_cells = cells.select("source_file", "block_index", "row_index", summary.field_of_label(F.col("raw_text")).alias("field"), after.alias("value")).where("field IS NOT NULL AND value IS NOT NULL")
    files = prepared_.select("source_file").distinct()
    stem = F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"\.docx$", "")
    of_files = files.select("source_file", F.lit("overall_grade").alias("field"), R.filename_grades(stem)["current"].alias("value"), F.lit("filename").alias("kind"), F.lit(-1).alias("block_index"), F.lit(0).alias("row_index")).where("value IS NOT NULL")
    every = of_text.unionByName(of_cells.select("source_file", "field", R.display(F.col("value")).alias("value"), F.lit("table").alias("kind"), "block_index", "row_index")).unionByName(of_files)
    seq = (F.col("block_index").cast("long") + 1) * 1000000 + F.col("row_index")
    named = every.withColumns({"anchor": F.col("block_index"), "scope": F.lit(""), "seq": seq})
    return summary.with_priority(summary.distinct_candidates(named, DOC, "seq"), PRIORITY, {}, {})


def extract_summary(prepared_: DataFrame) -> DataFrame:
    """(source_file, field, value, kind): one value a field, with the conclusion and the risk points told by the sections of conclusions."""
    chosen = summary.selected(summary_candidates(prepared_), DOC, "seq")
    told = routing.route_text(prepared_, DOC, "block_index", "inspection_conclusion", glue="。")
    long = F.inline(F.array(F.struct(F.lit("overall_conclusion").alias("field"), R.overall_conclusion(F.col("text")).alias("value")), F.struct(F.lit("risk_points").alias("field"), R.risk_points(F.col("text")).alias("value"))))
    return chosen.unionByName(told.select("source_file", long, F.lit("section").alias("kind")).where("value <> ''"))


def extract_statements(prepared_: DataFrame) -> DataFrame:
    """(source_file, kind, place, statement): detailed conclusions, causes and safety impacts, as the sections tell them."""
    sections = {"detailed": "inspection_conclusion", "safety": "safety_assessment"}
    texts = [routing.route_text(prepared_, DOC, "block_index", c, glue="。").select("source_file", F.lit(k).alias("kind"), R.sentences(F.col("text")).alias("s")) for k, c in sections.items()]
    causes = texts[0].withColumn("kind", F.lit("cause"))
    every = texts[0].unionByName(texts[1]).unionByName(causes)
    listed = F.when(F.col("kind") == "cause", R.text_list(F.col("s"), "cause")).when(F.col("kind") == "safety", R.text_list(F.col("s"), "safety")).otherwise(R.text_list(F.col("s"), "detailed"))
    return every.select("source_file", "kind", F.posexplode(listed).alias("place", "statement"))


def records(blocks: DataFrame) -> DataFrame:
    """One row a file: (source_file, status, error, summary map, defects, recommendations, statements); failed files keep their error."""
    ready = prepared(blocks)
    files = blocks.groupBy("source_file").agg(F.first("status").alias("status"), F.first("error").alias("error"))
    d = extract_defects(ready).groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("block_index", "row_index", *[f for f, _ in V.DEFECT_HEADERS]))).alias("defects"))
    r = extract_recommendations(ready)
    counts = r.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("index", "category", "content", "location"))).alias("recommendations"), R.counts_text([F.count_if(F.col("category") == c) for c in V.CATEGORIES]).alias("line"))
    s = extract_summary(ready).groupBy(*DOC).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("summary"))
    t = extract_statements(ready).groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("kind", "place", "statement"))).alias("statements"))
    met = files.join(s, DOC, "left").join(d, DOC, "left").join(counts, DOC, "left").join(t, DOC, "left")
    told = F.coalesce("summary", F.create_map().cast("map<string,string>"))
    line = F.when(F.col("line").isNotNull(), F.create_map(F.lit("recommendations_summary"), "line")).otherwise(F.create_map().cast("map<string,string>"))
    return met.select("source_file", "status", "error", F.map_concat(told, line).alias("summary"), "defects", "recommendations", "statements")
