"""Word documents as tables of blocks, cells and images.

A DOCX is a zip of XML parts; each file is parsed by itself in an Arrow mapper over the binary
file source.  A file that cannot be read gives one row with its error and never fails the job.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CELL = "row_index int, column_index int, row_span int, column_span int, is_cont boolean, origin_row int, origin_col int, raw_text string"
IMAGE = "relationship_id:string,target:string,name:string,description:string,in_row:int,in_column:int"
BLOCK = f"block_index int, kind string, raw_text string, heading_level int, style_id string, paragraph_index int, table_index int, images array<struct<{IMAGE}>>, cells array<struct<{CELL.replace(' int', ':int').replace(' boolean', ':boolean').replace(' string', ':string').replace(', ', ',')}>>"
SCHEMA = "source_file string, status string, error string, " + BLOCK

#: Fixed names of the WordprocessingML vocabulary.
NAMESPACE = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def parse_document(content: bytes) -> list[dict]:
    """The body's paragraphs and tables in order, as block records."""
    import io
    import re
    import zipfile
    from xml.etree import ElementTree

    w = NAMESPACE
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        part = lambda name: ElementTree.fromstring(z.read(name)) if name in z.namelist() else None
        body = ElementTree.fromstring(z.read("word/document.xml")).find(w + "body")
        styles, related = part("word/styles.xml"), part("word/_rels/document.xml.rels")
    if body is None:
        raise ValueError("word/document.xml has no body")
    targets = {r.get("Id"): r.get("Target") for r in related if r.get("Type", "").endswith("/image") and r.get("Target")} if related is not None else {}

    def val(el, path: str) -> str | None:
        found = el.find("/".join(w + p for p in path.split("/"))) if el is not None else None
        return None if found is None else found.get(w + "val")

    levels: dict[str, int] = {}
    for s in styles.iter(w + "style") if styles is not None else ():
        if s.get(w + "type", "paragraph") != "paragraph" or not s.get(w + "styleId"):
            continue  # a character style makes no heading
        outline, name = val(s, "pPr/outlineLvl"), val(s, "name") or ""
        named = re.search(r"(?:heading|标题)\s*([1-9])", name.lower())
        if outline is not None and outline.isdigit():
            levels[s.get(w + "styleId")] = int(outline) + 1
        elif named:
            levels[s.get(w + "styleId")] = int(named[1])

    def text(el) -> str:
        out: list[str] = []

        def visit(node) -> None:
            tag = node.tag.removeprefix(w)
            if tag in ("del", "delText", "instrText"):
                return
            out.append({"t": node.text or "", "tab": "\t", "br": "\n", "cr": "\n", "noBreakHyphen": "-", "softHyphen": "­"}.get(tag, ""))
            for child in node:
                visit(child)

        visit(el)
        return "".join(out)

    def images(el, row: int | None = None, column: int | None = None) -> list[dict]:
        """The pictures of an element, once each, with the name and description of its first drawing."""
        about = next((x for x in el.iter() if x.tag.rsplit("}", 1)[-1] == "docPr"), None)
        out: dict[str, dict] = {}
        for x in el.iter():
            kind, by = x.tag.rsplit("}", 1)[-1], {k.rsplit("}", 1)[-1]: v for k, v in x.attrib.items()}
            ref = by.get("embed") or by.get("link") if kind == "blip" else by.get("id") if kind == "imagedata" else None
            if ref in targets and ref not in out:
                out[ref] = {"relationship_id": ref, "target": targets[ref], "name": about.get("name", "") if about is not None else "", "description": about.get("descr", "") if about is not None else "", "in_row": row, "in_column": column}
        return list(out.values())

    def number(el, path: str, default: int) -> int:
        v = val(el, path)
        return int(v) if v and v.isdigit() else default

    def cells(table, pictures: list[dict]) -> list[dict]:
        out, above = [], {}
        for r, row in enumerate(table.findall(w + "tr")):
            at = number(row, "trPr/gridBefore", 0)
            for c in row.findall(w + "tc"):
                span = max(1, number(c, "tcPr/gridSpan", 1))
                merge = c.find(f"{w}tcPr/{w}vMerge")
                goes_on = merge is not None and merge.get(w + "val", "continue") != "restart"
                origin = above.get(at) if goes_on else None
                cell = {"row_index": r, "column_index": at, "row_span": 1, "column_span": span, "is_cont": origin is not None, "origin_row": origin["row_index"] if origin else r, "origin_col": origin["column_index"] if origin else at}
                cell["raw_text"] = "\n".join(text(p) for p in c.findall(w + "p"))
                pictures.extend(images(c, r, at))
                if origin:
                    origin["row_span"] += 1
                elif merge is not None:
                    above[at] = cell
                else:
                    above.pop(at, None)
                out.append(cell)
                at += span
        return out

    blocks: list[dict] = []
    n = {"p": 0, "tbl": 0}
    for el in body:
        tag = el.tag.removeprefix(w)
        if tag not in n:
            continue
        b = dict.fromkeys(("heading_level", "style_id", "paragraph_index", "table_index"))
        b |= {"block_index": len(blocks), "kind": "paragraph" if tag == "p" else "table", "cells": [], "images": []}
        if tag == "p":
            style = val(el, "pPr/pStyle")
            b |= {"raw_text": text(el), "style_id": style, "heading_level": levels.get(style), "paragraph_index": n[tag], "images": images(el)}
        else:
            found = cells(el, b["images"])
            rows: dict[int, list[str]] = {}
            for c in found:
                rows.setdefault(c["row_index"], []).append(c["raw_text"])
            b |= {"raw_text": "\n".join("\t".join(rows[r]) for r in sorted(rows)), "table_index": n[tag], "cells": found}
        n[tag] += 1
        blocks.append(b)
    return blocks


def _mapper(schema):
    parse = parse_document

    def run(batches: Iterator):
        import pyarrow as pa

        for b in batches:
            out = []
            for path, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    # A document without blocks is still one that was read.
                    out += [{"source_file": path, "status": "succeeded", "error": None, **x} for x in parse(content) or [{"cells": [], "images": []}]]
                except Exception as e:  # noqa: BLE001  a bad file is a row, not a failed job
                    out.append({"source_file": path, "status": "failed", "error": type(e).__name__, "cells": [], "images": []})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def read_blocks(spark: SparkSession, root: str) -> DataFrame:
    """One row a block of every ``.docx`` below ``root``; failed files have status ``failed``, empty ones a row without a block."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.docx").load(root)
    schema = to_arrow_schema(T.StructType.fromDDL(SCHEMA))
    return files.select("path", "content").mapInArrow(_mapper(schema), SCHEMA)


def cells(blocks: DataFrame) -> DataFrame:
    """One row a table cell."""
    return blocks.where("kind = 'table'").select("source_file", "block_index", "table_index", F.inline("cells"))


def images(blocks: DataFrame) -> DataFrame:
    """One row a picture, with the block, and in tables the cell, that holds it."""
    return blocks.select("source_file", "block_index", "kind", F.inline("images"))
