"""From raw documents to packed token sequences, in five stages.

Each stage reads what its predecessor wrote.  All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import mixing, packing, quality_model, secrets, shingles
from brindle.llm.common import made, release, table, written


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, as they are.

    Null, empty and blank texts all get the score of the model's bias, and go or stay together; repeated rows are judged one by
    one; without labels of both kinds every score is 0.5 and all stay; an empty table stays empty; further columns,
    whatever their names, travel along.
    """
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.scored(docs, model).where("predicted = 1").select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, at five-word similarity 0.8 or more: the smallest id, null last.

    SimHash over five-word shingles proposes them, as in ``simhash``; those beyond the reach of its signatures follow from an
    exact join; all are verified on their whole shingle sets.
    Null and blank texts are copies of each other; of repeated rows one stays; texts of any length are compared whole; an
    empty table stays empty; further columns, whatever their names, travel along.
    """
    return shingles.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in them masked and ``n_chars``, where there is one, counted anew.

    Null and empty texts stay as they are (null counts null); repeated rows are scanned one by one; an empty table stays empty;
    further columns, whatever their names, travel along.
    """
    return _recount(secrets.scanned(docs), "doc", "redacted")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeats included, in the order of its slots; one taken in part keeps its beginning.

    Documents without words are never taken, so null, empty and blank texts go; a null source is a source; repeated rows are
    documents of their own; an empty table stays empty; further columns, whatever their names, travel along.
    """
    return _recount(mixing.emit(mixing.mix(docs)))


def _recount(rows: DataFrame, doc: str | None = None, text: str = "text") -> DataFrame:
    """The columns of the documents, with ``text`` in place and ``n_chars`` as its length."""
    names = rows.schema[doc].dataType.fieldNames() if doc else rows.columns
    old = lambda c: F.col(doc).getField(c) if doc else F.col(f"`{c}`")
    new = {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return rows.select(*[new.get(c, old(c)).alias(c) for c in names])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids.

    Null and empty texts are the end id alone; repeated rows are documents of their own; an empty table gives no pieces;
    further columns do not matter.
    """
    return packing.pack(docs)


STAGES = [
    ("quality classifier", filter_quality),
    ("near duplicates", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

#: Hashes, learnt models and token ids are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; tables that a stage made for itself are removed once its result is written."""
    docs, mark = table(spark, sf_dir, "documents"), made()
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        release(spark, mark, but=1)
    return STAGES[-1][1](spark, docs, sf_dir)
