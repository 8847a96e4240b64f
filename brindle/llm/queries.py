"""The thin queries over the driver's tables, and their DuckDB equivalents where SQL has one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, kdtree, mixing, packing, pii, quality_model, quality_rules, secrets, sharding, simhash
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(chat_format.format_chats(chat_format.with_probe(table(spark, sf_dir, "conversations"))))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    found = quality_model.score(docs, model)
    return found.select("doc_id", quality_model.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf_dir, "embeddings"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken", F.get("takes", F.lit(0))["slot"].alias("first_slot"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_chat_format, op3_simhash, op4_pii, op5_quality_model, op6_packing, op7_secrets, op8_kdtree, op9_sharding, op10_mixing)}
ORACLE_SQL = {"op1_quality_rules": quality_rules.ORACLE, "op2_chat_format": chat_format.ORACLE, "op8_kdtree": kdtree.ORACLE, "op10_mixing": mixing.ORACLE}
