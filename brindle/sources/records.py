"""Readers and writers of records: JSON in its usual shapes, manifests, weights, leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEADERBOARD = "commit string, config string, summary_score double, defect_precision double, defect_recall double, defect_f1 double, recommendation_f1 double, weighted_total double, runtime double, failed_documents int, notes string"


def read_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """JSON lines, or whole documents (``multi_line``); a wrapper's ``records`` or ``samples`` become rows."""
    reader = spark.read.option("multiLine", str(multi_line).lower())
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    for wrapper in ("records", "samples"):
        if wrapper in df.columns and isinstance(df.schema[wrapper].dataType, T.ArrayType):
            return df.select(F.inline(wrapper))
    return df


def write_records(df: DataFrame, path: str) -> None:
    """JSON lines with the fields of each record in the order of their names."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str, kind: str, key: str = "sample_id") -> DataFrame:
    """A CSV, JSON or text manifest; repeated keys are an error."""
    df = {"csv": lambda: spark.read.csv(path, header=True), "json": lambda: read_records(spark, path), "text": lambda: spark.read.text(path).select(F.trim("value").alias(key)).where(F.col(key) != "")}[kind]()
    twice = df.groupBy(key).count().where("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"repeated in the manifest: {[r[0] for r in twice]}")
    return df


def validate_weights(weights: dict[str, float]) -> dict[str, float]:
    """Section weights: none negative, together 100."""
    if not weights or any(v < 0 for v in weights.values()) or abs(sum(weights.values()) - 100) > 1e-6:
        raise ValueError("weights must not be negative and must add up to 100")
    return dict(weights)


def read_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEADERBOARD).option("enforceSchema", "false").csv(path, header=True)


def write_leaderboard(df: DataFrame, path: str) -> None:
    """Ranked rows as one CSV: nulls last, then the scores, then commit and configuration."""
    order = [F.desc_nulls_last("weighted_total"), F.desc_nulls_last("defect_f1"), F.desc_nulls_last("recommendation_f1"), F.desc_nulls_last("summary_score"), "commit", "config"]
    df.orderBy(*order).coalesce(1).write.mode("overwrite").csv(path, header=True)
