"""Shared pieces of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: space and the ASCII controls from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the cluster names it.

    Where neither the session nor the context names one, a temporary folder serves a
    local master; on a cluster that is an error, since executors would not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="brindle-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


#: Folders of the tables that ``written`` made in this process, in order.
_made: list[str] = []


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, without its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/brindle-{os.getpid()}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def made() -> int:
    """How many tables ``written`` has made so far: a mark for ``release``."""
    return len(_made)


def release(spark: SparkSession, since: int, but: int = 0) -> None:
    """Removes the tables made after the mark ``since``, but for the last ``but`` of them."""
    last = len(_made) - but
    for path in _made[since:last]:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    del _made[since:last]


#: A key with more than this share of the rows is hot: so there are at most 1 / HOT_SHARE of them.
HOT_SHARE, HOT_LEAST, SALTS = 1e-4, 1024, 64


def hot_join(rows: DataFrame, facts: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """``rows`` joined to ``facts``, which has a row for each key; rows of a hot key are dealt over many tasks.

    ``count`` is the column of ``facts`` with a key's number of rows, of ``total`` in all.  A key is hot from
    ``HOT_SHARE`` of all rows on, so at most 10,000 keys are broadcast, whatever the input.
    """
    least = max(HOT_LEAST, int(total * HOT_SHARE))
    hot = facts.where(F.col(count) > least).select(F.col(key).alias("_hot"))
    dealt = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    dealt = dealt.withColumn("_salt", F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))).drop("_hot")
    salts = F.when(F.col(count) > least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(facts.withColumn("_salt", F.explode(salts)), [key, "_salt"]).drop("_salt")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null or blank texts."""
    kept = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(kept == "", F.array().cast("array<string>")).otherwise(F.split(kept, BLANK_RUN))


def count_words(text: Column) -> Column:
    """The number of words without building them: word starts are counted in one scan."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")
