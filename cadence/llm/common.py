"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import checkpoint_dir, scratch_path

#: White space that separates words in every contract of this package: space and \t..\r.
SPACE = "\x20\x09-\x0d"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``, with its DuckDB SQL if SQL can say it."""
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id long, text string) only, null text as empty: extra columns, whatever their
    names, never reach an operator."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the written copy. The
    shuffle files it took are not needed any more, and Spark is asked to remove them."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(CLEANUP, before)


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: the fold rule of the contracts (null id: the empty string)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % n
