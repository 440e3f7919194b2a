"""Bindings to the driver-generated tables (``<sf_dir>/<name>.parquet``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Columns stored as timestamp_ntz; event-time operators need a real TIMESTAMP (UTC session).
_TS_COLUMNS = {"orders": ["o_orderdate"], "lineitem": ["l_shipdate"], "events": ["ts"]}


def table(spark: SparkSession, sf_dir: str, name: str, ts_as_timestamp: bool = False) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if ts_as_timestamp:
        for c in _TS_COLUMNS.get(name, []):
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views under the table names, so every operator is also usable from spark.sql."""
    for t in TABLES:
        table(spark, sf_dir, t).createOrReplaceTempView(t)
