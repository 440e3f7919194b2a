"""Sinks (S12-S17): processed data, split sets, feature-store versions, append logs,
structured findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_processed(df: DataFrame, path: str) -> str:
    """One Parquet dataset, replaced atomically per job."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_splits(df: DataFrame, path: str, target: str, split_col: str = "split") -> dict:
    """Train / val / test as one dataset partitioned by split, target as the last data
    column. Returns the per-split paths (partition pruning serves each split)."""
    cols = [c for c in df.columns if c not in (target, split_col)]
    df.select(*cols, target, split_col).write.mode("overwrite").partitionBy(split_col).parquet(path)
    return {s: f"{path}/{split_col}={s}" for s in ("train", "val", "test")}


def publish_features(df: DataFrame, path: str, feature_version: str) -> dict:
    """Publish under ``feature_version``; dynamic partition overwrite replaces only this
    version. Returns version and row count (counted by an observed metric of the write)."""
    from pyspark.sql import Observation
    obs = Observation("publish")
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        (df.withColumn("feature_version", F.lit(feature_version)).observe(obs, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").partitionBy("feature_version").parquet(path))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
    return {"feature_version": feature_version, "num_rows": obs.get["rows"]}


def append_log(df: DataFrame, path: str) -> None:
    """Append comparison / request records to a Parquet log."""
    df.write.mode("append").parquet(path)


def write_findings_json(df: DataFrame, path: str) -> None:
    """Findings / metrics as JSON lines."""
    df.write.mode("overwrite").json(path)
