"""Source queries (S02, S06, S07) over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.columns import round_doubles
from cadence.plans.catalog import query
from cadence.sources.readers import read_source, union_by_name


@query("mixed_union", "S07 S02 S05", """
WITH u AS (SELECT * FROM orders UNION ALL BY NAME SELECT * FROM customer)
SELECT o_orderkey IS NULL AS from_customer, CAST(count(*) AS BIGINT) AS n,
       CAST(count(o_custkey) AS BIGINT) AS n_o_custkey, CAST(count(c_custkey) AS BIGINT) AS n_c_custkey,
       round(sum(o_totalprice), 6) AS sum_totalprice, round(sum(c_acctbal), 6) AS sum_acctbal,
       CAST(count(c_nationkey) AS BIGINT) AS n_nationkey
FROM u GROUP BY 1""")
def q_mixed_union(spark, sf_dir):
    o = read_source(spark, f"{sf_dir}/orders.parquet")
    c = read_source(spark, f"{sf_dir}/customer.parquet")
    u = union_by_name([o, c])
    return round_doubles(u.groupBy(F.col("o_orderkey").isNull().alias("from_customer")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count("o_custkey").cast("bigint").alias("n_o_custkey"),
        F.count("c_custkey").cast("bigint").alias("n_c_custkey"), F.sum("o_totalprice").alias("sum_totalprice"),
        F.sum("c_acctbal").alias("sum_acctbal"), F.count("c_nationkey").cast("bigint").alias("n_nationkey")))


# ----------------------------------------------------------------------------------------
# Round trips of the given tables through the shared scratch folder: every format's reader
# is exercised on data Spark derives from the tables.

import uuid  # noqa: E402

from cadence.session import scratch_path  # noqa: E402
from cadence.sources.readers import load_training_data  # noqa: E402
from cadence.sources.sinks import (append_log, publish_features, write_findings_json,  # noqa: E402
                                   write_processed)
from cadence.tables import table  # noqa: E402

_ORDERS_AGG = """SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 6) AS total,
       CAST(sum(o_custkey) AS BIGINT) AS custkey_sum, strftime(min(o_orderdate), '%Y-%m-%d %H:%M:%S') AS first_date,
       strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_date FROM orders GROUP BY 1"""


def _orders_agg(df):
    return round_doubles(df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("o_totalprice").alias("total"),
        F.sum("o_custkey").cast("bigint").alias("custkey_sum"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("first_date"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("last_date")))


def _scratch(spark, name):
    return scratch_path(spark, f"roundtrip/{name}-{uuid.uuid4().hex[:8]}")


@query("csv_roundtrip", "S01 S05 S06", _ORDERS_AGG)
def q_csv_roundtrip(spark, sf_dir):
    """orders written as a directory of CSV files, read back with header + inferred types."""
    path = _scratch(spark, "orders-csv")
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    return _orders_agg(read_source(spark, path))   # directory: format detected from its files


@query("json_roundtrip", "S03 S17", _ORDERS_AGG)
def q_json_roundtrip(spark, sf_dir):
    path = _scratch(spark, "orders-json")
    orders = table(spark, sf_dir, "orders")
    write_findings_json(orders, path)
    return _orders_agg(read_source(spark, path, "json", schema=orders.schema, multiLine=False))


@query("feather_roundtrip", "S04", _ORDERS_AGG)
def q_feather_roundtrip(spark, sf_dir):
    """orders as Feather files in a binary column (one per Arrow batch), decoded by the Feather scan's
    tasks. Files on disk are read in the tests."""
    from cadence.sources.readers import decode_feather
    orders = table(spark, sf_dir, "orders")

    def encode(batches):
        import pyarrow as pa
        import pyarrow.ipc as ipc
        for b in batches:
            sink = pa.BufferOutputStream()
            with ipc.new_file(sink, b.schema) as w:
                w.write_batch(b)
            yield pa.RecordBatch.from_pydict({"content": [sink.getvalue().to_pybytes()]})

    return _orders_agg(decode_feather(orders.mapInArrow(encode, "content binary"), orders.schema))


@query("feather_batches", "S04", f"SELECT * REPLACE (round(total, 2) AS total) FROM ({_ORDERS_AGG})")
def q_feather_batches(spark, sf_dir):
    """orders as Feather files that tasks write into the shared folder, with a record batch for every thousand
    rows, read by batches."""
    from cadence.sources.feather import _store, read_feather_batches
    path = _scratch(spark, "orders-feather")

    def write(batches):
        import pyarrow as pa
        import pyarrow.feather as feather
        from pyspark import TaskContext
        whole = list(batches)
        if whole:
            fs, folder = _store(path)
            fs.create_dir(folder, recursive=True)
            with fs.open_output_stream(f"{folder}/part-{TaskContext.get().partitionId():05}.feather") as out:
                feather.write_feather(pa.Table.from_batches(whole), out, compression="lz4", chunksize=1000)
            yield pa.RecordBatch.from_pydict({"rows": [sum(b.num_rows for b in whole)]})

    table(spark, sf_dir, "orders").mapInArrow(write, "rows long").collect()  # a row a task
    return _orders_agg(read_feather_batches(spark, path, part_bytes=64 << 10)).withColumn("total", F.round("total", 2))


@query("processed_sink", "S12 S02", _ORDERS_AGG)
def q_processed_sink(spark, sf_dir):
    path = _scratch(spark, "orders-parquet")
    write_processed(table(spark, sf_dir, "orders"), path)
    return _orders_agg(read_source(spark, path))


@query("mixed_directory", "S06 S07 S11", """
WITH u AS (SELECT * FROM orders UNION ALL BY NAME SELECT * FROM customer)
SELECT o_orderkey IS NULL AS from_customer, CAST(count(*) AS BIGINT) AS n, CAST(count(c_custkey) AS BIGINT) AS n_c_custkey,
       round(sum(o_totalprice), 6) AS sum_totalprice, round(sum(c_acctbal), 6) AS sum_acctbal,
       CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS segments, CAST(count(DISTINCT o_orderstatus) AS BIGINT) AS statuses,
       strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_date, CAST(count(c_name) AS BIGINT) AS names FROM u GROUP BY 1""")
def q_mixed_directory(spark, sf_dir):
    """A directory holding orders as Parquet and customer as CSV, loaded by the dispatcher: one
    scan per format, unioned by column name."""
    path = _scratch(spark, "mixed")
    table(spark, sf_dir, "orders").write.parquet(path)
    table(spark, sf_dir, "customer").write.mode("append").option("header", True).csv(path)
    u = load_training_data(spark, path)
    return round_doubles(u.groupBy(F.col("o_orderkey").isNull().alias("from_customer")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count("c_custkey").cast("bigint").alias("n_c_custkey"),
        F.sum("o_totalprice").alias("sum_totalprice"), F.sum("c_acctbal").alias("sum_acctbal"),
        F.count_distinct("c_mktsegment").cast("bigint").alias("segments"),
        F.count_distinct("o_orderstatus").cast("bigint").alias("statuses"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd HH:mm:ss").alias("last_date"),
        F.count("c_name").cast("bigint").alias("names")))


@query("feature_store", "S14", """
SELECT '2024-01-01' AS feature_version, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice), 6) AS total,
       CAST(sum(l_partkey) AS BIGINT) AS parts, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_ship FROM lineitem""")
def q_feature_store(spark, sf_dir):
    path = _scratch(spark, "features")
    publish_features(table(spark, sf_dir, "lineitem"), path, "2024-01-01")
    back = spark.read.parquet(path).where(F.col("feature_version") == "2024-01-01")   # partition pruning
    return round_doubles(back.groupBy(F.col("feature_version").cast("string").alias("feature_version")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("l_extendedprice").alias("total"),
        F.sum("l_partkey").cast("bigint").alias("parts"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("last_ship")))


@query("append_log", "S15", """
SELECT event_type, CAST(2 * count(*) AS BIGINT) AS n, round(2 * sum(value), 6) AS total FROM events GROUP BY 1""")
def q_append_log(spark, sf_dir):
    """The events appended twice to a log."""
    path = _scratch(spark, "log")
    ev = table(spark, sf_dir, "events")
    append_log(ev, path)
    append_log(ev, path)
    return round_doubles(spark.read.parquet(path).groupBy("event_type").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum("value").alias("total")))


@query("validate_path", "V13 V12", """
SELECT true AS is_valid, CAST(count(*) AS BIGINT) AS num_samples, CAST(5 AS BIGINT) AS num_features,
       CAST(0 AS BIGINT) AS n_errors FROM customer""")
def q_validate_path(spark, sf_dir):
    from cadence.operators.validate import DataSchema, validate_training_data
    path = _scratch(spark, "customer-dir")
    table(spark, sf_dir, "customer").write.parquet(path)
    _, s = validate_training_data(spark, path, DataSchema(required_columns=["c_custkey"], min_rows=1))
    return s.select("is_valid", "num_samples", "num_features", "n_errors")


@query("memory_estimate", "V07 V08", """
SELECT CAST(count(*) AS BIGINT) AS num_rows, CAST(6 AS BIGINT) AS num_columns,
       round((sum(COALESCE(strlen(o_orderstatus) + 49, 8) + COALESCE(strlen(o_orderpriority) + 49, 8) + 32) + 128)
             / 1024.0 / 1024.0, 6) AS memory_usage_mb FROM orders""")
def q_memory_estimate(spark, sf_dir):
    from cadence.operators.validate import compute_statistics
    st = compute_statistics(table(spark, sf_dir, "orders"))
    return spark.createDataFrame([(st["num_rows"], st["num_columns"], round(st["memory_usage_mb"], 6))],
                                 "num_rows bigint, num_columns bigint, memory_usage_mb double")
