"""Streaming queries (W01-W06): file streams over the driver tables, run with trigger
availableNow into sinks under the shared checkpoint folder, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cadence.operators.canary import requests_from_events
from cadence.operators.score import nearest_centroid
from cadence.plans.catalog import query
from cadence.plans.evaluation import _EMB
from cadence.plans.rollout import _SH
from cadence.session import scratch_path
from cadence.streaming.streams import (canary_windows, incremental_input, pair_streams, read_counters, read_gauges,
                                       read_histograms, rollout_state_machine, rollout_with_deadlines, run_available, run_updates,
                                       stream_counters, stream_gauges, stream_histograms, stream_scores, table_stream)
from cadence.tables import table

_BUCKET = "(('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100)"


_RANKED = "list_sort(list({v}))[CAST(ceil({p} * count(*)) AS BIGINT)]"   # a sketch's answer is exact below 10,000 rows


@query("stream_canary", "W01", f"""
WITH w AS (SELECT time_bucket(INTERVAL '30 minutes', ts) AS ws, CASE WHEN {_BUCKET} < 25 THEN 'canary' ELSE 'production' END AS arm,
                  event_type = 'error' AS is_error, value FROM events)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, arm, CAST(count(*) AS BIGINT) AS requests,
       CAST(count(*) FILTER (WHERE is_error) AS BIGINT) AS errors,
       round({_RANKED.format(v="value", p=0.5)}, 6) AS p50, round({_RANKED.format(v="value", p=0.95)}, 6) AS p95,
       round({_RANKED.format(v="value", p=0.99)}, 6) AS p99
FROM w GROUP BY ws, arm""")
def q_stream_canary(spark, sf_dir):
    """All windows of the log, the newest ones included (update mode)."""
    log = requests_from_events(table_stream(spark, sf_dir, "events"))
    out = run_updates(canary_windows(log, 25), "canary-windows", ["window_start", "window_end", "arm"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "arm", "requests", "errors",
                      *[F.round(F.col("latency_pct")[i], 6).alias(c) for i, c in enumerate(("p50", "p95", "p99"))])


@query("stream_scoring", "W02 B06", f"""WITH {_EMB}
SELECT y AS label, pred AS prediction, CAST(count(*) AS BIGINT) AS n FROM ep GROUP BY 1, 2""")
def q_stream_scoring(spark, sf_dir):
    batch = table(spark, sf_dir, "embeddings")
    stream = table_stream(spark, sf_dir, "embeddings")

    def scorer(df):
        return nearest_centroid(df, "embedding", "label", fit_df=batch)
    out = run_available(stream_scores(stream, scorer, "centroid-v1").drop("embedding", "probabilities"), "scores")
    return out.groupBy(F.col("label").cast("long").alias("label"), "prediction").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("stream_pairs", "W03 J01 H01", f"""WITH {_SH}
SELECT deployment_id, CAST(count(*) AS BIGINT) AS pairs, CAST(count(*) FILTER (WHERE m) AS BIGINT) AS matches FROM cmp GROUP BY 1""")
def q_stream_pairs(spark, sf_dir):
    from cadence.operators.shadow import compare
    ev = table_stream(spark, sf_dir, "events")
    p = F.col("value") / (F.col("value") + F.lit(50.0))
    shift = F.when(F.col("event_type") == "view", F.lit(0.0)).otherwise(((F.col("user_id") % 7) - 3) * F.lit(0.04))
    q = p + shift
    rid = F.col("event_id").cast("string").alias("request_id")
    prod = ev.select(rid, F.concat(F.lit("shadow_"), F.col("event_type")).alias("deployment_id"), "ts",
                     F.array(F.lit(1.0) - p, p).alias("production_prediction"))
    # The shadow answer arrives a few seconds after production.
    shadow = ev.select(rid, (F.col("ts") + F.make_interval(secs=(F.col("user_id") % 5).cast("int"))).alias("ts"),
                       F.array(F.lit(1.0) - q, q).alias("shadow_prediction"))
    pairs = compare(pair_streams(prod, shadow))
    out = run_available(pairs.select("deployment_id", "predictions_match"), "pairs")
    return out.groupBy("deployment_id").agg(F.count(F.lit(1)).cast("bigint").alias("pairs"),
                                            F.count_if("predictions_match").cast("bigint").alias("matches"))


_STATE_STAGES = [1, 5, 25, 50, 100]


@query("stream_state", "W04 C04", f"""
WITH w AS (SELECT 'deploy_' || event_type AS deployment_id, time_bucket(INTERVAL '1 day', ts) AS ws, count(*) AS n,
                  count(*) FILTER (WHERE user_id % 5 = 0) AS errors, {_RANKED.format(v="value", p=0.95)} AS p95
           FROM events WHERE {_BUCKET} < 25 GROUP BY 1, 2),
h AS (SELECT *, NOT (errors / n > 0.26 OR p95 > 400.0 OR 1.0 - errors / n < 0.74) AS healthy,
             row_number() OVER (PARTITION BY deployment_id ORDER BY ws) AS rn FROM w),
f AS (SELECT *, COALESCE(min(rn) FILTER (WHERE NOT healthy) OVER (PARTITION BY deployment_id), 1000000) AS bad FROM h)
SELECT deployment_id, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
       CAST(CASE WHEN healthy THEN least(rn, 4) ELSE rn - 1 END AS INTEGER) AS stage_index,
       CAST({_STATE_STAGES}[rn] AS INTEGER) AS percentage, healthy,
       CASE WHEN NOT healthy THEN 'rolled_back' WHEN rn = 5 THEN 'completed' ELSE 'in_progress' END AS status,
       array_to_string({_STATE_STAGES}[1:CASE WHEN healthy THEN rn ELSE rn - 1 END], ',') AS stages_completed
FROM f WHERE rn <= least(bad, 5)""")
def q_stream_state(spark, sf_dir):
    """Canary state machines of all deployments (one per event type) over daily windows; the SQL
    twin is the batch rule of C04."""
    ev = table_stream(spark, sf_dir, "events")
    log = ev.select("user_id", "ts", F.concat(F.lit("deploy_"), F.col("event_type")).alias("deployment_id"),
                    (F.col("user_id") % 5 == 0).alias("is_error"), F.col("value").alias("latency_ms"))
    windows = run_updates(canary_windows(log, 25, window="1 day", watermark="1 hour", group=["deployment_id"]), "daily-windows",
                          ["window_start", "window_end", "arm", "deployment_id"])
    src = windows.where(F.col("arm") == "canary").select(
        "deployment_id", "window_start", "requests", "errors", F.col("latency_pct")[1].alias("latency_p95_ms"))
    # Re-read the written windows as a stream, then advance the state machines.
    path = scratch_path(spark, f"streams/state-input-{uuid.uuid4().hex[:8]}")
    src.write.mode("overwrite").parquet(path)
    stream = spark.readStream.schema(src.schema).parquet(path)
    sm = rollout_state_machine(stream, _STATE_STAGES, 0.26, 400.0, 0.74)
    out = run_available(sm, "rollout-state")
    return out.withColumns({"stages_completed": F.array_join(F.col("stages_completed").cast("array<string>"), ","),
                            "window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")})


@query("stream_gauges", "W05 M03", """
WITH u AS (SELECT event_type AS model_name, CAST(user_id % 3 AS VARCHAR) AS model_version, value / 500.0 AS accuracy, ts FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY model_name, model_version ORDER BY ts DESC, accuracy DESC) AS rn FROM u)
SELECT model_name, model_version, round(accuracy, 6) AS accuracy FROM r WHERE rn = 1""")
def q_stream_gauges(spark, sf_dir):
    ev = table_stream(spark, sf_dir, "events")
    u = ev.select(F.col("event_type").alias("model_name"), (F.col("user_id") % 3).cast("string").alias("model_version"),
                  (F.col("value") / F.lit(500.0)).alias("accuracy"), "ts")
    target = scratch_path(spark, f"streams/gauge-table-{uuid.uuid4().hex[:8]}")
    stream_gauges(u, ["model_name", "model_version"], "accuracy", target)
    return read_gauges(spark, target).select("model_name", "model_version", F.round("accuracy", 6).alias("accuracy"))


_GAPS = "(extract('dayofyear' FROM ts) * 5 + length(event_type)) % 11 > 0 AND NOT (event_type = 'error' AND extract('day' FROM ts) > 3)"


@query("stream_deadlines", "W04 C04", f"""
WITH w AS (SELECT 'deploy_' || event_type AS deployment_id, time_bucket(INTERVAL '1 day', ts) AS ws, count(*) AS n,
                  count(*) FILTER (WHERE user_id % 5 = 0) AS errors, {_RANKED.format(v="value", p=0.95)} AS p95
           FROM events WHERE {_BUCKET} < 25 AND {_GAPS} GROUP BY 1, 2),
g AS (SELECT deployment_id, min(ws) AS t0 FROM w GROUP BY 1), top AS (SELECT max(ws) AS latest FROM w),
s AS (SELECT deployment_id, i, t0 + i * INTERVAL 1 DAY AS ws FROM g, range(0, 5) AS r(i)),
h AS (SELECT s.deployment_id, s.i, s.ws, COALESCE(NOT (errors / n > 0.4 OR p95 > 400.0 OR 1.0 - errors / n < 0.6), false) AS healthy
      FROM s LEFT JOIN w ON s.deployment_id = w.deployment_id AND s.ws = w.ws, top WHERE n IS NOT NULL OR s.ws + INTERVAL 1 DAY < latest),
f AS (SELECT *, COALESCE(min(i) FILTER (WHERE NOT healthy) OVER (PARTITION BY deployment_id), 1000000) AS bad FROM h)
SELECT deployment_id, strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(CASE WHEN healthy THEN least(i + 1, 4) ELSE i END AS INTEGER) AS stage_index,
       CAST({_STATE_STAGES}[i + 1] AS INTEGER) AS percentage, healthy,
       CASE WHEN NOT healthy THEN 'rolled_back' WHEN i = 4 THEN 'completed' ELSE 'in_progress' END AS status,
       array_to_string({_STATE_STAGES}[1:CASE WHEN healthy THEN i + 1 ELSE i END], ',') AS stages_completed
FROM f WHERE i <= least(bad, 4)""")
def q_stream_deadlines(spark, sf_dir):
    """Daily canary windows of a log with whole days missing, and one deployment that falls silent: a stage
    without traffic fails, by the gap or by the timer."""
    ev = table_stream(spark, sf_dir, "events").where(
        ((F.dayofyear("ts") * 5 + F.length("event_type")) % 11 > 0) & ~((F.col("event_type") == "error") & (F.dayofmonth("ts") > 3)))
    log = ev.select("user_id", "ts", F.concat(F.lit("deploy_"), F.col("event_type")).alias("deployment_id"),
                    (F.col("user_id") % 5 == 0).alias("is_error"), F.col("value").alias("latency_ms"))
    windows = run_updates(canary_windows(log, 25, window="1 day", watermark="1 hour", group=["deployment_id"]), "gap-windows",
                          ["window_start", "window_end", "arm", "deployment_id"])
    src = windows.where(F.col("arm") == "canary").select(
        "deployment_id", "window_start", "requests", "errors", F.col("latency_pct")[1].alias("latency_p95_ms"))
    path = scratch_path(spark, f"streams/deadline-input-{uuid.uuid4().hex[:8]}")
    src.write.parquet(path)
    stream = spark.readStream.schema(src.schema).parquet(path)
    out = run_available(rollout_with_deadlines(stream, _STATE_STAGES, 86_400, 0.4, 400.0, 0.6), "rollout-deadlines")
    return out.withColumns({"stages_completed": F.array_join(F.col("stages_completed").cast("array<string>"), ","),
                            "window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")})


_RUN_BOUNDS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0]


@query("stream_counters", "W05 M01", "SELECT event_type AS status, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY 1")
def q_stream_counters(spark, sf_dir):
    """Counters of a stream; a second run finds nothing new and adds nothing."""
    target = scratch_path(spark, f"streams/counter-table-{uuid.uuid4().hex[:8]}")
    for _ in range(2):
        stream_counters(table_stream(spark, sf_dir, "events").select(F.col("event_type").alias("status")), ["status"], target)
    return read_counters(spark, target)


@query("stream_histogram", "W05 M02", " UNION ALL ".join(
    f"SELECT event_type AS status, '{b}' AS le, CAST(count(*) FILTER (WHERE value <= {b}) AS BIGINT) AS count, round(sum(value), 6) AS sum, "
    f"CAST(count(value) AS BIGINT) AS total FROM events GROUP BY 1" for b in _RUN_BOUNDS)
    + " UNION ALL SELECT event_type, '+Inf', CAST(count(value) AS BIGINT), round(sum(value), 6), CAST(count(value) AS BIGINT) FROM events GROUP BY 1")
def q_stream_histogram(spark, sf_dir):
    runs = table_stream(spark, sf_dir, "events").select(F.col("event_type").alias("status"), F.col("value").alias("duration_seconds"))
    target = scratch_path(spark, f"streams/histogram-table-{uuid.uuid4().hex[:8]}")
    stream_histograms(runs, "duration_seconds", target, _RUN_BOUNDS, ["status"])
    return read_histograms(spark, target, _RUN_BOUNDS, ["status"]).withColumn("sum", F.round("sum", 6))


@query("stream_incremental", "W06", """
SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n, round(sum(o_totalprice), 6) AS total FROM orders GROUP BY 1""")
def q_stream_incremental(spark, sf_dir):
    base = scratch_path(spark, f"streams/retrain-input-{uuid.uuid4().hex[:8]}")
    incremental_input(table_stream(spark, sf_dir, "orders"), f"{base}/data", f"{base}/_checkpoint")
    # A second run finds nothing new: the checkpoint makes the append exactly-once.
    incremental_input(table_stream(spark, sf_dir, "orders"), f"{base}/data", f"{base}/_checkpoint")
    out = spark.read.parquet(f"{base}/data")
    return out.groupBy("o_orderstatus").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                            F.round(F.sum("o_totalprice"), 6).alias("total"))
