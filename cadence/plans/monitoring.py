"""Monitoring queries (M01-M07) over events (runs, gauges, alerts derived per event)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.columns import round_doubles
from cadence.operators.monitor import (completion_summary, deployment_gauge, duration_histogram,
                                       gate_alerts, last_gauge, route_alerts, run_counter)
from cadence.plans.catalog import query
from cadence.tables import table

_STATUS = "CASE event_type WHEN 'error' THEN 'failure' ELSE 'success' END"
BUCKETS = [1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0]


def training_runs(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(F.when(F.col("event_type") == "error", "failure").otherwise("success").alias("status"),
                     F.col("value").alias("duration_seconds"), "ts")


@query("run_counter", "M01", f"SELECT {_STATUS} AS status, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY 1")
def q_run_counter(spark, sf_dir):
    return run_counter(training_runs(spark, sf_dir))


@query("duration_histogram", "M02", " UNION ALL ".join(
    f"SELECT '{b}' AS le, CAST(count(*) FILTER (WHERE value <= {b}) AS BIGINT) AS count, round(sum(value), 6) AS sum, "
    f"CAST(count(value) AS BIGINT) AS total FROM events" for b in BUCKETS)
    + " UNION ALL SELECT '+Inf', CAST(count(value) AS BIGINT), round(sum(value), 6), CAST(count(value) AS BIGINT) FROM events")
def q_duration_histogram(spark, sf_dir):
    return round_doubles(duration_histogram(training_runs(spark, sf_dir), buckets=BUCKETS))


@query("accuracy_gauge", "M03", """
WITH u AS (SELECT event_type AS model_name, CAST(user_id % 3 AS VARCHAR) AS model_version, value / 500.0 AS accuracy, ts FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY model_name, model_version ORDER BY ts DESC, accuracy DESC) AS rn FROM u)
SELECT model_name, model_version, round(accuracy, 6) AS accuracy FROM r WHERE rn = 1""")
def q_accuracy_gauge(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    u = ev.select(F.col("event_type").alias("model_name"), (F.col("user_id") % 3).cast("string").alias("model_version"),
                  (F.col("value") / F.lit(500.0)).alias("accuracy"), "ts")
    return round_doubles(last_gauge(u, ["model_name", "model_version"], "accuracy"))


@query("deployment_gauge", "M04", """
WITH u AS (SELECT 'deploy_' || CAST(user_id % 5 AS VARCHAR) AS deployment_id,
                  CASE WHEN user_id % 2 = 0 THEN 'canary' ELSE 'shadow' END AS strategy,
                  CAST(event_type <> 'error' AS INTEGER) AS a, ts FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY deployment_id, strategy ORDER BY ts DESC, a DESC) AS rn FROM u)
SELECT deployment_id, strategy, a AS value FROM r WHERE rn = 1""")
def q_deployment_gauge(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    u = ev.select(F.concat(F.lit("deploy_"), (F.col("user_id") % 5).cast("string")).alias("deployment_id"),
                  F.when(F.col("user_id") % 2 == 0, "canary").otherwise("shadow").alias("strategy"),
                  (F.col("event_type") != "error").alias("active"), "ts")
    return deployment_gauge(u)


_LEVEL = ("CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'critical' WHEN 'signup' THEN 'warning' "
          "WHEN 'click' THEN 'info' ELSE 'debug' END")


def alerts(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    level = (F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "critical")
             .when(F.col("event_type") == "signup", "warning").when(F.col("event_type") == "click", "info")
             .otherwise("debug"))
    return ev.select(level.alias("level"), F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"),
                     F.col("ts").cast("timestamp").alias("ts"))


@query("alert_routes", "M05", f"""
WITH a AS (SELECT {_LEVEL} AS level FROM events),
r AS (SELECT level, unnest(CASE level WHEN 'info' THEN ['slack'] WHEN 'warning' THEN ['slack']
                                      WHEN 'error' THEN ['slack', 'email'] WHEN 'critical' THEN ['slack', 'email', 'webhook']
                                      ELSE ['slack'] END) AS channel FROM a)
SELECT level, channel, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY 1, 2""")
def q_alert_routes(spark, sf_dir):
    r = route_alerts(alerts(spark, sf_dir))
    return r.groupBy("level", "channel").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


from cadence.plans import rollout as _rollout  # noqa: E402

_DECISION_SQL = _rollout.ORACLE_DECISION


@query("gate_alerts", "M06", _rollout._STAGES_SQL + """,
r AS (SELECT *, CASE WHEN fb THEN 'skipped' WHEN healthy THEN 'passed' ELSE 'failed' END AS status FROM s),
f AS (SELECT 'Canary stage ' || CAST(percentage AS VARCHAR) || '% failed: ' ||
             concat_ws('; ', CASE WHEN error_rate > 0.2 THEN 'Error rate ' || CAST(round(error_rate, 6) AS VARCHAR) || ' > 0.2' END,
                       CASE WHEN latency_p95_ms > 150.0 THEN 'P95 latency ' || CAST(round(latency_p95_ms, 6) AS VARCHAR) || 'ms > 150.0ms' END,
                       CASE WHEN canary_health < 0.78 THEN 'Health ' || CAST(round(canary_health, 6) AS VARCHAR) || ' < 0.78' END) AS message
      FROM r WHERE status = 'failed')
SELECT 'error' AS level, unnest(['slack', 'email']) AS channel, message FROM f""")
def q_gate_alerts(spark, sf_dir):
    """Failed canary stages become error alerts, routed to their channels."""
    from cadence.operators.canary import stage_progression
    s = stage_progression(_rollout.request_log(spark, sf_dir), stage_minutes=_rollout.STAGE_MINUTES,
                          **_rollout.THRESHOLDS)
    s = s.withColumn("passed", F.col("status") != "failed").withColumn(
        "msg", F.concat(F.lit("Canary stage "), F.col("percentage").cast("string"), F.lit("% failed: "),
                        F.array_join("issues", "; ")))
    routed = route_alerts(gate_alerts(s, "passed", "msg"))
    return routed.select("level", "channel", "message")


@query("completion_summary", "M07", _DECISION_SQL.replace(
    "SELECT deployment_id, total_comparisons, round(confidence, 6) AS confidence,\n       CASE",
    "SELECT deployment_id, 'Shadow deployment analysis complete. Recommendation: ' || CASE").replace(
    "ELSE 'promote' END AS recommendation", "ELSE 'promote' END AS message"))
def q_completion_summary(spark, sf_dir):
    from cadence.operators.shadow import comparison_metrics, recommendation
    r = recommendation(comparison_metrics(_rollout.shadow_comparisons(spark, sf_dir), ["deployment_id"]))
    return completion_summary(r, "shadow").select("deployment_id", "message")
