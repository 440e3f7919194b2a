"""Rollout queries: canary (C01-C11) and shadow (J01, H01-H07) over the events table.

Request log = events: request id = event_id, error = (event_type = 'error'), latency =
value, routing key = user_id. Shadow log: production p = value / (value + 50), shadow
p shifted by (user_id % 7 - 3) * 0.04 (no shift for views), shadow latency scaled per row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.arrays import argmax
from cadence.functions.columns import round_doubles
from cadence.operators.canary import (arm_metrics, assign_arm, canary_metrics, check_health,
                                      requests_from_events, rollout_outcome, stage_progression)
from cadence.operators.shadow import (compare, comparison_metrics, mismatch_samples,
                                      numeric_drift, pair_predictions, prediction_drift, recommendation,
                                      stop_summary)
from cadence.plans.catalog import query
from cadence.tables import table

CANARY_PCT = 25
THRESHOLDS = dict(error_rate_threshold=0.2, latency_threshold_ms=150.0, health_threshold=0.78)
STAGE_MINUTES = 6 * 24 * 60   # five stages cover the 30 days of events

_B = "(('0x' || substr(md5(CAST(user_id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100)"
_LOG = f"""lg AS (SELECT CAST(event_id AS VARCHAR) AS request_id, ts, user_id, event_type = 'error' AS is_error,
               value AS latency_ms, {_B} AS b FROM events)"""


def request_log(spark, sf_dir):
    return requests_from_events(table(spark, sf_dir, "events"))


@query("canary_assignment", "C01", f"""WITH {_LOG}
SELECT CASE WHEN b < {CANARY_PCT} THEN 'canary' ELSE 'production' END AS arm,
       CAST(count(*) AS BIGINT) AS requests, CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM lg GROUP BY 1""")
def q_canary_assignment(spark, sf_dir):
    a = assign_arm(request_log(spark, sf_dir), "user_id", CANARY_PCT)
    return a.groupBy("arm").agg(F.count(F.lit(1)).cast("bigint").alias("requests"),
                                F.count_distinct("user_id").cast("bigint").alias("users"))


_ARM_SQL = """CAST(count(*) AS BIGINT) AS requests_total,
       CAST(count(*) FILTER (WHERE NOT is_error) AS BIGINT) AS requests_success,
       CAST(count(*) FILTER (WHERE is_error) AS BIGINT) AS requests_error,
       round(count(*) FILTER (WHERE is_error) / count(*), 6) AS error_rate,
       round(quantile_cont(latency_ms, 0.5), 6) AS latency_p50_ms,
       round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95_ms,
       round(quantile_cont(latency_ms, 0.99), 6) AS latency_p99_ms"""


@query("arm_metrics", "C02", f"""WITH {_LOG}
SELECT CASE WHEN b < {CANARY_PCT} THEN 'canary' ELSE 'production' END AS arm, {_ARM_SQL},
       round(count(*) FILTER (WHERE NOT is_error) / count(*), 6) AS health FROM lg GROUP BY 1""")
def q_arm_metrics(spark, sf_dir):
    a = assign_arm(request_log(spark, sf_dir), "user_id", CANARY_PCT)
    return round_doubles(arm_metrics(a))


_CANARY_SQL = f"""WITH {_LOG}, m AS (
SELECT CAST(count(*) FILTER (WHERE b < {CANARY_PCT}) AS BIGINT) AS requests_total,
       CAST(count(*) FILTER (WHERE b < {CANARY_PCT} AND NOT is_error) AS BIGINT) AS requests_success,
       CAST(count(*) FILTER (WHERE b < {CANARY_PCT} AND is_error) AS BIGINT) AS requests_error,
       round(count(*) FILTER (WHERE b < {CANARY_PCT} AND is_error) / count(*) FILTER (WHERE b < {CANARY_PCT}), 6) AS error_rate,
       round(quantile_cont(latency_ms, 0.5) FILTER (WHERE b < {CANARY_PCT}), 6) AS latency_p50_ms,
       round(quantile_cont(latency_ms, 0.95) FILTER (WHERE b < {CANARY_PCT}), 6) AS latency_p95_ms,
       round(quantile_cont(latency_ms, 0.99) FILTER (WHERE b < {CANARY_PCT}), 6) AS latency_p99_ms,
       {CANARY_PCT} AS current_percentage,
       round(count(*) FILTER (WHERE b < {CANARY_PCT} AND NOT is_error) / count(*) FILTER (WHERE b < {CANARY_PCT}), 6) AS canary_health,
       round(count(*) FILTER (WHERE b >= {CANARY_PCT} AND NOT is_error) / count(*) FILTER (WHERE b >= {CANARY_PCT}), 6) AS production_health
FROM lg)"""


@query("canary_metrics", "C02", _CANARY_SQL + " SELECT * FROM m")
def q_canary_metrics(spark, sf_dir):
    return round_doubles(canary_metrics(request_log(spark, sf_dir), CANARY_PCT))


@query("canary_health", "C03", _CANARY_SQL + """
SELECT error_rate, latency_p95_ms, canary_health,
       concat_ws('; ', CASE WHEN error_rate > 0.2 THEN 'Error rate ' || CAST(round(error_rate, 6) AS VARCHAR) || ' > 0.2' END,
                 CASE WHEN latency_p95_ms > 150.0 THEN 'P95 latency ' || CAST(round(latency_p95_ms, 6) AS VARCHAR) || 'ms > 150.0ms' END,
                 CASE WHEN canary_health < 0.78 THEN 'Health ' || CAST(round(canary_health, 6) AS VARCHAR) || ' < 0.78' END) AS issues,
       NOT (error_rate > 0.2 OR latency_p95_ms > 150.0 OR canary_health < 0.78) AS healthy
FROM m""")
def q_canary_health(spark, sf_dir):
    m = round_doubles(canary_metrics(request_log(spark, sf_dir), CANARY_PCT))
    h = check_health(m, **THRESHOLDS)
    return h.select("error_rate", "latency_p95_ms", "canary_health",
                    F.array_join("issues", "; ").alias("issues"), "healthy")


_STAGES_SQL = f"""WITH {_LOG},
st AS (SELECT *, CAST(floor((epoch_us(ts) - epoch_us((SELECT min(ts) FROM events))) / {STAGE_MINUTES * 60 * 1_000_000}) AS INTEGER) AS stage FROM lg),
sp AS (SELECT st.*, [1, 5, 25, 50, 100][stage + 1] AS percentage FROM st WHERE stage < 5),
m0 AS (SELECT stage, {_ARM_SQL},
             count(*) FILTER (WHERE NOT is_error) / count(*) AS canary_health
      FROM sp WHERE b < percentage GROUP BY stage),
m AS (SELECT r.stage, r.percentage, COALESCE(requests_total, 0) AS requests_total, COALESCE(error_rate, 0) AS error_rate,
             latency_p95_ms, canary_health FROM (SELECT DISTINCT stage, percentage FROM
               (SELECT CAST(i AS INTEGER) AS stage, [1, 5, 25, 50, 100][i + 1] AS percentage
                FROM (SELECT unnest(range(0, (SELECT max(stage) + 1 FROM sp))) AS i))) r LEFT JOIN m0 USING (stage)),
h AS (SELECT *, NOT (error_rate > 0.2 OR COALESCE(latency_p95_ms, 0) > 150.0 OR COALESCE(canary_health, 0) < 0.78) AS healthy FROM m),
s AS (SELECT *, COALESCE(bool_or(NOT healthy) OVER (ORDER BY stage ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS fb FROM h)"""


@query("canary_stages", "C04", _STAGES_SQL + """
SELECT stage, percentage, requests_total, error_rate, latency_p95_ms, round(canary_health, 6) AS canary_health, healthy,
       CASE WHEN fb THEN 'skipped' WHEN healthy THEN 'passed' ELSE 'failed' END AS status FROM s""")
def q_canary_stages(spark, sf_dir):
    s = stage_progression(request_log(spark, sf_dir), stage_minutes=STAGE_MINUTES, **THRESHOLDS)
    return round_doubles(s.select("stage", "percentage", "requests_total", "error_rate", "latency_p95_ms",
                                  "canary_health", "healthy", "status"))


@query("canary_outcome", "C05", _STAGES_SQL + """,
r AS (SELECT *, CASE WHEN fb THEN 'skipped' WHEN healthy THEN 'passed' ELSE 'failed' END AS status FROM s)
SELECT array_to_string(list_sort(list_distinct(list(percentage) FILTER (WHERE status = 'passed'))), ',') AS stages_completed,
       CASE WHEN bool_or(status = 'failed') THEN 'rolled_back'
            WHEN COALESCE(max(percentage) FILTER (WHERE status = 'passed'), 0) = 100 THEN 'completed' ELSE 'in_progress' END AS status,
       CASE WHEN bool_or(status = 'failed') THEN 0 ELSE COALESCE(max(percentage) FILTER (WHERE status = 'passed'), 0) END AS current_percentage,
       max(percentage) FILTER (WHERE status = 'failed') AS previous_percentage
FROM r""")
def q_canary_outcome(spark, sf_dir):
    s = stage_progression(request_log(spark, sf_dir), stage_minutes=STAGE_MINUTES, **THRESHOLDS)
    o = rollout_outcome(s)
    return o.withColumn("stages_completed", F.array_join(F.col("stages_completed").cast("array<string>"), ","))


# ----------------------------------------------------------------------------------------
# Shadow

def shadow_logs(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    p = F.col("value") / (F.col("value") + F.lit(50.0))
    shift = F.when(F.col("event_type") == "view", F.lit(0.0)).otherwise(((F.col("user_id") % 7) - 3) * F.lit(0.04))
    q = p + shift
    factor = F.when(F.col("event_type") == "purchase", F.lit(1.5)).otherwise(F.lit(0.9) + (F.col("user_id") % 4) * F.lit(0.1))
    rid = F.col("event_id").cast("string").alias("request_id")
    prod = ev.select(rid, F.concat(F.lit("shadow_"), F.col("event_type")).alias("deployment_id"),
                     F.col("ts").cast("timestamp").alias("ts"), F.array(F.lit(1.0) - p, p).alias("prediction"),
                     F.col("value").alias("latency_ms"))
    shadow = ev.select(rid, F.array(F.lit(1.0) - q, q).alias("prediction"),
                       (F.col("value") * factor).alias("latency_ms"))
    return prod, shadow


def shadow_comparisons(spark, sf_dir):
    prod, shadow = shadow_logs(spark, sf_dir)
    return compare(pair_predictions(prod, shadow))


_SH = """sh AS (SELECT CAST(event_id AS VARCHAR) AS request_id, 'shadow_' || event_type AS deployment_id, ts,
               value / (value + 50.0) AS p,
               value / (value + 50.0) + CASE WHEN event_type = 'view' THEN 0.0 ELSE ((user_id % 7) - 3) * 0.04 END AS q,
               value AS pl,
               value * CASE WHEN event_type = 'purchase' THEN 1.5 ELSE 0.9 + (user_id % 4) * 0.1 END AS sl FROM events),
cmp AS (SELECT *, abs((1.0 - p) - (1.0 - q)) <= 0.1 + 1e-5 * abs(1.0 - q) AND abs(p - q) <= 0.1 + 1e-5 * abs(q) AS m FROM sh),
met AS (SELECT deployment_id, CAST(count(*) AS BIGINT) AS total_comparisons,
               count(*) FILTER (WHERE m) / count(*) AS prediction_match_rate,
               CAST(count(*) FILTER (WHERE NOT m) AS BIGINT) AS prediction_mismatch_count,
               quantile_cont(pl, 0.5) AS production_latency_p50, quantile_cont(pl, 0.95) AS production_latency_p95,
               quantile_cont(pl, 0.99) AS production_latency_p99, avg(pl) AS production_latency_mean,
               quantile_cont(sl, 0.5) AS shadow_latency_p50, quantile_cont(sl, 0.95) AS shadow_latency_p95,
               quantile_cont(sl, 0.99) AS shadow_latency_p99, avg(sl) AS shadow_latency_mean
        FROM cmp GROUP BY deployment_id)"""


@query("shadow_pairs", "J01 H01", f"""WITH {_SH}
SELECT deployment_id, CAST(count(*) AS BIGINT) AS pairs, CAST(count(*) FILTER (WHERE m) AS BIGINT) AS matches FROM cmp GROUP BY 1""")
def q_shadow_pairs(spark, sf_dir):
    c = shadow_comparisons(spark, sf_dir)
    return c.groupBy("deployment_id").agg(F.count(F.lit(1)).cast("bigint").alias("pairs"),
                                          F.count_if("predictions_match").cast("bigint").alias("matches"))


@query("shadow_metrics", "H02 H03", f"""WITH {_SH}
SELECT deployment_id, total_comparisons, round(prediction_match_rate, 6) AS prediction_match_rate, prediction_mismatch_count,
       round(production_latency_p50, 6) AS production_latency_p50, round(production_latency_p95, 6) AS production_latency_p95,
       round(production_latency_p99, 6) AS production_latency_p99, round(production_latency_mean, 6) AS production_latency_mean,
       round(shadow_latency_p50, 6) AS shadow_latency_p50, round(shadow_latency_p95, 6) AS shadow_latency_p95,
       round(shadow_latency_p99, 6) AS shadow_latency_p99, round(shadow_latency_mean, 6) AS shadow_latency_mean,
       round(CASE WHEN production_latency_mean > 0 THEN (production_latency_mean - shadow_latency_mean) / production_latency_mean ELSE 0.0 END, 6) AS latency_improvement,
       CASE WHEN total_comparisons = 0 THEN 'No comparisons collected yet' END AS message
FROM met""")
def q_shadow_metrics(spark, sf_dir):
    return round_doubles(comparison_metrics(shadow_comparisons(spark, sf_dir), ["deployment_id"]))


ORACLE_DECISION = f"""WITH {_SH},
f AS (SELECT deployment_id, total_comparisons, prediction_match_rate < 0.9 AS lm,
             shadow_latency_p95 > production_latency_p95 * 1.2 AS sl, total_comparisons < 1000 AS sm FROM met),
c AS (SELECT *, 1.0::DOUBLE - CASE WHEN lm THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END AS c1 FROM f),
d AS (SELECT *, c1 - CASE WHEN sl THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS c2 FROM c),
e AS (SELECT *, c2 - CASE WHEN sm THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END AS confidence FROM d)
SELECT deployment_id, total_comparisons, round(confidence, 6) AS confidence,
       CASE WHEN (lm OR sl OR sm) AND confidence < 0.5 THEN 'do_not_promote' WHEN lm OR sl OR sm THEN 'promote_with_caution'
            ELSE 'promote' END AS recommendation
FROM e"""


@query("shadow_decision", "H04", ORACLE_DECISION)
def q_shadow_decision(spark, sf_dir):
    m = comparison_metrics(shadow_comparisons(spark, sf_dir), ["deployment_id"])
    r = recommendation(m)
    return r.select("deployment_id", "total_comparisons", F.round("confidence", 6).alias("confidence"), "recommendation")


@query("shadow_mismatches", "H05", f"""WITH {_SH},
r AS (SELECT deployment_id, request_id, ts, row_number() OVER (PARTITION BY deployment_id ORDER BY ts, request_id) AS rn
      FROM cmp WHERE NOT m)
SELECT deployment_id, request_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM r WHERE rn <= 5""")
def q_shadow_mismatches(spark, sf_dir):
    s = mismatch_samples(shadow_comparisons(spark, sf_dir), 5, group=["deployment_id"])
    return s.select("deployment_id", "request_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query("shadow_stop", "H06", """SELECT 'shadow_' || event_type AS deployment_id, CAST(count(*) AS BIGINT) AS comparisons_collected,
'stopped' AS status FROM events GROUP BY 1""")
def q_shadow_stop(spark, sf_dir):
    return stop_summary(shadow_comparisons(spark, sf_dir), ["deployment_id"])


@query("shadow_drift", "H07", f"""WITH {_SH},
k AS (SELECT deployment_id, CASE WHEN p > 1.0 - p THEN 1 ELSE 0 END AS pc, CASE WHEN q > 1.0 - q THEN 1 ELSE 0 END AS sc FROM sh),
x AS (SELECT deployment_id, pc AS cls, 1 AS isp FROM k UNION ALL SELECT deployment_id, sc, 0 FROM k),
c AS (SELECT deployment_id, cls, count(*) FILTER (WHERE isp = 1) AS np, count(*) FILTER (WHERE isp = 0) AS ns FROM x GROUP BY 1, 2),
s AS (SELECT deployment_id, greatest(np / sum(np) OVER (PARTITION BY deployment_id), 1e-6) AS p,
             greatest(ns / sum(ns) OVER (PARTITION BY deployment_id), 1e-6) AS s FROM c)
SELECT deployment_id, round(sum((s - p) * ln(s / p)), 6) AS psi FROM s GROUP BY 1""")
def q_shadow_drift(spark, sf_dir):
    c = shadow_comparisons(spark, sf_dir).withColumns({
        "production_class": argmax(F.col("production_prediction")),
        "shadow_class": argmax(F.col("shadow_prediction"))})
    return round_doubles(prediction_drift(c, ["deployment_id"]))


_DRIFT_BUCKETS = 10


@query("numeric_drift", "H07", f"""
WITH e AS (SELECT event_type, value, ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) AS base,
                  CASE WHEN user_id % 3 = 0 THEN value * 1.2 + 1 ELSE value END AS moved FROM events),
u AS (SELECT event_type, 'value' AS col, value AS v, base FROM e UNION ALL
      SELECT event_type, 'moved', CASE WHEN base THEN value ELSE moved END, base FROM e),
q AS (SELECT event_type, col, quantile_cont(v, {[i / _DRIFT_BUCKETS for i in range(1, _DRIFT_BUCKETS)]}) AS bounds FROM u WHERE base GROUP BY 1, 2),
k AS (SELECT event_type, col, len(list_filter(bounds, lambda x: x < v)) AS bucket, count(*) FILTER (WHERE base) AS b, count(*) FILTER (WHERE NOT base) AS c
      FROM u JOIN q USING (event_type, col) WHERE v IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT event_type, col, sum(b) OVER w AS nb, sum(c) OVER w AS nc, greatest(b / sum(b) OVER w, 1e-6) AS pb, greatest(c / sum(c) OVER w, 1e-6) AS pc,
             abs(sum(b) OVER o / sum(b) OVER w - sum(c) OVER o / sum(c) OVER w) AS d
      FROM k WINDOW w AS (PARTITION BY event_type, col), o AS (PARTITION BY event_type, col ORDER BY bucket))
SELECT event_type, col AS "column", round(sum((pc - pb) * ln(pc / pb)), 6) AS psi, round(max(d), 6) AS ks,
       CAST(max(nb) AS BIGINT) AS n_base, CAST(max(nc) AS BIGINT) AS n_current FROM s GROUP BY 1, 2""")
def q_numeric_drift(spark, sf_dir):
    """Second half of the event log against the first, per event type: as it is, and with a third of the users moved."""
    ev = table(spark, sf_dir, "events")
    ends = ev.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    middle = ends["a"] + (ends["b"] - ends["a"]) / 2
    moved = F.when(F.col("user_id") % 3 == 0, F.col("value") * 1.2 + 1).otherwise(F.col("value"))
    base = ev.where(F.col("ts") < F.lit(middle)).select("event_type", "value", F.col("value").alias("moved"))
    current = ev.where(F.col("ts") >= F.lit(middle)).select("event_type", "value", moved.alias("moved"))
    return round_doubles(numeric_drift(base, current, ["value", "moved"], _DRIFT_BUCKETS, ["event_type"]))


# ----------------------------------------------------------------------------------------
# Gates and deployment records

from cadence.operators.canary import (deployment_config, deployment_status, evaluate_health,  # noqa: E402
                                      finalize, initialize, metric_gate, rollback)

_GROUPED = """g AS (SELECT 'deploy_' || CAST(user_id % 5 AS VARCHAR) AS deployment_id,
              count(*) FILTER (WHERE event_type <> 'error') / count(*) AS accuracy, avg(value) AS latency_ms,
              count(*) FILTER (WHERE event_type = 'error') / count(*) AS error_rate FROM events GROUP BY 1)"""


def _grouped(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    err = F.col("event_type") == "error"
    return ev.groupBy(F.concat(F.lit("deploy_"), (F.col("user_id") % 5).cast("string")).alias("deployment_id")).agg(
        (F.count_if(~err) / F.count(F.lit(1))).alias("accuracy"), F.avg("value").alias("latency_ms"),
        (F.count_if(err) / F.count(F.lit(1))).alias("error_rate"))


@query("metric_gate", "C08", f"""WITH {_GROUPED},
m AS (SELECT deployment_id, 'accuracy' AS metric, accuracy AS value, 0.8 AS threshold, accuracy >= 0.8 AS passed FROM g
      UNION ALL SELECT deployment_id, 'latency_ms', latency_ms, 100.0, latency_ms <= 100.0 FROM g
      UNION ALL SELECT deployment_id, 'error_rate', error_rate, 0.05, error_rate <= 0.05 FROM g)
SELECT deployment_id, metric, round(value, 6) AS value, CAST(threshold AS DOUBLE) AS threshold, passed,
       bool_and(passed) OVER (PARTITION BY deployment_id) AS all_passed FROM m""")
def q_metric_gate(spark, sf_dir):
    return round_doubles(metric_gate(_grouped(spark, sf_dir), ["deployment_id"]))


@query("health_eval", "C09", f"""WITH {_GROUPED}
SELECT deployment_id, accuracy >= 0.8 AND latency_ms <= 50.0 AS is_healthy,
       CASE WHEN accuracy >= 0.8 AND latency_ms <= 50.0 THEN 'Healthy' ELSE
         concat_ws('; ', CASE WHEN NOT accuracy >= 0.8 THEN printf('Success rate %.4f below %.4f', accuracy, 0.8) END,
                   CASE WHEN NOT latency_ms <= 50.0 THEN printf('Average latency %.2fms above %.2fms', latency_ms, 50.0) END) END AS reason
FROM g""")
def q_health_eval(spark, sf_dir):
    g = _grouped(spark, sf_dir).select("deployment_id", F.col("accuracy").alias("success_rate"),
                                       F.col("latency_ms").alias("avg_latency_ms"))
    return evaluate_health(g, 0.8, 50.0).select("deployment_id", "is_healthy", "reason")


@query("deployment_config", "C10", """
SELECT 'deploy_' || strftime(o_orderdate, '%Y%m%d') || '_' || CAST(o_orderkey AS VARCHAR) AS deployment_id,
       CASE WHEN o_orderstatus = 'F' THEN 'shadow' ELSE 'canary' END AS strategy FROM orders""")
def q_deployment_config(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    req = o.select(F.col("o_orderkey").cast("string").alias("model_version"),
                   F.when(F.col("o_orderstatus") == "F", "shadow").alias("strategy"),
                   F.col("o_orderdate").alias("requested_at"))
    return deployment_config(req).select("deployment_id", "strategy")


@query("deployment_init", "C11", """
WITH ex AS (SELECT 'dep_' || CAST(o_orderkey AS VARCHAR) AS deployment_id, 'active' AS status FROM orders WHERE o_orderstatus = 'F'),
nw AS (SELECT 'dep_' || CAST(o_orderkey AS VARCHAR) AS deployment_id FROM orders WHERE o_orderstatus <> 'O'),
al AS (SELECT deployment_id, status FROM ex UNION ALL
       SELECT deployment_id, 'initialized' FROM nw WHERE deployment_id NOT IN (SELECT deployment_id FROM ex))
SELECT status, CAST(count(*) AS BIGINT) AS n FROM al GROUP BY 1""")
def q_deployment_init(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    dep = F.concat(F.lit("dep_"), F.col("o_orderkey").cast("string")).alias("deployment_id")
    existing = o.where(F.col("o_orderstatus") == "F").select(dep, F.lit("active").alias("status"),
                                                             F.lit(100).alias("current_percentage"))
    new = o.where(F.col("o_orderstatus") != "O").select(dep)
    return initialize(existing, new).groupBy("status").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# ----------------------------------------------------------------------------------------
# Deployment records: one per event type, its percentage the canary share of its users

_DEP = f"""dep AS (SELECT 'deploy_' || event_type AS deployment_id, CASE WHEN event_type = 'view' THEN 100
                       ELSE CAST(count(DISTINCT user_id) % 5 * 25 AS INTEGER) END AS current_percentage FROM events GROUP BY event_type)"""


def deployment_records(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("event_type").agg(F.count_distinct("user_id").alias("u")).select(
        F.concat(F.lit("deploy_"), F.col("event_type")).alias("deployment_id"), F.lit("in_progress").alias("status"),
        F.when(F.col("event_type") == "view", 100).otherwise((F.col("u") % 5 * 25).cast("int")).alias("current_percentage"),
        F.array(F.lit(25), F.lit(1), F.lit(25)).alias("stages_completed"))


@query("rollback", "C05", f"""WITH {_DEP}
SELECT deployment_id, CASE WHEN deployment_id = 'deploy_error' THEN 'rolled_back' ELSE 'in_progress' END AS status,
       CASE WHEN deployment_id = 'deploy_error' THEN 0 ELSE current_percentage END AS current_percentage,
       CASE WHEN deployment_id = 'deploy_error' THEN current_percentage END AS previous_percentage FROM dep""")
def q_rollback(spark, sf_dir):
    d = deployment_records(spark, sf_dir)
    out = rollback(d, d.where(F.col("deployment_id") == "deploy_error").select("deployment_id"))
    return out.select("deployment_id", "status", "current_percentage", "previous_percentage")


@query("finalize", "C06", f"""WITH {_DEP}
SELECT deployment_id, CASE WHEN current_percentage = 100 THEN 'completed' ELSE 'in_progress' END AS status,
       CASE WHEN current_percentage <> 100 THEN 'Cannot finalize: deployment at ' || current_percentage || '%, not 100%' END AS error
FROM dep""")
def q_finalize(spark, sf_dir):
    return finalize(deployment_records(spark, sf_dir)).select("deployment_id", "status", "error")


@query("deployment_status", "C07", f"""WITH {_DEP}, req AS (SELECT deployment_id FROM dep UNION SELECT 'deploy_' || r_name FROM region)
SELECT req.deployment_id, COALESCE(CASE WHEN dep.deployment_id IS NOT NULL THEN 'in_progress' END, 'not_found') AS status,
       dep.current_percentage, CASE WHEN dep.deployment_id IS NOT NULL THEN '1,25' END AS stages_completed
FROM req LEFT JOIN dep USING (deployment_id)""")
def q_deployment_status(spark, sf_dir):
    d = deployment_records(spark, sf_dir)
    asked = d.select("deployment_id").unionByName(table(spark, sf_dir, "region").select(
        F.concat(F.lit("deploy_"), F.col("r_name")).alias("deployment_id"))).distinct()
    out = deployment_status(d, asked)
    return out.withColumn("stages_completed", F.array_join(F.col("stages_completed").cast("array<string>"), ","))
