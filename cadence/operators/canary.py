"""Canary rollout analytics over a request log.

Request log columns: ``request_id, ts, user_id (or another routing key), is_error,
latency_ms`` plus an optional ``deployment_id``. Traffic assignment is a sticky md5 bucket
(monotone in the percentage: a user in the canary at 5 % stays in it at 25 %). Metrics are
one grouped aggregate per (deployment, arm / stage) with map-side combine; percentiles are
exact by default and ``exact=False`` switches to a fixed-size sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.hashing import hash_bucket
from cadence.functions.quantiles import grouped_quantiles
from cadence.functions.ranking import join_null_safe
from cadence.functions.stats import ratio

# Fixed values of the reference's canary manager: stage percentages, stage length and
# health thresholds (error rate, p95 latency in ms, health score).
STAGES = [1, 5, 25, 50, 100]
STAGE_MINUTES = 30
ERROR_RATE_THRESHOLD = 0.05
LATENCY_THRESHOLD_MS = 500.0
HEALTH_THRESHOLD = 0.95

BROADCAST_GROUPS = 100_000   # deployments table broadcast limit (rows)


def requests_from_events(events: DataFrame) -> DataFrame:
    """Request-log view of the events table: error = event_type 'error', latency = value."""
    return events.select(F.col("event_id").cast("string").alias("request_id"),
                         F.col("ts").cast("timestamp").alias("ts"), "user_id",
                         (F.col("event_type") == "error").alias("is_error"),
                         F.col("value").alias("latency_ms"))


def assign_arm(df: DataFrame, key: str, percentage: float | Column, seed: int = 42,
               out: str = "arm") -> DataFrame:
    """``canary`` when md5 bucket (0-99) of the key < percentage, else ``production``."""
    p = percentage if isinstance(percentage, Column) else F.lit(percentage)
    return df.withColumn(out, F.when(hash_bucket(F.col(key), 100, seed) < p, "canary").otherwise("production"))


def _traffic(df: DataFrame, groups: list[str], exact: bool) -> DataFrame:
    """Counts per group plus exact (or sketched) latency p50 / p95 / p99 as ``__q``."""
    aggs = [F.count(F.lit(1)).cast("bigint").alias("requests_total"),
            F.count_if(~F.col("is_error")).cast("bigint").alias("requests_success"),
            F.count_if(F.col("is_error")).cast("bigint").alias("requests_error")]
    return grouped_quantiles(df, aggs, ["latency_ms"], [0.5, 0.95, 0.99], groups, exact, names=["__q"])


def _finish(df: DataFrame) -> DataFrame:
    return (df.withColumn("error_rate", F.coalesce(ratio(F.col("requests_error"), F.col("requests_total")), F.lit(0.0)))
            .withColumn("latency_p50_ms", F.col("__q")[0]).withColumn("latency_p95_ms", F.col("__q")[1])
            .withColumn("latency_p99_ms", F.col("__q")[2]).drop("__q"))


def arm_metrics(log: DataFrame, group: list[str] | None = None, exact: bool = True) -> DataFrame:
    """C02 per arm: totals, error rate, latency percentiles, health (= success rate of the arm)."""
    g = (group or []) + ["arm"]
    out = _finish(_traffic(log, g, exact))
    return out.withColumn("health", F.coalesce(ratio(F.col("requests_success"), F.col("requests_total")), F.lit(0.0)))


def canary_metrics(log: DataFrame, percentage: float, key: str = "user_id",
                   group: list[str] | None = None, exact: bool = True) -> DataFrame:
    """C02 in the reference's shape, one row per deployment: canary-arm traffic figures plus
    canary_health and production_health (success rate of each arm)."""
    g = group or []
    a = assign_arm(log, key, percentage)
    canary = F.col("arm") == "canary"
    a = a.withColumn("__canary_latency", F.when(canary, F.col("latency_ms")))
    out = grouped_quantiles(a, [
        F.count_if(canary).cast("bigint").alias("requests_total"),
        F.count_if(canary & ~F.col("is_error")).cast("bigint").alias("requests_success"),
        F.count_if(canary & F.col("is_error")).cast("bigint").alias("requests_error"),
        F.count_if(~canary).cast("bigint").alias("__pt"),
        F.count_if(~canary & ~F.col("is_error")).cast("bigint").alias("__ps")],
        ["__canary_latency"], [0.5, 0.95, 0.99], g, exact, names=["__q"])
    return (_finish(out).withColumn("current_percentage", F.lit(percentage))
            .withColumn("canary_health", ratio(F.col("requests_success"), F.col("requests_total")))
            .withColumn("production_health", ratio(F.col("__ps"), F.col("__pt"))).drop("__pt", "__ps"))


def check_health(metrics: DataFrame, error_rate_threshold: float = ERROR_RATE_THRESHOLD,
                 latency_threshold_ms: float = LATENCY_THRESHOLD_MS,
                 health_threshold: float = HEALTH_THRESHOLD) -> DataFrame:
    """Strict comparisons; missing error rate / latency count as 0 (pass), missing
    health as 0 (fail). Adds ``healthy`` and ``issues`` (array of messages)."""
    er = F.coalesce(F.col("error_rate"), F.lit(0.0))
    p95 = F.coalesce(F.col("latency_p95_ms"), F.lit(0.0))
    h = F.coalesce(F.col("canary_health"), F.lit(0.0))

    def num(c):
        return F.round(c, 6).cast("string")

    issues = F.array_compact(F.array(
        F.when(er > error_rate_threshold, F.concat(F.lit("Error rate "), num(er), F.lit(f" > {error_rate_threshold}"))),
        F.when(p95 > latency_threshold_ms, F.concat(F.lit("P95 latency "), num(p95), F.lit(f"ms > {latency_threshold_ms}ms"))),
        F.when(h < health_threshold, F.concat(F.lit("Health "), num(h), F.lit(f" < {health_threshold}")))))
    return metrics.withColumn("issues", issues).withColumn("healthy", F.size("issues") == 0)


def stage_progression(log: DataFrame, stages: list[int] | None = None, stage_minutes: int = STAGE_MINUTES,
                      key: str = "user_id", group: list[str] | None = None, exact: bool = True,
                      **thresholds) -> DataFrame:
    """Stage i covers [t0 + i*d, t0 + (i+1)*d) of each deployment's log (t0 = first
    request) and routes ``stages[i]`` % of keys to the canary. Per stage: canary metrics,
    health, and status - ``passed``, ``failed`` (first unhealthy stage, triggers rollback) or
    ``skipped`` (after a failure), found with ``bool_or`` over the preceding stages. Stages up to
    the last one that the log reaches are listed; one without canary requests has no health
    and fails."""
    stages = stages or STAGES
    g = group or []
    pct = F.element_at(F.array(*[F.lit(p) for p in stages]), F.col("stage") + 1)
    if g:
        # First request per deployment: a grouped aggregate (one row per deployment), joined
        # back by broadcast only under a checked row count.
        starts = log.groupBy(*g).agg(F.min("ts").alias("__t0"))
        n = starts.count()
        base = log.join(F.broadcast(starts) if n <= BROADCAST_GROUPS else starts, g)
    else:
        start = log.agg(F.min("ts").alias("t")).first()["t"]  # one value
        base = log.withColumn("__t0", F.lit(start))
    staged = (base.withColumn("stage", F.floor((F.unix_micros(F.col("ts")) - F.unix_micros(F.col("__t0")))
                                                / F.lit(stage_minutes * 60 * 1_000_000)).cast("int"))
              .where(F.col("stage") < len(stages)).withColumn("percentage", pct))
    canary = staged.where(hash_bucket(F.col(key), 100) < F.col("percentage"))
    per = _finish(_traffic(canary, g + ["stage", "percentage"], exact))
    reached = staged.groupBy(*g).agg(F.max("stage").alias("__last"))
    listed = (reached.where(F.col("__last").isNotNull())
              .select(*g, F.explode(F.sequence(F.lit(0), F.col("__last").cast("int"))).alias("stage"))
              .withColumn("percentage", pct))
    per = join_null_safe(listed, per, g + ["stage", "percentage"])
    per = per.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in ("requests_total", "requests_success", "requests_error")})
    per = per.withColumn("error_rate", F.coalesce("error_rate", F.lit(0.0)))
    per = per.withColumn("canary_health", ratio(F.col("requests_success"), F.col("requests_total")))
    per = check_health(per, **thresholds)
    w = (Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))).orderBy("stage").rowsBetween(Window.unboundedPreceding, -1)
    failed_before = F.coalesce(F.bool_or(~F.col("healthy")).over(w), F.lit(False))
    return per.withColumn("status", F.when(failed_before, "skipped")
                          .when(F.col("healthy"), "passed").otherwise("failed"))


def rollout_outcome(stages_df: DataFrame, group: list[str] | None = None) -> DataFrame:
    """C05-C07 from the stage table: final percentage, status (completed / rolled_back /
    in_progress), previous percentage at rollback and the ordered stages completed."""
    g = group or []
    passed = F.when(F.col("status") == "passed", F.col("percentage"))
    out = stages_df.groupBy(*g).agg(
        F.array_sort(F.collect_set(passed)).alias("stages_completed"),
        F.bool_or(F.col("status") == "failed").alias("__failed"),
        F.max(F.when(F.col("status") == "failed", F.col("percentage"))).alias("__fail_pct"),
        F.max(passed).alias("__max_passed"))
    return out.select(
        *g, "stages_completed",
        F.when(F.col("__failed"), "rolled_back")
         .when(F.coalesce(F.col("__max_passed"), F.lit(0)) == 100, "completed").otherwise("in_progress").alias("status"),
        F.when(F.col("__failed"), F.lit(0)).otherwise(F.coalesce(F.col("__max_passed"), F.lit(0))).alias("current_percentage"),
        F.when(F.col("__failed"), F.col("__fail_pct")).alias("previous_percentage"))


def rollback(deployments: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Percentage 0 and status rolled_back for the given ids (all when None); the
    previous percentage is kept."""
    hit = F.lit(True)
    if ids is not None:
        deployments = deployments.join(ids.select("deployment_id").withColumn("__hit", F.lit(True)),
                                       "deployment_id", "left")
        hit = F.coalesce(F.col("__hit"), F.lit(False))
    out = deployments.withColumns({
        "previous_percentage": F.when(hit, F.col("current_percentage")),
        "status": F.when(hit, F.lit("rolled_back")).otherwise(F.col("status")),
        "current_percentage": F.when(hit, F.lit(0)).otherwise(F.col("current_percentage"))})
    return out.drop("__hit") if ids is not None else out


def finalize(deployments: DataFrame, strict: bool = False) -> DataFrame:
    """``completed`` only at 100 %; otherwise an error (raised when ``strict``)."""
    at_full = F.col("current_percentage") == 100
    msg = F.format_string("Cannot finalize: deployment at %d%%, not 100%%", F.col("current_percentage"))
    if strict:
        return deployments.withColumn("status", F.when(at_full, F.lit("completed")).otherwise(F.raise_error(msg)))
    return deployments.withColumns({"status": F.when(at_full, F.lit("completed")).otherwise(F.col("status")),
                                    "error": F.when(~at_full, msg)})


def deployment_status(deployments: DataFrame, requested: DataFrame) -> DataFrame:
    """Status per requested id; unknown ids get ``not_found``."""
    d = deployments.select("deployment_id", "status", "current_percentage",
                           F.array_sort(F.array_distinct(F.col("stages_completed"))).alias("stages_completed"))
    return requested.select("deployment_id").join(d, "deployment_id", "left").withColumn(
        "status", F.coalesce(F.col("status"), F.lit("not_found")))


# Fixed values of the reference demo's metric gate (inclusive bounds).
GATE_MIN_ACCURACY = 0.80
GATE_MAX_LATENCY_MS = 100.0
GATE_MAX_ERROR_RATE = 0.05


def metric_gate(metrics: DataFrame, group: list[str] | None = None, min_accuracy: float = GATE_MIN_ACCURACY,
                max_latency_ms: float = GATE_MAX_LATENCY_MS, max_error_rate: float = GATE_MAX_ERROR_RATE) -> DataFrame:
    """Per-metric rows (metric, value, threshold, passed) with inclusive bounds and an
    overall ``all_passed`` per group."""
    g = group or []
    rows = metrics.select(*g, F.explode(F.array(
        F.struct(F.lit("accuracy").alias("metric"), F.col("accuracy").cast("double").alias("value"),
                 F.lit(min_accuracy).alias("threshold"), (F.col("accuracy") >= min_accuracy).alias("passed")),
        F.struct(F.lit("latency_ms").alias("metric"), F.col("latency_ms").cast("double").alias("value"),
                 F.lit(max_latency_ms).alias("threshold"), (F.col("latency_ms") <= max_latency_ms).alias("passed")),
        F.struct(F.lit("error_rate").alias("metric"), F.col("error_rate").cast("double").alias("value"),
                 F.lit(max_error_rate).alias("threshold"), (F.col("error_rate") <= max_error_rate).alias("passed"))
    )).alias("m")).select(*g, "m.*")
    if g:
        return rows.withColumn("all_passed", F.bool_and("passed").over(Window.partitionBy(*g)))
    overall = rows.agg(F.bool_and("passed")).first()[0]   # one boolean
    return rows.withColumn("all_passed", F.lit(overall))


def evaluate_health(df: DataFrame, min_success_rate: float = 0.95, max_avg_latency_ms: float = 100.0) -> DataFrame:
    """Healthy when success_rate >= min and avg_latency_ms <= max, with a reason."""
    ok_s = F.col("success_rate") >= min_success_rate
    ok_l = F.col("avg_latency_ms") <= max_avg_latency_ms
    reason = F.concat_ws("; ", F.array_compact(F.array(
        F.when(~ok_s, F.format_string("Success rate %.4f below %.4f", F.col("success_rate"), F.lit(min_success_rate))),
        F.when(~ok_l, F.format_string("Average latency %.2fms above %.2fms", F.col("avg_latency_ms"), F.lit(max_avg_latency_ms))))))
    return df.withColumn("is_healthy", ok_s & ok_l).withColumn(
        "reason", F.when(ok_s & ok_l, F.lit("Healthy")).otherwise(reason))


def deployment_config(requests: DataFrame, strict: bool = True) -> DataFrame:
    """``deploy_<yyyyMMdd>_<version>``, strategy default ``canary``; a missing version
    is an error."""
    v = F.col("model_version")
    if strict:
        v = F.coalesce(v, F.raise_error(F.lit("model_version is required")).cast("string"))
    return requests.withColumns({
        "deployment_id": F.concat_ws("_", F.lit("deploy"), F.date_format(F.col("requested_at"), "yyyyMMdd"), v),
        "strategy": F.coalesce(F.col("strategy"), F.lit("canary"))})


def initialize(deployments: DataFrame, new: DataFrame, status: str = "initialized") -> DataFrame:
    """C11: new deployments (0 %, ``initialized``) appended unless the id exists already."""
    fresh = new.join(deployments.select("deployment_id"), "deployment_id", "left_anti").withColumns({
        "current_percentage": F.lit(0), "status": F.lit(status),
        "stages_completed": F.array().cast("array<int>")})
    return deployments.unionByName(fresh, allowMissingColumns=True)
