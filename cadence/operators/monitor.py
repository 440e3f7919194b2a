"""Monitoring aggregates (M01-M07): counters, histograms, last-value gauges and alert routing,
all computed from event tables with grouped aggregates (map-side combined)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The default histogram bucket bounds of the Prometheus client the reference
# uses, and the reference's alert-level -> channel routing (other levels go to slack).
DEFAULT_BUCKETS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
ROUTES = {
    "info": ["slack"],
    "warning": ["slack"],
    "error": ["slack", "email"],
    "critical": ["slack", "email", "webhook"],
}
DEFAULT_ROUTE = ["slack"]


def run_counter(runs: DataFrame, label: str = "status") -> DataFrame:
    """Counter per label value."""
    return runs.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def histogram_counts(runs: DataFrame, value: str, buckets: list[float] | None = None, group: list[str] | None = None) -> DataFrame:
    """One row per group: values at or below each bucket's bound (b0, b1, ...), their number and their sum.
    Rows of several tables add up."""
    aggs = [F.count_if(F.col(value) <= F.lit(x)).cast("bigint").alias(f"b{i}") for i, x in enumerate(sorted(buckets or DEFAULT_BUCKETS))]
    return runs.groupBy(*(group or [])).agg(*aggs, F.count(F.col(value)).cast("bigint").alias("__inf"), F.sum(value).alias("__sum"))


def histogram_rows(counts: DataFrame, buckets: list[float] | None = None, group: list[str] | None = None) -> DataFrame:
    """Cumulative ``le`` buckets (+Inf last) with sum and total, a row each."""
    g = group or []
    les = [F.struct(F.lit(str(x)).alias("le"), F.col(f"b{i}").alias("count")) for i, x in enumerate(sorted(buckets or DEFAULT_BUCKETS))]
    les.append(F.struct(F.lit("+Inf").alias("le"), F.col("__inf").alias("count")))
    return counts.select(*g, F.explode(F.array(*les)).alias("h"), F.col("__sum").alias("sum"),
                         F.col("__inf").alias("total")).select(*g, "h.le", "h.count", "sum", "total")


def duration_histogram(runs: DataFrame, value: str = "duration_seconds",
                       buckets: list[float] | None = None, group: list[str] | None = None) -> DataFrame:
    """Cumulative ``le`` buckets (+Inf last) with sum and count, in one aggregate pass."""
    return histogram_rows(histogram_counts(runs, value, buckets, group), buckets, group)


def last_gauge(updates: DataFrame, labels: list[str], value: str, ts: str = "ts") -> DataFrame:
    """Gauge value per label set = last write (newest ts; ties by value)."""
    return updates.groupBy(*labels).agg(F.max_by(value, F.struct(ts, value)).alias(value))


def deployment_gauge(updates: DataFrame) -> DataFrame:
    """(deployment_id, strategy) -> 1 when the last update says active, else 0."""
    g = last_gauge(updates.withColumn("__a", F.col("active").cast("int")), ["deployment_id", "strategy"], "__a")
    return g.withColumnRenamed("__a", "value")


def route_alerts(alerts: DataFrame, level: str = "level") -> DataFrame:
    """One row per (alert, channel) by level, plus the formatted message
    ``[LEVEL] <iso time>\\n\\n<message>``."""
    m = F.create_map(*[x for k, v in ROUTES.items() for x in (F.lit(k), F.array(*[F.lit(c) for c in v]))])
    lv = F.lower(F.col(level))
    channels = F.coalesce(F.element_at(m, lv), F.array(*[F.lit(c) for c in DEFAULT_ROUTE]))
    return alerts.withColumn("channel", F.explode(channels)).withColumn(
        "formatted", F.concat(F.lit("["), F.upper(F.col(level)), F.lit("] "),
                              F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("\n\n"), F.col("message")))


def gate_alerts(results: DataFrame, passed: str, message: str, level: str = "error") -> DataFrame:
    """Failed gates become alerts (then route with ``route_alerts``)."""
    return results.where(~F.col(passed)).select(F.lit(level).alias("level"), F.col(message).alias("message"),
                                                 F.current_timestamp().alias("ts"))


def completion_summary(df: DataFrame, kind: str = "training") -> DataFrame:
    """Completion message per run (training) or deployment (shadow / canary)."""
    if kind == "training":
        msg = F.format_string("Training Pipeline Completed Successfully! Model: %s Version: %s Stage: %s Promoted: %s",
                              F.col("model_name"), F.col("model_version").cast("string"), F.col("stage"),
                              F.col("promoted").cast("string"))
    elif kind == "shadow":
        msg = F.format_string("Shadow deployment analysis complete. Recommendation: %s", F.col("recommendation"))
    else:
        msg = F.format_string("Canary deployment completed for model version %s", F.col("model_version").cast("string"))
    return df.withColumn("message", msg)
