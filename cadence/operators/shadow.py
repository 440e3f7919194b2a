"""Shadow rollout analytics.

Production and shadow predictions of a request are paired by an equi-join on the request
id (sort-merge or broadcast as AQE decides; skewed ids are split by AQE's skew join). The
comparison metrics are one grouped aggregate per deployment; the recommendation is a
``when`` chain evaluated in DOUBLE with the reference's order of subtraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.arrays import predictions_match, scalar_predictions_match
from cadence.functions.quantiles import exact_quantiles, grouped_quantiles, small_table
from cadence.functions.ranking import join_null_safe
from cadence.functions.stats import ratio
from cadence.session import checkpoint_dir

# Fixed values of the reference's shadow manager: prediction tolerance 0.1, latency
# regression factor 1.2, minimum sample 1000, confidence penalties 0.3 / 0.2 / 0.1 and the
# 0.5 confidence floor for promotion.
PREDICTION_DIFF_THRESHOLD = 0.1
LATENCY_REGRESSION_FACTOR = 1.2
MIN_COMPARISONS = 1000
PENALTY_MATCH, PENALTY_LATENCY, PENALTY_SAMPLE = 0.3, 0.2, 0.1
CONFIDENCE_FLOOR = 0.5


def pair_predictions(production: DataFrame, shadow: DataFrame, key: str = "request_id") -> DataFrame:
    """Inner equi-join of the two prediction logs on the request id.

    production: (key, [deployment_id], ts, prediction, latency_ms, [features])
    shadow:     (key, prediction, latency_ms)
    """
    s = shadow.select(key, F.col("prediction").alias("shadow_prediction"),
                      F.col("latency_ms").alias("shadow_latency_ms"))
    p = production.withColumnRenamed("prediction", "production_prediction") \
                  .withColumnRenamed("latency_ms", "production_latency_ms")
    return p.join(s, key, "inner")


def compare(pairs: DataFrame, threshold: float = PREDICTION_DIFF_THRESHOLD) -> DataFrame:
    """``predictions_match`` for array predictions (same length, |a-b| <= thr + 1e-5|b|)
    or scalar predictions (|a-b| <= thr)."""
    t = dict(pairs.dtypes)["production_prediction"]
    if t.startswith("array"):
        m = predictions_match(F.col("production_prediction"), F.col("shadow_prediction"), threshold)
    else:
        m = scalar_predictions_match(F.col("production_prediction"), F.col("shadow_prediction"), threshold)
    return pairs.withColumn("predictions_match", m)


def comparison_metrics(cmp: DataFrame, group: list[str] | None = None, exact: bool = True) -> DataFrame:
    """H02 + H03: totals, match rate, mismatch count, p50/p95/p99/mean latency of each arm and
    latency improvement (prod mean - shadow mean) / prod mean (0 when prod mean <= 0). A
    global aggregate over an empty log yields total 0 with a message."""
    g = group or []
    checkpoint_dir(cmp.sparkSession)
    # The log is usually a join: it runs once, and the narrow result is read from the written copy.
    cmp = cmp.select(*g, "predictions_match", "production_latency_ms", "shadow_latency_ms").checkpoint()
    agg = grouped_quantiles(cmp, [
        F.count(F.lit(1)).cast("bigint").alias("total_comparisons"),
        F.count_if(F.col("predictions_match")).cast("bigint").alias("__m"),
        F.avg("production_latency_ms").alias("production_latency_mean"),
        F.avg("shadow_latency_ms").alias("shadow_latency_mean")],
        ["production_latency_ms", "shadow_latency_ms"], [0.5, 0.95, 0.99], g, exact, names=["__qp", "__qs"])
    out = agg.select(
        *g, "total_comparisons",
        F.coalesce(ratio(F.col("__m"), F.col("total_comparisons")), F.lit(0.0)).alias("prediction_match_rate"),
        (F.col("total_comparisons") - F.col("__m")).alias("prediction_mismatch_count"),
        F.col("__qp")[0].alias("production_latency_p50"), F.col("__qp")[1].alias("production_latency_p95"),
        F.col("__qp")[2].alias("production_latency_p99"), "production_latency_mean",
        F.col("__qs")[0].alias("shadow_latency_p50"), F.col("__qs")[1].alias("shadow_latency_p95"),
        F.col("__qs")[2].alias("shadow_latency_p99"), "shadow_latency_mean",
        F.when(F.col("production_latency_mean") > 0,
               (F.col("production_latency_mean") - F.col("shadow_latency_mean")) / F.col("production_latency_mean"))
         .otherwise(F.lit(0.0)).alias("latency_improvement"))
    return out.withColumn("message", F.when(F.col("total_comparisons") == 0, F.lit("No comparisons collected yet")))


def recommendation(metrics: DataFrame, threshold: float = PREDICTION_DIFF_THRESHOLD) -> DataFrame:
    """Confidence 1.0 minus 0.3 (match rate < 1 - thr), 0.2 (shadow p95 > 1.2 x prod
    p95), 0.1 (fewer than 1000 comparisons), subtracted in that order in DOUBLE; issues and
    confidence < 0.5 -> do_not_promote; issues -> promote_with_caution; else promote."""
    mr = F.coalesce(F.col("prediction_match_rate"), F.lit(0.0))
    sp = F.coalesce(F.col("shadow_latency_p95"), F.lit(0.0))
    pp = F.coalesce(F.col("production_latency_p95"), F.lit(0.0))
    n = F.coalesce(F.col("total_comparisons"), F.lit(0))
    low_match = mr < F.lit(1 - threshold)
    slow = sp > pp * F.lit(LATENCY_REGRESSION_FACTOR)
    small = n < MIN_COMPARISONS
    conf = F.lit(1.0)
    conf = F.when(low_match, conf - F.lit(PENALTY_MATCH)).otherwise(conf)
    conf = F.when(slow, conf - F.lit(PENALTY_LATENCY)).otherwise(conf)
    conf = F.when(small, conf - F.lit(PENALTY_SAMPLE)).otherwise(conf)
    issues = F.array_compact(F.array(
        F.when(low_match, F.format_string("Low prediction match rate: %.2f%% (threshold: %.2f%%)",
                                          mr * 100, F.lit((1 - threshold) * 100))),
        F.when(slow, F.format_string("Latency regression: shadow P95 %.1fms vs production %.1fms", sp, pp)),
        F.when(small, F.format_string("Low sample size: %d comparisons", n))))
    out = metrics.withColumn("confidence", conf).withColumn("issues", issues)
    has = F.size("issues") > 0
    rec = (F.when(has & (F.col("confidence") < CONFIDENCE_FLOOR), "do_not_promote")
           .when(has, "promote_with_caution").otherwise("promote"))
    return out.withColumn("recommendation", rec).withColumn(
        "should_promote", F.col("recommendation") != "do_not_promote").withColumn(
        "sufficient_data", ~small)


def mismatch_samples(cmp: DataFrame, limit: int = 10, group: list[str] | None = None,
                     order: list[str] | None = None) -> DataFrame:
    """First ``limit`` mismatches in arrival order (per group when given). The rank
    filter is planned as a window-group limit (top-k per task before the shuffle)."""
    order = order or ["ts", "request_id"]
    mism = cmp.where(~F.col("predictions_match"))
    if not group:
        return mism.orderBy(*order).limit(limit)
    w = Window.partitionBy(*group).orderBy(*order)
    return mism.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= limit).drop("__rn")


def stop_summary(cmp: DataFrame, group: list[str]) -> DataFrame:
    """Status ``stopped`` with the number of comparisons collected per deployment."""
    return cmp.groupBy(*group).agg(F.count(F.lit(1)).cast("bigint").alias("comparisons_collected")) \
              .withColumn("status", F.lit("stopped"))


def prediction_drift(cmp: DataFrame, group: list[str] | None = None, eps: float = 1e-6) -> DataFrame:
    """Population-stability index between the predicted-class shares of the production
    and shadow models: sum over classes of (s - p) * ln(s / p), shares floored at ``eps``."""
    g = group or []
    cls = cmp.select(*g, F.explode(F.array(
        F.struct(F.lit("p").alias("arm"), F.col("production_class").alias("cls")),
        F.struct(F.lit("s").alias("arm"), F.col("shadow_class").alias("cls")))).alias("x")).select(*g, "x.*")
    counts = cls.groupBy(*g, "cls").agg(F.count_if(F.col("arm") == "p").alias("np"),
                                        F.count_if(F.col("arm") == "s").alias("ns"))
    w = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    shares = counts.withColumn("p", F.greatest(F.col("np") / F.sum("np").over(w), F.lit(eps))) \
                   .withColumn("s", F.greatest(F.col("ns") / F.sum("ns").over(w), F.lit(eps)))
    return shares.groupBy(*g).agg(F.sum((F.col("s") - F.col("p")) * F.ln(F.col("s") / F.col("p"))).alias("psi"))


def numeric_drift(base: DataFrame, current: DataFrame, columns: list[str], buckets: int = 10,
                  group: list[str] | None = None, eps: float = 1e-6) -> DataFrame:
    """H07 over numbers: (group..., column, psi, ks, n_base, n_current) of ``current`` against ``base``.

    Buckets are fitted on the base: their bounds are its exact quantiles, a value on a bound belonging below it. PSI
    is the sum over buckets of (c - b) ln(c / b), shares floored at ``eps``; KS is the greatest distance of the two
    cumulative shares at the bounds. NULL and NaN do not count. Groups or columns without a value on either
    side have no row. Both frames are reduced to a count per bucket before anything is shuffled."""
    g = group or []
    probs = [i / buckets for i in range(1, buckets)]
    bounds = small_table(exact_quantiles(base, columns, probs, g).select(*g, "column", F.col("quantiles").alias("__bounds")))
    long = None
    for side, df in (("base", base), ("current", current)):
        part = df.select(*g, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns])).alias("e"),
                         F.lit(side).alias("__side")).select(*g, "e.*", "__side")
        long = part if long is None else long.unionByName(part)
    long = join_null_safe(long.where(F.col("v").isNotNull() & ~F.isnan("v")), bounds, [*g, "column"], "inner")
    bucket = sum((F.when(F.col("v") > F.get("__bounds", F.lit(i)), 1).otherwise(0) for i in range(buckets - 1)), F.lit(0))
    counts = (long.select(*g, "column", "__side", bucket.alias("__bucket")).groupBy(*g, "column", "__bucket")
              .agg(F.count_if(F.col("__side") == "base").alias("b"), F.count_if(F.col("__side") == "current").alias("c")))
    # At most ``buckets`` rows a column and group; one that neither side fills adds nothing.
    w = Window.partitionBy(*g, "column")
    upto = w.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, 0)
    nb, nc = F.sum("b").over(w), F.sum("c").over(w)
    shares = counts.select(*g, "column", nb.alias("nb"), nc.alias("nc"), F.greatest(F.try_divide("b", nb), F.lit(eps)).alias("pb"),
                           F.greatest(F.try_divide("c", nc), F.lit(eps)).alias("pc"),
                           F.abs(F.try_divide(F.sum("b").over(upto), nb) - F.try_divide(F.sum("c").over(upto), nc)).alias("d"))
    return shares.where((F.col("nb") > 0) & (F.col("nc") > 0)).groupBy(*g, "column").agg(
        F.sum((F.col("pc") - F.col("pb")) * F.ln(F.col("pc") / F.col("pb"))).alias("psi"), F.max("d").alias("ks"),
        F.max("nb").cast("bigint").alias("n_base"), F.max("nc").cast("bigint").alias("n_current"))
