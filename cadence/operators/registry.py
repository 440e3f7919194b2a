"""Model registry as tables, with promotion decisions as queries.

Tables (schemas in FIXTURES.md): experiments, runs, run_metrics, run_params, model_versions.
Writes are appends / anti-join inserts; "latest" lookups are ``max_by`` aggregates or
``row_number() = 1`` windows (planned as window-group limits), partitioned by model, so no
step gathers a whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.ranking import global_rank, running_totals
# Fixed values of the reference's promotion thresholds.
MIN_ACCURACY = 0.85
MIN_F1 = 0.80
MIN_PRECISION = 0.75
MIN_RECALL = 0.75
MAX_LATENCY_MS = 100.0
IMPROVEMENT_THRESHOLD = 0.01

STAGES = ("None", "Staging", "Production", "Archived")


def get_or_create_experiments(experiments: DataFrame, names: DataFrame,
                              artifact_root: str = "experiments") -> DataFrame:
    """(name, experiment_id) for every requested name; new names get ids after the
    current maximum, in name order. Returns the requested rows with ``created`` flag."""
    existing = experiments.select("name", "experiment_id")
    req = names.select("name").distinct()
    found = req.join(existing, "name", "inner").withColumn("created", F.lit(False))
    start = experiments.agg(F.coalesce(F.max("experiment_id"), F.lit(0)).alias("m")).first()["m"]
    new = req.join(existing, "name", "left_anti")
    new = global_rank(new, ["name"], "__rank")
    new = new.withColumn("experiment_id", (F.lit(start) + F.col("__rank") + 1).cast("long")).drop("__rank") \
             .withColumn("created", F.lit(True))
    return found.unionByName(new).withColumn(
        "artifact_location", F.concat_ws("/", F.lit(artifact_root), F.col("experiment_id").cast("string")))


def run_status(run_events: DataFrame) -> DataFrame:
    """Latest status per run = status of its newest event."""
    return run_events.groupBy("run_id").agg(F.max_by("status", F.struct("ts", "status")).alias("status"),
                                            F.min("ts").alias("started_at"), F.max("ts").alias("last_update"))


def latest_metrics(run_metrics: DataFrame) -> DataFrame:
    """Last logged value per (run, metric) - highest step, then newest timestamp."""
    return run_metrics.groupBy("run_id", "metric").agg(
        F.max_by("value", F.struct("step", "ts")).alias("value"), F.max("step").alias("step"))


def params_as_strings(params: DataFrame) -> DataFrame:
    """Every parameter value stored as a string."""
    return params.withColumn("value", F.col("value").cast("string"))


def metrics_description(metrics: dict[str, str] | None = None, cols: list[str] | None = None):
    """R05 description text: one ``name: 0.0000`` line per metric column."""
    cols = cols or []
    return F.array_join(F.array(*[F.format_string(f"{c}: %.4f", F.col(c)) for c in cols]), "\n")


def register_versions(model_versions: DataFrame, new: DataFrame, metric_cols: list[str] | None = None) -> DataFrame:
    """Next integer version per model = current max + rank of the new registration
    (by created_at, then run_id). Returns the new version rows (stage ``None``)."""
    cur = model_versions.groupBy("model_name").agg(F.max("version").alias("__max"))
    # One busy model may register most rows: its rank is spread over range partitions.
    ranked = running_totals(new.withColumn("__one", F.lit(1)), ["model_name"], ["created_at", "run_id"], "__one")
    out = (ranked.join(cur, "model_name", "left")
           .withColumn("version", (F.coalesce(F.col("__max"), F.lit(0)) + F.col("__before") + 1).cast("long"))
           .withColumn("stage", F.lit("None"))
           .withColumn("description", metrics_description(cols=metric_cols) if metric_cols else F.lit(None).cast("string")))
    return out.select("model_name", "version", "run_id", "stage", "description", "created_at")


def transition_stage(model_versions: DataFrame, targets: DataFrame, archive_existing: bool = True) -> DataFrame:
    """Targets (model_name, version, stage), any number per model; one row per version
    comes out. A version's own target wins (the last stage by name if it has several);
    versions already in a stage that one of their model's targets moves to become ``Archived``
    when ``archive_existing``."""
    own = targets.groupBy("model_name", "version").agg(F.max("stage").alias("__to"))
    out = model_versions.join(own, ["model_name", "version"], "left")
    new_stage = F.col("__to")
    if archive_existing:
        filled = targets.select("model_name", "stage").distinct().withColumn("__filled", F.lit(True))
        out = out.join(filled, ["model_name", "stage"], "left")
        new_stage = F.coalesce(new_stage, F.when(F.col("__filled"), F.lit("Archived")))
    return out.withColumn("stage", F.coalesce(new_stage, F.col("stage"))).select(*model_versions.columns)


def find_run(runs: DataFrame, name_col: str = "run_name") -> DataFrame:
    """Newest run per run name."""
    w = Window.partitionBy(name_col).orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    return runs.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def latest_versions(model_versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Latest version per (model, stage), or per model within one stage."""
    mv = model_versions if stage is None else model_versions.where(F.col("stage") == stage)
    return mv.groupBy("model_name", "stage").agg(
        F.max_by("version", "version").alias("version"),
        F.max_by("run_id", "version").alias("run_id"))


def resolve_model(model_versions: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (model_name, version?, stage?) resolve to a version: explicit version,
    else latest in the stage, else latest overall; ``source`` tells which."""
    latest_stage = model_versions.groupBy("model_name", "stage").agg(F.max("version").alias("__vs"))
    latest_any = model_versions.groupBy("model_name").agg(F.max("version").alias("__va"))
    exists = model_versions.select(F.col("model_name").alias("__me"), F.col("version").alias("__ve"),
                                   F.lit(True).alias("__hit"))
    r = (requests.join(latest_stage, ["model_name", "stage"], "left").join(latest_any, "model_name", "left")
         .join(exists, (F.col("model_name") == F.col("__me")) & (F.col("version") == F.col("__ve")), "left"))
    resolved = F.when(F.col("version").isNotNull(), F.when(F.col("__hit"), F.col("version"))) \
                .when(F.col("stage").isNotNull(), F.col("__vs")).otherwise(F.col("__va"))
    source = F.when(F.col("version").isNotNull(), F.lit("version")).when(F.col("stage").isNotNull(), F.lit("stage")) \
              .otherwise(F.lit("latest"))
    return r.select("model_name", F.col("version").alias("requested_version"), "stage",
                    resolved.cast("long").alias("resolved_version"), source.alias("source"))


def compare_versions(metrics: DataFrame, version_a: int, version_b: int,
                     lower_is_better: tuple[str, ...] = ()) -> DataFrame:
    """Metrics (model_name, version, metric, value); per model and metric present in
    both versions: a, b, diff = b - a, improvement = b > a (b < a for the metrics that
    ``lower_is_better`` names, such as losses and latencies)."""
    a = metrics.where(F.col("version") == version_a).select("model_name", "metric", F.col("value").alias("a"))
    b = metrics.where(F.col("version") == version_b).select("model_name", "metric", F.col("value").alias("b"))
    j = a.join(b, ["model_name", "metric"]).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    better = F.when(F.col("metric").isin(*lower_is_better), F.col("b") < F.col("a")).otherwise(F.col("b") > F.col("a")) \
        if lower_is_better else F.col("b") > F.col("a")
    return j.withColumn("diff", F.col("b") - F.col("a")).withColumn("improvement", better)


def threshold_gate(df: DataFrame, min_accuracy: float = MIN_ACCURACY, min_f1: float = MIN_F1,
                   min_precision: float = MIN_PRECISION, min_recall: float = MIN_RECALL,
                   max_latency_ms: float | None = None) -> DataFrame:
    """Absent (NULL or missing column) metrics pass; reasons joined by ``"; "``."""
    checks = []
    for col, label, thr in (("accuracy", "Accuracy", min_accuracy), ("f1_score", "F1 Score", min_f1),
                            ("precision", "Precision", min_precision), ("recall", "Recall", min_recall)):
        if col in df.columns:
            checks.append(F.when(F.col(col) < thr, F.format_string(f"{label} %.3f < {thr}", F.col(col))))
    if max_latency_ms is not None and "latency_ms" in df.columns:
        checks.append(F.when(F.col("latency_ms") > max_latency_ms,
                             F.format_string(f"Latency %.1fms > {max_latency_ms}ms", F.col("latency_ms"))))
    reasons = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    return df.withColumn("__r", reasons).withColumn("passes", F.size("__r") == 0).withColumn(
        "reason", F.when(F.size("__r") == 0, F.lit("All thresholds met")).otherwise(F.array_join("__r", "; "))).drop("__r")


def champion_challenger(candidates: DataFrame, champions: DataFrame,
                        improvement_threshold: float = IMPROVEMENT_THRESHOLD) -> DataFrame:
    """Candidates (model_name, version, accuracy); champions (model_name,
    champion_version, final_accuracy?, accuracy?). No champion -> better; missing metric ->
    not comparable; else better when candidate - champion >= threshold (absolute)."""
    ch_cols = champions.columns
    champ_val = F.coalesce(*[F.col(c) for c in ("final_accuracy", "champion_accuracy") if c in ch_cols]) \
        if any(c in ch_cols for c in ("final_accuracy", "champion_accuracy")) else F.lit(None).cast("double")
    ch = champions.select("model_name", "champion_version", champ_val.alias("champion_value"))
    j = candidates.join(ch, "model_name", "left")
    imp = F.col("accuracy") - F.col("champion_value")
    no_champ = F.col("champion_version").isNull()
    missing = F.col("accuracy").isNull() | F.col("champion_value").isNull()
    better = F.when(no_champ, True).when(missing, False).otherwise(imp >= improvement_threshold)
    pct = F.try_divide(imp * 100, F.col("champion_value"))
    reason = (F.when(no_champ, F.lit("No production model exists"))
              .when(missing, F.lit("Cannot compare: missing primary metric"))
              .when(imp >= improvement_threshold,
                    F.format_string("Improvement of %.3f (%s%%)", imp,
                                    F.coalesce(F.format_string("%.1f", pct), F.lit("n/a"))))
              .otherwise(F.format_string("No significant improvement: %.3f vs %.3f", F.col("accuracy"), F.col("champion_value"))))
    return j.withColumn("improvement", F.when(~no_champ & ~missing, imp)) \
            .withColumn("is_better", better).withColumn("reason", reason)


def promotion_decisions(candidates: DataFrame, champions: DataFrame, target: str = "auto", **thresholds) -> DataFrame:
    """Staging gate (R11) then production comparison (R12). ``target``:
    ``Staging`` -> gate only; ``Production`` -> comparison only; ``auto`` -> staging if the
    gate passes, then production if also better (else stays in staging)."""
    improvement = thresholds.pop("improvement_threshold", IMPROVEMENT_THRESHOLD)
    g = threshold_gate(candidates, **thresholds)
    c = champion_challenger(g, champions, improvement)
    if target == "Staging":
        stage = F.when(F.col("passes"), "Staging")
    elif target == "Production":
        stage = F.when(F.col("is_better"), "Production")
    elif target == "auto":
        stage = F.when(F.col("passes") & F.col("is_better"), "Production").when(F.col("passes"), "Staging")
    else:
        raise ValueError("target must be Staging, Production or auto")
    return c.withColumn("new_stage", stage).withColumn("promoted", F.col("new_stage").isNotNull()) \
            .withColumn("previous_production_version", F.when(F.col("new_stage") == "Production", F.col("champion_version")))


def final_metrics(run_id: DataFrame, train_loss: str, accuracy: str, f1: str) -> DataFrame:
    """The three metrics logged at run end, long form for run_metrics."""
    return run_id.select("run_id", F.explode(F.array(
        F.struct(F.lit("final_train_loss").alias("metric"), F.col(train_loss).cast("double").alias("value")),
        F.struct(F.lit("final_accuracy").alias("metric"), F.col(accuracy).cast("double").alias("value")),
        F.struct(F.lit("final_f1_score").alias("metric"), F.col(f1).cast("double").alias("value")))).alias("m")) \
        .select("run_id", "m.metric", "m.value")
