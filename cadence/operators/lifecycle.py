"""One continuous-training cycle as a driver program over the operators:
validate -> prepare and split -> train -> evaluate -> register -> promote, with run state in
the append-only registry tables. Every step is a Spark job; the driver only sees one-row
results (validity, metrics, decisions)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.prepare import prepare
from cadence.operators.registry import promotion_decisions
from cadence.operators.registry_store import RegistryStore
from cadence.operators.train import assemble, evaluate, fit, loss_history
from cadence.operators.validate import DataSchema, quality_gate, validate


def training_cycle(df: DataFrame, key: str | list[str], target: str, store: RegistryStore,
                   model_name: str, experiment: str = "continuous-training", model_type: str = "mlp",
                   schema: DataSchema | None = None, zero_as_missing_columns: list[str] | None = None,
                   test_size: float = 0.15, val_size: float = 0.15, min_quality: float = 0.8,
                   thresholds: dict | None = None, **model_params) -> dict:
    spark = df.sparkSession
    findings, summary = validate(df, schema)
    gate = quality_gate(summary, min_quality).first()
    if not gate["proceed"]:
        return {"status": "rejected", "errors": [r["message"] for r in findings.where("severity = 'error'").collect()]}
    exp_id = store.experiment(experiment)
    run_id = f"run_{uuid.uuid4().hex[:12]}"
    store.run_event(run_id, exp_id, model_name, "RUNNING")
    try:
        prepared, tgt, _ = prepare(df, key, target, test_size, val_size, exact_split=True,
                                   zero_as_missing_columns=zero_as_missing_columns)
        keys = [key] if isinstance(key, str) else list(key)
        feats = [c for c in prepared.columns if c not in keys + ["split", tgt]]
        data = assemble(prepared, feats, tgt)
        n_classes = data.agg(F.max("label")).first()[0]
        model = fit(data.where(F.col("split") == "train"), model_type, n_features=len(feats),
                    n_classes=int(n_classes) + 1, **model_params)
        val, _ = evaluate(model, data.where(F.col("split") == "val"))
        test, _ = evaluate(model, data.where(F.col("split") == "test"))
        v, t = val.first(), test.first()
        hist = loss_history(model)
        final_loss = hist.orderBy(F.col("iteration").desc()).first()["loss"] if hist is not None else None
        store.log_params(run_id, {"model_type": model_type, "features": ",".join(feats), **model_params})
        store.log_metrics(run_id, {"final_train_loss": final_loss, "final_accuracy": v["accuracy"],
                                   "final_f1_score": v["f1_score"], "accuracy": t["accuracy"],
                                   "f1_score": t["f1_score"], "precision": t["precision"], "recall": t["recall"]})
        version = store.register(model_name, run_id, {"accuracy": t["accuracy"], "f1_score": t["f1_score"]})
        decision = _decide(store, model_name, version, t, thresholds or {})
        if decision["new_stage"]:
            store.transition(model_name, version, decision["new_stage"])
        store.run_event(run_id, exp_id, model_name, "FINISHED")
        return {"status": "FINISHED", "run_id": run_id, "version": version, "model": model,
                "metrics": t.asDict(), **decision}
    except Exception as e:
        store.run_event(run_id, exp_id, model_name, "FAILED", str(e))
        raise


def _decide(store: RegistryStore, model_name: str, version: int, test_row, thresholds: dict) -> dict:
    spark = store.spark
    cand = spark.createDataFrame(
        [(model_name, version, test_row["accuracy"], test_row["f1_score"], test_row["precision"], test_row["recall"])],
        "model_name string, version bigint, accuracy double, f1_score double, precision double, recall double")
    prod = store.versions().where((F.col("model_name") == model_name) & (F.col("stage") == "Production"))
    champ = prod.join(store.latest_metrics().where(F.col("metric").isin("final_accuracy", "accuracy"))
                      .groupBy("run_id").pivot("metric", ["final_accuracy", "accuracy"]).agg(F.first("value")),
                      "run_id", "left") \
        .select("model_name", F.col("version").alias("champion_version"), "final_accuracy",
                F.col("accuracy").alias("champion_accuracy"))
    d = promotion_decisions(cand, champ, "auto", **thresholds).first()
    return {"passes": d["passes"], "is_better": d["is_better"], "reason": d["reason"],
            "new_stage": d["new_stage"], "previous_production_version": d["previous_production_version"]}
