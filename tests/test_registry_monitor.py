import datetime as dt

from cadence.operators.monitor import duration_histogram, route_alerts
from cadence.operators.registry import (champion_challenger, compare_versions, latest_versions,
                                        register_versions, threshold_gate, transition_stage)


def test_threshold_gate_pass_fail(spark):
    m = spark.createDataFrame([(0.90, 0.85), (0.80, 0.75)], "accuracy double, f1_score double")
    a = threshold_gate(m, min_accuracy=0.80, min_f1=0.75).collect()
    assert a[0]["passes"] and a[0]["reason"] == "All thresholds met" and a[1]["passes"]
    b = threshold_gate(m, min_accuracy=0.90, min_f1=0.85).collect()
    assert b[0]["passes"] and not b[1]["passes"]
    assert b[1]["reason"] == "Accuracy 0.800 < 0.9; F1 Score 0.750 < 0.85"


def test_champion_rules(spark):
    cand = spark.createDataFrame([("m1", 3, 0.90), ("m2", 2, 0.90), ("m3", 1, None), ("m4", 5, 0.905)],
                                 "model_name string, version long, accuracy double")
    champ = spark.createDataFrame([("m2", 1, 0.85, None), ("m3", 1, 0.8, None), ("m4", 4, None, 0.90)],
                                  "model_name string, champion_version long, final_accuracy double, champion_accuracy double")
    r = {x["model_name"]: x for x in champion_challenger(cand, champ).collect()}
    assert r["m1"]["is_better"] and r["m1"]["reason"] == "No production model exists"
    assert r["m2"]["is_better"] and r["m2"]["reason"].startswith("Improvement of 0.050")
    assert not r["m3"]["is_better"] and r["m3"]["reason"] == "Cannot compare: missing primary metric"
    assert not r["m4"]["is_better"]     # +0.005 < 0.01 absolute


def test_register_and_transition(spark):
    mv = spark.createDataFrame([("m", 1, "r1", "Production"), ("m", 2, "r2", "Staging")],
                               "model_name string, version long, run_id string, stage string")
    new = spark.createDataFrame([("m", "r3", dt.datetime(2024, 1, 2), 0.91234), ("n", "r4", dt.datetime(2024, 1, 1), 0.5)],
                                "model_name string, run_id string, created_at timestamp, accuracy double")
    reg = {x["run_id"]: x for x in register_versions(mv, new, ["accuracy"]).collect()}
    assert reg["r3"]["version"] == 3 and reg["r4"]["version"] == 1 and reg["r3"]["description"] == "accuracy: 0.9123"
    t = spark.createDataFrame([("m", 2, "Production")], "model_name string, version long, stage string")
    st = {x["version"]: x["stage"] for x in transition_stage(mv, t).collect()}
    assert st == {1: "Archived", 2: "Production"}
    lv = {(x["model_name"], x["stage"]): x["version"] for x in latest_versions(mv).collect()}
    assert lv[("m", "Staging")] == 2


def test_compare_versions(spark):
    m = spark.createDataFrame([("m", 1, "acc", 0.8), ("m", 2, "acc", 0.9), ("m", 2, "f1", 0.7), ("m", 1, "loss", None),
                               ("m", 2, "loss", 0.3)], "model_name string, version long, metric string, value double")
    rows = compare_versions(m, 1, 2).collect()
    assert len(rows) == 1 and rows[0]["improvement"] and abs(rows[0]["diff"] - 0.1) < 1e-12


def test_routes_and_histogram(spark):
    a = spark.createDataFrame([("critical", "x", dt.datetime(2024, 1, 1)), ("other", "y", dt.datetime(2024, 1, 1))],
                              "level string, message string, ts timestamp")
    got = sorted((r["level"], r["channel"]) for r in route_alerts(a).collect())
    assert got == [("critical", "email"), ("critical", "slack"), ("critical", "webhook"), ("other", "slack")]
    assert route_alerts(a).first()["formatted"].startswith("[CRITICAL] 2024-01-01T00:00:00")
    runs = spark.createDataFrame([(0.05,), (1.0,), (20.0,)], "duration_seconds double")
    h = {r["le"]: r["count"] for r in duration_histogram(runs).collect()}
    assert h["0.05"] == 1 and h["1.0"] == 2 and h["+Inf"] == 3


def test_two_targets_of_one_model(spark):
    mv = spark.createDataFrame([("m", 1, "Production"), ("m", 2, "Staging"), ("m", 3, "None"), ("o", 1, "Production")],
                               "model_name string, version long, stage string")
    t = spark.createDataFrame([("m", 2, "Production"), ("m", 3, "Staging")], "model_name string, version long, stage string")
    got = {(r["model_name"], r["version"]): r["stage"] for r in transition_stage(mv, t).collect()}
    assert got == {("m", 1): "Archived", ("m", 2): "Production", ("m", 3): "Staging", ("o", 1): "Production"}
    assert transition_stage(mv, t).count() == 4


def test_claimed_versions_are_not_given_twice(spark, tmp_dir):
    from cadence.operators.registry_store import RegistryStore
    store = RegistryStore(spark, "file://" + tmp_dir + "/registry")
    assert store.register("m", "run_a") == 1
    # Another writer read the same maximum and claims version 2 with an earlier clock.
    early = spark.sql("select 'm' model_name, 2L version, 'run_b' run_id, cast(null as string) description, timestamp'2000-01-01' created_at")
    store.append("model_versions", early)
    late = RegistryStore(spark, "file://" + tmp_dir + "/registry")
    real = late.read

    def stale(name):  # this writer still sees version 1 only, once
        late.read = real
        return real(name).where("version = 1")
    late.read = stale
    assert late.register("m", "run_c") == 3
    assert {(r["version"], r["run_id"]) for r in store.versions().collect()} == {(1, "run_a"), (2, "run_b"), (3, "run_c")}
