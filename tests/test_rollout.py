import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadence.operators.canary import (assign_arm, check_health, deployment_config, deployment_status,
                                      evaluate_health, finalize, initialize, metric_gate, rollback,
                                      rollout_outcome, stage_progression)
from cadence.operators.shadow import (compare, comparison_metrics, mismatch_samples, pair_predictions,
                                      recommendation)


def test_health_pass_fail(spark):
    df = spark.createDataFrame([(0.99, 50.0, 1, 100, 0.95, 100.0), (0.90, 100.0, 10, 100, 0.99, 50.0)],
                               "success_rate double, avg_latency_ms double, error_count long, total_requests long, "
                               "min_s double, max_l double")
    rows = [evaluate_health(df.limit(1)).first(),
            evaluate_health(df.where("success_rate < 0.95"), 0.99, 50.0).first()]
    assert rows[0]["is_healthy"] and rows[0]["reason"] == "Healthy"
    assert not rows[1]["is_healthy"] and "Success rate" in rows[1]["reason"] and "latency" in rows[1]["reason"]


def test_check_health_strict_and_missing(spark):
    m = spark.createDataFrame([(0.05, 500.0, 0.95), (None, None, None), (0.06, 10.0, 0.99)],
                              "error_rate double, latency_p95_ms double, canary_health double")
    rows = check_health(m).collect()
    assert rows[0]["healthy"]                       # equal to thresholds passes (strict)
    assert not rows[1]["healthy"] and len(rows[1]["issues"]) == 1   # missing health counts as 0
    assert rows[2]["issues"] == ["Error rate 0.06 > 0.05"]


def test_assignment_sticky_and_monotone(spark):
    users = spark.range(2000).withColumnRenamed("id", "user_id")
    a5 = {r["user_id"] for r in assign_arm(users, "user_id", 5).where("arm = 'canary'").collect()}
    a25 = {r["user_id"] for r in assign_arm(users, "user_id", 25).where("arm = 'canary'").collect()}
    assert a5 <= a25 and 0.15 < len(a25) / 2000 < 0.35


def _log(spark, rows):
    return spark.createDataFrame(rows, "request_id string, ts timestamp, user_id long, is_error boolean, latency_ms double")


def test_stage_progression_stops_at_first_unhealthy(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for stage in range(5):
        for u in range(400):
            err = stage == 2 and u % 2 == 0
            rows.append((f"{stage}-{u}", t0 + dt.timedelta(minutes=30 * stage + 1), u, err, 10.0))
    st = stage_progression(_log(spark, rows), stage_minutes=30).orderBy("stage").collect()
    assert [r["status"] for r in st] == ["passed", "passed", "failed", "skipped", "skipped"]
    out = rollout_outcome(stage_progression(_log(spark, rows), stage_minutes=30)).first()
    assert out["status"] == "rolled_back" and out["stages_completed"] == [1, 5]
    assert out["current_percentage"] == 0 and out["previous_percentage"] == 25


def test_deployment_table_ops(spark):
    d = spark.createDataFrame([("d1", "canary", 25, "in_progress", [1, 5, 5, 25]), ("d2", "canary", 100, "in_progress", [1])],
                              "deployment_id string, strategy string, current_percentage int, status string, stages_completed array<int>")
    rb = {r["deployment_id"]: r for r in rollback(d, spark.createDataFrame([("d1",)], "deployment_id string")).collect()}
    assert rb["d1"]["status"] == "rolled_back" and rb["d1"]["previous_percentage"] == 25 and rb["d1"]["current_percentage"] == 0
    assert rb["d2"]["status"] == "in_progress"
    fin = {r["deployment_id"]: r for r in finalize(d).collect()}
    assert fin["d2"]["status"] == "completed" and fin["d1"]["error"].startswith("Cannot finalize")
    with pytest.raises(Exception):
        finalize(d, strict=True).collect()
    st = {r["deployment_id"]: r for r in deployment_status(d, spark.createDataFrame([("d1",), ("zz",)], "deployment_id string")).collect()}
    assert st["zz"]["status"] == "not_found" and st["d1"]["stages_completed"] == [1, 5, 25]
    new = spark.createDataFrame([("d1", "canary"), ("d3", "shadow")], "deployment_id string, strategy string")
    assert initialize(d, new).count() == 3


def test_metric_gate_inclusive(spark):
    m = spark.createDataFrame([(0.80, 100.0, 0.05)], "accuracy double, latency_ms double, error_rate double")
    assert all(r["passed"] and r["all_passed"] for r in metric_gate(m).collect())


def test_deployment_config(spark):
    r = spark.createDataFrame([("3", None, dt.datetime(2024, 5, 6))], "model_version string, strategy string, requested_at timestamp")
    row = deployment_config(r).first()
    assert row["deployment_id"] == "deploy_20240506_3" and row["strategy"] == "canary"
    with pytest.raises(Exception):
        deployment_config(spark.createDataFrame([(None, None, dt.datetime(2024, 5, 6))], r.schema)).collect()


# H04 goldens: (low match, regression, small n) -> confidence, recommendation
GOLDENS = [
    ((False, False, False), 1.0, "promote"),
    ((True, False, True), 0.6, "promote_with_caution"),
    ((False, True, True), 0.7000000000000001, "promote_with_caution"),
    ((True, True, False), 0.49999999999999994, "do_not_promote"),
    ((True, True, True), 0.3999999999999999, "do_not_promote"),
]


def test_decision_goldens(spark):
    rows = []
    for (low, slow, small), _, _ in GOLDENS:
        rows.append((0.5 if low else 0.95, 200.0 if slow else 100.0, 100.0, 10 if small else 5000))
    m = spark.createDataFrame(rows, "prediction_match_rate double, shadow_latency_p95 double, "
                                    "production_latency_p95 double, total_comparisons long")
    out = recommendation(m).collect()
    for r, (_, conf, rec) in zip(out, GOLDENS):
        assert r["confidence"] == conf and r["recommendation"] == rec


def test_empty_log_decision(spark):
    empty = spark.createDataFrame([], "request_id string, ts timestamp, production_prediction array<double>, "
                                      "shadow_prediction array<double>, production_latency_ms double, shadow_latency_ms double, "
                                      "predictions_match boolean")
    m = comparison_metrics(empty)
    r = recommendation(m).first()
    assert r["total_comparisons"] == 0 and r["message"] == "No comparisons collected yet"
    assert r["confidence"] == 0.6 and r["recommendation"] == "promote_with_caution" and not r["sufficient_data"]


def test_match_predicate_and_mismatch_order(spark):
    prod = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 0, 2), [0.2, 0.8], 10.0),
                                  ("b", dt.datetime(2024, 1, 1, 0, 1), [0.5, 0.5], 10.0),
                                  ("c", dt.datetime(2024, 1, 1, 0, 3), [0.5, 0.5], 10.0)],
                                 "request_id string, ts timestamp, prediction array<double>, latency_ms double")
    shadow = spark.createDataFrame([("a", [0.3, 0.7], 11.0), ("b", [0.9, 0.1], 12.0), ("c", [0.5], 9.0)],
                                   "request_id string, prediction array<double>, latency_ms double")
    c = compare(pair_predictions(prod, shadow))
    got = {r["request_id"]: r["predictions_match"] for r in c.collect()}
    assert got == {"a": True, "b": False, "c": False}     # |diff| 0.1 <= 0.1 + 1e-5; length differs
    assert [r["request_id"] for r in mismatch_samples(c, 10).collect()] == ["b", "c"]


def test_stages_without_canary_traffic_are_listed_and_fail(spark):
    import datetime as dt

    from cadence.operators.canary import rollout_outcome, stage_progression
    from cadence.functions.hashing import hash_bucket
    from pyspark.sql import functions as F
    # A user outside the first four stages' canary shares, active all the time.
    user = spark.range(1000).where(hash_bucket(F.col("id"), 100) >= 50).first()["id"]
    rows = [(user, dt.datetime(2024, 1, 1, h), False, 1.0, "d") for h in range(5)]
    log = spark.createDataFrame(rows, "user_id long, ts timestamp, is_error boolean, latency_ms double, dep string")
    for group in (None, ["dep"]):
        st = stage_progression(log, stage_minutes=60, group=group)
        assert [(r["stage"], r["requests_total"], r["status"]) for r in st.orderBy("stage").collect()] == [
            (0, 0, "failed"), (1, 0, "skipped"), (2, 0, "skipped"), (3, 0, "skipped"), (4, 1, "skipped")]
        assert rollout_outcome(st, group).first()["status"] == "rolled_back"


def test_numeric_drift_against_plain_version(spark):
    import math
    import random

    import numpy as np

    from cadence.operators.shadow import numeric_drift
    rng = random.Random(1)
    base = [(g, rng.gauss(0, 1)) for g in ("a", None) for _ in range(500)] + [("a", None), ("a", float("nan")), ("only base", 1.0)]
    current = [("a", rng.gauss(0, 1)) for _ in range(400)] + [(None, rng.gauss(1, 2)) for _ in range(300)] + [("only current", 1.0)]
    schema = "g string, x double"
    out = {r.g: r for r in numeric_drift(spark.createDataFrame(base, schema), spark.createDataFrame(current, schema), ["x"], 10, ["g"]).collect()}
    assert set(out) == {"a", None}
    for g, r in out.items():
        b, c = ([v for k, v in rows if k == g and v is not None and not math.isnan(v)] for rows in (base, current))
        edges = np.quantile(b, [i / 10 for i in range(1, 10)])
        pb, pc = (np.bincount(np.searchsorted(edges, x), minlength=10) / len(x) for x in (b, c))
        fb, fc = np.maximum(pb, 1e-6), np.maximum(pc, 1e-6)
        assert r.psi == pytest.approx(((fc - fb) * np.log(fc / fb)).sum())
        assert r.ks == pytest.approx(np.abs(np.cumsum(pb) - np.cumsum(pc)).max())
        assert (r.n_base, r.n_current) == (len(b), len(c))
    assert out["a"].psi < 0.1 < out[None].psi
