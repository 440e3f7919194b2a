import os
import sys

import pytest
from pyspark.sql import functions as F

from cadence.operators.train import assemble, best_epoch, fit, list_model_types, loss_history, score

SF = "/root/testdata/sf0.001"


def test_model_factory():
    assert {"mlp", "classifier", "logistic", "random_forest", "gbt"} <= set(list_model_types())
    from cadence.operators.train import create_estimator
    with pytest.raises(ValueError):
        create_estimator("cnn_nope", 8, 2)


def test_mlp_output_shape_and_history(spark):
    rows = [([float(i % 7), float(i % 3), float(i % 5), 1.0], i % 2) for i in range(200)]
    df = assemble(spark.createDataFrame(rows, "x array<double>, y int"), "x", "y")
    model = fit(df, "mlp", hidden=[8], max_iter=20)
    s = score(model, df.limit(4))
    probs = [r["probabilities"] for r in s.collect()]
    assert len(probs) == 4 and all(len(p) == 2 for p in probs)
    assert loss_history(model).count() > 1


def test_best_epoch_first_wins(spark):
    h = spark.createDataFrame([(1, 0.8, 0.5), (2, 0.9, 0.4), (3, 0.9, 0.3)], "epoch int, accuracy double, eval_loss double")
    assert best_epoch(h).first()["epoch"] == 2
    assert best_epoch(h.drop("accuracy")).first()["epoch"] == 3


def test_stream_windows_equal_batch(spark):
    import __spark_entry__ as entry  # noqa: F401
    from cadence.plans.streams import q_stream_canary
    from cadence.operators.canary import requests_from_events, assign_arm
    from cadence.tables import table
    s = {(r["window_start"], r["arm"]): (r["requests"], r["errors"]) for r in q_stream_canary(spark, SF).collect()}
    log = assign_arm(requests_from_events(table(spark, SF, "events")), "user_id", 25)
    b = log.groupBy(F.window("ts", "30 minutes").alias("w"), "arm").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_error").alias("e"))
    batch = {(r["w"]["start"].strftime("%Y-%m-%d %H:%M:%S"), r["arm"]): (r["n"], r["e"]) for r in b.collect()}
    assert s == batch      # the newest windows too


def test_entry_and_contract(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() == 3 and "split" in df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 70


def test_response_shape_and_foreign_model(spark):
    import numpy as np

    from cadence.operators.score import pandas_model_scorer, response_shape, score_logits
    w = np.array([[1.0, -1.0], [0.5, 0.5]])
    scorer = pandas_model_scorer(spark, lambda x: x @ w, 2)
    df = spark.createDataFrame([("r1", [1.0, 0.0]), (None, [-1.0, 2.0])], "request_id string, features array<double>")
    s = score_logits(df.withColumn("logits", scorer(F.col("features"))), F.col("logits"), "v7")
    rows = response_shape(s, "v7").collect()
    assert rows[0]["request_id"] == "r1" and rows[1]["request_id"].startswith("req_")
    assert rows[0]["prediction"] == 0.0 and rows[1]["prediction"] == 1.0
    assert abs(sum(rows[0]["probabilities"]) - 1.0) < 1e-12 and rows[0]["model_version"] == "v7"
    one = score_logits(spark.createDataFrame([([3.5],)], "z array<double>"), F.col("z")).first()
    assert one["prediction"] == 3.5 and one["probabilities"] is None      # width-1 output: raw value


def test_gauges_merge_across_micro_batches(spark, tmp_dir):
    import datetime as dt

    from cadence.streaming.streams import _epochs, read_gauges, stream_gauges
    src = os.path.join(tmp_dir, "updates")
    schema = "m string, ts timestamp, value double"
    batches = [[("a", dt.datetime(2024, 1, 1, 0, 0), 1.0), ("b", dt.datetime(2024, 1, 1, 0, 0), 5.0)],
               [("a", dt.datetime(2024, 1, 1, 0, 5), 2.0)],
               [("a", dt.datetime(2024, 1, 1, 0, 1), 9.0), ("c", dt.datetime(2024, 1, 1, 0, 2), 3.0)]]  # late 'a'
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    target = os.path.join(tmp_dir, "gauges")
    stream_gauges(stream, ["m"], "value", target)
    got = {r["m"]: r["value"] for r in read_gauges(spark, target).collect()}
    assert got == {"a": 2.0, "b": 5.0, "c": 3.0}          # newest event time wins, not newest arrival
    assert len(_epochs(target)) <= 2                        # older snapshots trimmed


def test_gauges_resume_and_take_the_newer_value(spark, tmp_dir):
    import datetime as dt

    from cadence.streaming.streams import read_gauges, stream_gauges
    src, target = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "table")
    schema = "m string, ts timestamp, value double"
    for i, v in enumerate((3.0, 9.0)):
        spark.createDataFrame([("a", dt.datetime(2024, 1, 1, i), v)], schema).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
        stream_gauges(spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src), ["m"], "value", target)
        assert read_gauges(spark, target).first()["value"] == v


def test_windows_resume_from_their_folder(spark, tmp_dir):
    import datetime as dt

    from cadence.streaming.streams import canary_windows, incremental_input, run_updates
    src, base = os.path.join(tmp_dir, "log"), os.path.join(tmp_dir, "run")
    schema = "user_id long, ts timestamp, is_error boolean, latency_ms double"
    for i in range(2):
        rows = [(u, dt.datetime(2024, 1, 1, 0, 10 * i), u % 2 == 0, float(u)) for u in range(20)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(os.path.join(src, f"b{i}"))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        out = run_updates(canary_windows(stream, 100), "w", ["window_start", "window_end", "arm"], base=base)
        assert [(r["requests"], r["errors"]) for r in out.collect()] == [(20 * (i + 1), 10 * (i + 1))]
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        assert incremental_input(stream, os.path.join(tmp_dir, "target"), os.path.join(tmp_dir, "c")) == 20


def test_state_machine_orders_windows_and_deployments(spark, tmp_dir):
    import datetime as dt

    from cadence.streaming.streams import rollout_state_machine, run_available
    schema = "deployment_id string, window_start timestamp, requests long, errors long, latency_p95_ms double"
    bad = {"b": 3}
    rows = [(d, dt.datetime(2024, 1, 1, h), 10, 5 if bad.get(d) == h else 0, 10.0) for h in reversed(range(8)) for d in "abc"]
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(os.path.join(tmp_dir, "in"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        stream = spark.readStream.schema(schema).parquet(os.path.join(tmp_dir, "in"))
        out = run_available(rollout_state_machine(stream, [1, 5, 25, 50, 100], 0.2, 100.0, 0.8), "sm").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    last = {}
    for r in sorted(out, key=lambda r: r["window_start"]):
        last[r["deployment_id"]] = (r["window_start"].hour, r["status"], list(r["stages_completed"]))
    assert last == {"a": (4, "completed", [1, 5, 25, 50, 100]), "b": (3, "rolled_back", [1, 5, 25]), "c": (4, "completed", [1, 5, 25, 50, 100])}


def test_evaluate_rows_errors(spark):
    from cadence.operators.train import evaluate_rows, evaluate_run
    df = spark.createDataFrame([(1, -1), (2, None)], "id int, y int")
    with pytest.raises(ValueError, match="valid target"):
        evaluate_rows(df, "y", None, 3)
    runs = spark.createDataFrame([("r", "x", 1)], "run_id string, run_name string, started_at int")
    with pytest.raises(ValueError, match="no run named"):
        evaluate_run(runs, "z", None, df, "y", 3)


def test_epochs_keep_the_best_model(spark, tmp_dir):
    from cadence.operators.train import assemble, evaluate, load_best, read_history, train_epochs
    rows = [(float(i % 7), float(i % 11), float(i % 7 > i % 11)) for i in range(400)]
    data = assemble(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y")
    train, val = data.sample(False, 0.7, 1), data.sample(False, 0.3, 2)
    for kind, params in (("mlp", {"hidden": [4]}), ("logistic", {})):
        path = os.path.join(tmp_dir, kind)
        first = train_epochs(train, val, 2, path, kind, iterations=4, **params)
        done = train_epochs(train, val, 5, path, kind, iterations=4, resume=True, **params)
        assert [r["epoch"] for r in done["history"]] == [1, 2, 3, 4, 5] and done["history"][:2] == first["history"]
        history = {r.epoch: r for r in read_history(spark, path).collect()}
        best = min(history.values(), key=lambda r: (-r.accuracy, r.epoch))
        assert done["best_epoch"] == best.epoch and done["model_path"].endswith(f"epoch={best.epoch}")
        again = evaluate(load_best(spark, path), val)[0].first()
        assert (again["accuracy"], again["loss"]) == (best.accuracy, pytest.approx(best.eval_loss, abs=1e-12))
        losses = [r["train_loss"] for r in done["history"]]
        assert losses == sorted(losses, reverse=True)  # each epoch goes on from the one before
    with pytest.raises(FileNotFoundError):
        load_best(spark, os.path.join(tmp_dir, "none"))


def test_deadlines_fail_stages_without_traffic(spark, tmp_dir):
    import datetime as dt

    from cadence.streaming.streams import rollout_with_deadlines, run_available
    schema = "deployment_id string, window_start timestamp, requests long, errors long, latency_p95_ms double"
    hour = lambda h: dt.datetime(2024, 1, 1, h)
    src, base = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")

    def run(rows):
        spark.createDataFrame([(d, hour(h), n, e, 10.0) for d, h, n, e in rows], schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        out = run_available(rollout_with_deadlines(stream, [1, 50, 100], 3600, 0.2, 100.0, 0.8, "2 hours"), "d", base=base)
        return {(r.deployment_id, r.window_start.hour): (r.healthy, r.status, r.stages_completed) for r in out.collect()}

    got = run([("steady", 0, 5, 0), ("gap", 0, 5, 0), ("gap", 2, 5, 0), ("silent", 0, 5, 0), ("zero", 0, 0, 0), ("bad", 1, 4, 2)])
    assert got["gap", 1] == (False, "rolled_back", [1]) and ("gap", 2) not in got          # noticed by a later window
    assert got["zero", 0] == (False, "rolled_back", []) and got["bad", 1] == (False, "rolled_back", [])
    assert got["steady", 0] == got["silent", 0] == (True, "in_progress", [1])
    got = run([("steady", 1, 5, 0), ("late", 4, 5, 0)])
    assert got["steady", 1] == (True, "in_progress", [1, 50])
    assert got["silent", 1] == (False, "rolled_back", [1])                                    # by the timer: the watermark is past the end of hour 1
    got = run([("silent", 1, 5, 0), ("steady", 2, 5, 0)])
    assert got["silent", 1] == (False, "rolled_back", [1])                                    # too late
    assert len([k for k in got if k[0] == "silent"]) == 2


def test_counters_and_histograms_count_a_retried_batch_once(spark, tmp_dir):
    from cadence.operators.monitor import duration_histogram
    from cadence.streaming.streams import read_counters, read_histograms, stream_counters, stream_histograms
    src, schema = os.path.join(tmp_dir, "in"), "status string, seconds double"
    targets = [os.path.join(tmp_dir, "counters"), os.path.join(tmp_dir, "histograms")]
    rows = []

    def run():
        stream_counters(spark.readStream.schema(schema).parquet(src), ["status"], targets[0])
        stream_histograms(spark.readStream.schema(schema).parquet(src), "seconds", targets[1], [1.0, 10.0], ["status"])
        whole = spark.createDataFrame(rows, schema)
        assert {r["status"]: r["count"] for r in read_counters(spark, targets[0]).collect()} == {
            r["status"]: r["count"] for r in whole.groupBy("status").count().collect()}
        want = sorted(map(str, duration_histogram(whole, "seconds", [1.0, 10.0], ["status"]).collect()))
        assert sorted(map(str, read_histograms(spark, targets[1], [1.0, 10.0], ["status"]).collect())) == want

    for k in range(3):
        rows += [("ok", 0.5 * k + i) for i in range(4)] + [(None, 20.0), ("bad", None)]
        spark.createDataFrame(rows[-6:], schema).coalesce(1).write.mode("append").parquet(src)
        run()
    for t in targets:  # the last batch was written, but its commit was lost: it is run again
        commits = sorted(f for f in os.listdir(f"{t}-checkpoint/commits") if f.isdigit())
        os.remove(f"{t}-checkpoint/commits/{commits[-1]}")
        crc = f"{t}-checkpoint/commits/.{commits[-1]}.crc"
        if os.path.exists(crc):
            os.remove(crc)
    run()


def test_stream_scoring_of_a_table_in_several_files(spark, tmp_dir):
    from cadence.plans.streams import q_stream_scoring
    rows = [(i, [float(i % 3 == k) + 0.01 * (i % 7) for k in range(4)], i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.coalesce(1).write.parquet(f"{tmp_dir}/part")
    os.mkdir(f"{tmp_dir}/file")
    part = next(n for n in os.listdir(f"{tmp_dir}/part") if n.startswith("part-"))
    os.rename(f"{tmp_dir}/part/{part}", f"{tmp_dir}/file/embeddings.parquet")
    df.repartition(3).write.parquet(f"{tmp_dir}/folder/embeddings.parquet")
    for kind in ("file", "folder", "folder/"):
        got = sorted(map(tuple, q_stream_scoring(spark, f"{tmp_dir}/{kind}").collect()))
        assert got == [(k, k, 20) for k in range(3)], kind
