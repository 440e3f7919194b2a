import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

import cadence.operators.metrics as M
from cadence.functions.arrays import argmax, softmax


@pytest.fixture()
def eval_small(spark):
    return spark.createDataFrame([(0, 0), (1, 1), (0, 0), (1, 0), (1, 1)], "prediction int, target int")


def test_eval_small_goldens(eval_small):
    r = M.classification_metrics(eval_small, "target", "prediction").first()
    assert r["accuracy"] == pytest.approx(0.8)
    assert r["precision"] == pytest.approx(0.866667, abs=1e-6)
    assert r["recall"] == pytest.approx(0.8)
    assert r["f1_score"] == pytest.approx(0.8)


def test_confusion_matrix(eval_small):
    cm = {(r["label"], r["prediction"]): r["count"] for r in M.confusion_matrix(eval_small, "target", "prediction").collect()}
    assert [[cm[(0, 0)], cm[(0, 1)]], [cm[(1, 0)], cm[(1, 1)]]] == [[2, 1], [0, 2]]


def test_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 1), (0, 1)], "y int, p int")
    per = {r["label"]: r for r in M.per_class_scores(df, "y", "p").collect()}
    assert per[1]["precision"] == 0.0 and per[0]["recall"] == 0.0


def _scored(spark, n=3000):
    return spark.range(n).select(
        (F.col("id") % 2).cast("int").alias("y"),
        (F.round((F.col("id") * 7919 % 1000) / 1000.0 + (F.col("id") % 2) * 0.1, 2)).alias("s"))


def test_auc_matches_spark_ml(spark):
    df = _scored(spark)
    ours = M.roc_auc(df, "y", "s").first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", metricName="areaUnderROC", numBins=0)
    ref = ev.evaluate(df.withColumn("y", F.col("y").cast("double")))
    assert ours == pytest.approx(ref, abs=1e-12)


def test_auc_does_not_depend_on_partitions(spark):
    df = _scored(spark)
    got = []
    for parts in ("1", "13"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got.append(M.roc_auc(df, "y", "s").first()["auc"])
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first()["auc"] is None


def test_auc_ovr_binary_equals_binary(spark):
    df = _scored(spark).withColumn("p", F.array(1 - F.col("s"), F.col("s")))
    b = M.roc_auc(df, "y", "s").first()["auc"]
    o = M.roc_auc_ovr(df, "y", "p").first()["auc"]
    assert o == pytest.approx(b, abs=1e-12)


def test_log_loss_logits_vs_probs(spark):
    df = spark.createDataFrame([([1.0, 2.0, 0.5], 1), ([0.0, 0.0, 3.0], 2)], "z array<double>, y int")
    a = M.log_loss(df, "y", "z", from_logits=True).first()["loss"]
    b = M.log_loss(df.withColumn("p", softmax(F.col("z"))), "y", "p", from_logits=False).first()["loss"]
    assert a == pytest.approx(b, abs=1e-12)


def test_argmax_first_on_ties(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.5],)], "a array<double>")
    assert df.select(argmax(F.col("a"))).first()[0] == 1


def test_report_rows(eval_small):
    names = [r["name"] for r in M.classification_report(eval_small, "target", "prediction", {0: "neg", 1: "pos"}).collect()]
    assert set(names) == {"neg", "pos", "accuracy", "macro avg", "weighted avg"}


def test_valid_targets(spark):
    df = spark.createDataFrame([(0,), (1,), (-1,), (2,), (None,)], "y int")
    kept, counts = M.valid_targets(df, "y", 2)
    assert kept.count() == 2 and counts.first()["dropped"] == 3


def test_auc_drops_missing_scores_and_counts_them(spark):
    from cadence.operators.metrics import roc_auc, scored
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4), (1, None), (0, float("nan"))], "y int, s double")
    assert scored(df, "s")[1].first()["dropped"] == 2
    r = roc_auc(df, "y", "s").first()
    assert (r["pos_total"], r["neg_total"]) == (2, 2) and r["auc"] == (1 + 1 + 1 + 0.5) / 4


def test_confusion_of_many_classes(spark):
    import time
    from cadence.operators.metrics import confusion_matrix, confusion_wide
    df = spark.range(20_000).selectExpr("id % 1000 as y", "(id * 7) % 1000 as p")
    t = time.time()
    cells = confusion_matrix(df, "y", "p")
    r = cells.selectExpr("count(*) n", "sum(count) c").first()
    assert (r["n"], r["c"]) == (1_000_000, 20_000) and time.time() - t < 60
    small = confusion_wide(df.where("y < 3 and p < 3"), "y", "p").orderBy("label").collect()
    assert all(sorted(x["counts"]) == sorted(y["label"] for y in small) for x in small)


def test_five_thousand_centroids(spark):
    import numpy as np

    from cadence.operators.score import nearest_centroid
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5000, 64))
    fit_rows = [(int(i), c.tolist()) for i, c in enumerate(centres)]
    queries = [(int(i), (3 * centres[i] + 0.1 * rng.normal(size=64)).tolist()) for i in rng.integers(0, 5000, 300)]
    fit_df = spark.createDataFrame(fit_rows, "label long, x array<double>")
    df = spark.createDataFrame(queries, "want long, x array<double>").repartition(3)
    out = nearest_centroid(df, "x", "label", fit_df).collect()
    assert len(out) == 300
    for r in out[:40]:
        s = centres @ np.array(r.x)
        p = np.exp(s - s.max())
        assert r.prediction == r.want == s.argmax() and np.allclose(r.probabilities, p / p.sum(), atol=1e-9)
    assert all(r.prediction == r.want for r in out)


def test_blocks_equal_literals_with_ties(spark):
    from cadence.operators.score import nearest_centroid
    rows = [(i % 4, [float(i % 2), 1.0]) for i in range(40)] + [(9, [0.0, 1.0])]  # labels with equal centroids
    df = spark.createDataFrame(rows, "label long, x array<double>")
    a = nearest_centroid(df, "x", "label").collect()
    b = nearest_centroid(df, "x", "label", max_cells=3).collect()
    key = lambda r: (r.label, r.x, r.prediction, [round(p, 9) for p in r.probabilities])
    assert sorted(map(key, a)) == sorted(map(key, b))


def test_auc_over_many_ranges(spark, monkeypatch):
    import functools
    import random

    from cadence.functions.quantiles import equal_ranges
    from cadence.operators import metrics as M
    rng = random.Random(2)
    rows = [(rng.randrange(2), rng.choice([0.5, 0.25, rng.random(), rng.random() ** 6])) for _ in range(4000)] + [(1, None), (0, float("nan"))]
    df = spark.createDataFrame(rows, "y int, s double")
    one = M.roc_auc(df, "y", "s").first()
    monkeypatch.setattr(M, "equal_ranges", functools.partial(equal_ranges, rows_each=100))
    many = M.roc_auc(df, "y", "s").first()
    assert equal_ranges(df, "s", rows_each=100).select("range").distinct().count() > 20
    pos, neg = ([s for y, s in rows[:4000] if y == v] for v in (1, 0))
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert one["auc"] == pytest.approx(want) == many["auc"] and one["pos_total"] == many["pos_total"] == len(pos)
