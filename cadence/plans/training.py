"""Training queries (T01-T06, B01, B02, E09, E10). Model fits are iterative, so these carry no
SQL oracle; tests check them against invariants instead."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.columns import round_doubles
from cadence.operators.split import train_val_split
from cadence.operators.train import (assemble, best_epoch, evaluate, evaluate_path, evaluate_run, fit,
                                     loss_history, score)
from cadence.plans.catalog import query
from cadence.tables import table


def _embedding_data(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    d = emb.select("vec_id", F.col("embedding").alias("x"), "label")
    return assemble(train_val_split(d, "vec_id", 0.2), "x", "label")


def _model(spark, sf_dir):
    data = _embedding_data(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    return data, fit(train, "mlp", n_features=64, n_classes=10, hidden=[16], max_iter=60)


@query("mlp_train_score", "T01 T02 T05 B01 E09")
def q_mlp_train_score(spark, sf_dir):
    data, model = _model(spark, sf_dir)
    metrics, _ = evaluate(model, data.where(F.col("split") == "val"))
    return round_doubles(metrics)


@query("mlp_history", "T03 T04")
def q_mlp_history(spark, sf_dir):
    """Loss of every iteration, and whether it is the best one."""
    _, model = _model(spark, sf_dir)
    history = loss_history(model)
    best = best_epoch(history, loss="loss", epoch="iteration").select(F.col("iteration").alias("__best"))
    return history.join(best, F.col("iteration") == F.col("__best"), "left") \
                  .select("iteration", "loss", F.col("__best").isNotNull().alias("best"))


@query("mlp_epochs", "T03 T04 T05 S16")
def q_mlp_epochs(spark, sf_dir):
    """Six epochs, each validated; the best one, loaded from its checkpoint, gives its metrics again."""
    import uuid

    from cadence.operators.train import load_best, read_history, train_epochs
    from cadence.session import scratch_path
    data = _embedding_data(spark, sf_dir)
    train, val = data.where(F.col("split") == "train"), data.where(F.col("split") == "val")
    path = scratch_path(spark, f"epochs/mlp-{uuid.uuid4().hex[:8]}")
    done = train_epochs(train, val, 6, path, iterations=8, n_features=64, n_classes=10, hidden=[16])
    again, _ = evaluate(load_best(spark, path), val)
    both = read_history(spark, path).withColumn("best", F.col("epoch") == done["best_epoch"])
    same = F.abs(F.col("accuracy") - F.lit(again.first()["accuracy"])) < 1e-12
    return round_doubles(both.withColumn("reproduced", F.when(F.col("best"), same)))


@query("mlp_batch_scores", "B01")
def q_mlp_batch_scores(spark, sf_dir):
    data, model = _model(spark, sf_dir)
    s = score(model, data, version="1")
    return s.groupBy("split", "prediction").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("model_roundtrip", "T06 S16 E10 R16 T05")
def q_model_roundtrip(spark, sf_dir):
    """Train entry: split -> fit -> evaluate -> save -> load -> re-evaluate; the final
    metrics are returned as run_metrics rows (metric, value)."""
    import uuid

    from cadence.operators.registry import final_metrics
    from cadence.operators.train import load_model, save_model, train_run
    from cadence.session import scratch_path
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("x"), "label")
    res = train_run(emb, "x", "label", "vec_id", "mlp", n_features=64, n_classes=10, hidden=[16], max_iter=40)
    path = save_model(res["model"], scratch_path(spark, f"models/mlp-{uuid.uuid4().hex[:8]}"))
    loaded = load_model(path)
    val = assemble(train_val_split(emb, "vec_id", 0.2), "x", "label").where(F.col("split") == "val")
    m, _ = evaluate(loaded, val)
    run = m.select(F.lit("run_mlp").alias("run_id"), F.lit(res["final_train_loss"]).alias("final_train_loss"),
                   "accuracy", "f1_score")
    return round_doubles(final_metrics(run, "final_train_loss", "accuracy", "f1_score"))


@query("score_pair", "B02 B01")
def q_score_pair(spark, sf_dir):
    """Production (MLP) and shadow (logistic) models score one scan side by side."""
    from cadence.operators.train import score_pair
    data = _embedding_data(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    prod = fit(train, "mlp", n_features=64, n_classes=10, hidden=[16], max_iter=40)
    shadow = fit(train, "logistic", n_features=64, n_classes=10, max_iter=40)
    both = score_pair(prod, shadow, data)
    return both.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(F.col("production_prediction") == F.col("shadow_prediction")).cast("bigint").alias("agree"))


@query("training_cycle", "T06 R01 R02 R03 R05 R06 R13 R14 R15 V14 F15")
def q_training_cycle(spark, sf_dir):
    """Two continuous-training cycles on the embeddings against an
    append-only registry in the shared scratch folder; returns the versions with their
    current stage and run status."""
    import uuid

    from cadence.operators.lifecycle import training_cycle
    from cadence.operators.registry_store import RegistryStore
    from cadence.operators.validate import DataSchema
    from cadence.session import scratch_path
    emb = table(spark, sf_dir, "embeddings")
    df = emb.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)], "label")
    store = RegistryStore(spark, scratch_path(spark, f"registry-{uuid.uuid4().hex[:8]}"))
    loose = {"min_accuracy": 0.0, "min_f1": 0.0, "min_precision": 0.0, "min_recall": 0.0}
    for _ in range(2):
        training_cycle(df, "vec_id", "label", store, "embedding-classifier", schema=DataSchema(min_rows=10),
                       thresholds=loose, hidden=[16], max_iter=30)
    return store.versions().join(store.runs().select("run_id", "status"), "run_id") \
                .select("model_name", "version", "stage", "status")


# ----------------------------------------------------------------------------------------
# Evaluation by data path (E09) and by run name (E10), with a linear scorer whose weights follow
# from the labels, so that SQL can follow: logit of class c is x[c] + x[c + 10] / 2.

_SCORED = """x AS (SELECT vec_id, embedding, CASE WHEN vec_id % 17 = 0 THEN -1 ELSE label END AS y FROM embeddings),
l AS (SELECT vec_id, y, c, CAST(embedding[c + 1] AS DOUBLE) + CAST(embedding[c + 11] AS DOUBLE) / 2 AS z
      FROM x, (SELECT unnest(range(0, 10)) AS c) WHERE y >= 0 AND y < 10),
p AS (SELECT vec_id, y, c, z, exp(z - max(z) OVER w) / sum(exp(z)) OVER w * exp(max(z) OVER w) AS prob,
             row_number() OVER (PARTITION BY vec_id ORDER BY z DESC, c) AS rk FROM l WINDOW w AS (PARTITION BY vec_id)),
s AS (SELECT vec_id, y, max(c) FILTER (WHERE rk = 1) AS pred, max(prob) FILTER (WHERE c = y) AS py FROM p GROUP BY 1, 2),
r AS (SELECT c, y = c AS pos, prob, rank() OVER (PARTITION BY c ORDER BY prob) AS rk,
             count(*) OVER (PARTITION BY c, prob) AS same FROM p),
a AS (SELECT c, count(*) FILTER (WHERE pos) AS np, count(*) FILTER (WHERE NOT pos) AS nn,
             sum(rk + (same - 1) / 2.0) FILTER (WHERE pos) AS rs FROM r GROUP BY c),
auc AS (SELECT sum((rs - np * (np + 1) / 2.0) / nn) / sum(np) AS auc FROM a WHERE np > 0 AND nn > 0),
m AS (SELECT round(avg(CAST(pred = y AS DOUBLE)), 6) AS accuracy, round(avg(-ln(greatest(py, 1e-15))), 6) AS loss,
             CAST(count(*) AS BIGINT) AS kept FROM s)"""
_EVALUATED = f"""WITH {_SCORED}
SELECT m.accuracy, m.loss, round(auc.auc, 6) AS auc, m.kept, CAST((SELECT count(*) FROM x) - m.kept AS BIGINT) AS dropped FROM m, auc"""


def _linear(df):
    from cadence.operators.score import linear_logits, score_logits
    weights = [[1.0 if i == c else 0.5 if i == c + 10 else 0.0 for i in range(64)] for c in range(10)]
    return score_logits(df, linear_logits(F.col("embedding").cast("array<double>"), weights))


def _marked(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").withColumn(
        "y", F.when(F.col("vec_id") % 17 == 0, -1).otherwise(F.col("label")))


@query("evaluate_path", "E09 P06 T05 E06", _EVALUATED)
def q_evaluate_path(spark, sf_dir):
    """The embeddings, every 17th without a valid target, written to a folder and evaluated from there."""
    import uuid

    from cadence.session import scratch_path
    path = scratch_path(spark, f"evaluation/embeddings-{uuid.uuid4().hex[:8]}")
    _marked(spark, sf_dir).write.parquet(path)
    metrics, _ = evaluate_path(spark, _linear, path, "embedding", "y", 10)
    return round_doubles(metrics.select("accuracy", "loss", "auc", "kept", "dropped"))


@query("evaluate_run", "E10 R07 E04", f"""WITH {_SCORED},
k AS (SELECT DISTINCT v FROM (SELECT y AS v FROM s UNION SELECT pred FROM s))
SELECT (SELECT arg_max(event_id, (ts, event_id)) FROM events WHERE event_type = 'purchase') AS run,
       CAST(a.v AS BIGINT) AS label, CAST(b.v AS BIGINT) AS prediction,
       CAST((SELECT count(*) FROM s WHERE s.y = a.v AND s.pred = b.v) AS BIGINT) AS count FROM k a, k b""")
def q_evaluate_run(spark, sf_dir):
    """Confusion matrix of the newest run named purchase (runs are events, as in find_run)."""
    runs = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("run_name"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"))
    run, _, cells = evaluate_run(runs, "purchase", lambda run_id: _linear, _marked(spark, sf_dir), "y", 10)
    return cells.select(F.lit(run).alias("run"), "label", "prediction", "count")
