"""Training and model scoring on executors.

Estimators are Spark ML: gradients / statistics are computed per partition and combined
with tree aggregation, so training scales with the cluster instead of one GPU process. The
reference's PyTorch MLP becomes ``MultilayerPerceptronClassifier`` (sigmoid hidden units,
L-BFGS): the same task with a different optimiser.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.metrics import (classification_metrics, confusion_matrix, log_loss, roc_auc_ovr,
                                       valid_targets)
from cadence.session import checkpoint_dir


def _mlp(n_features: int, n_classes: int, hidden: list[int] | None = None, max_iter: int = 100,
         seed: int = 42, **kw):
    return MultilayerPerceptronClassifier(layers=[n_features, *(hidden or [64, 32]), n_classes],
                                          maxIter=max_iter, seed=seed, **kw)


def _logistic(n_features: int, n_classes: int, max_iter: int = 100, **kw):
    return LogisticRegression(maxIter=max_iter, **kw)


def _forest(n_features: int, n_classes: int, seed: int = 42, **kw):
    return RandomForestClassifier(seed=seed, **kw)


def _gbt(n_features: int, n_classes: int, seed: int = 42, **kw):
    if n_classes > 2:
        raise ValueError("gbt supports binary labels only")
    return GBTClassifier(seed=seed, **kw)


HISTORY = "epoch int, train_loss double, eval_loss double, accuracy double"
WARM = ("mlp", "classifier")   # models that take initial weights

# Model registry by name (extensible).
MODELS: dict[str, Callable[..., Any]] = {"mlp": _mlp, "classifier": _mlp, "logistic": _logistic,
                                         "random_forest": _forest, "gbt": _gbt}


def register_model_type(name: str, factory: Callable[..., Any]) -> None:
    MODELS[name] = factory


def list_model_types() -> list[str]:
    return sorted(MODELS)


def create_estimator(name: str, n_features: int, n_classes: int, **params):
    if name not in MODELS:
        raise ValueError(f"Unknown model type: {name}. Available: {list_model_types()}")
    est = MODELS[name](n_features, n_classes, **params)
    return est.setFeaturesCol("features").setLabelCol("label")


def assemble(df: DataFrame, feature_cols: list[str] | str, label: str | None = None) -> DataFrame:
    """Features as a vector column (P10: float features, integral label truncated toward 0)."""
    if isinstance(feature_cols, str):  # an array<float/double> column
        out = df.withColumn("features", array_to_vector(F.col(feature_cols).cast("array<double>")))
    else:
        out = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep") \
            .transform(df.withColumns({c: F.col(c).cast("float").cast("double") for c in feature_cols}))
    if label:
        out = out.withColumn("label", F.col(label).cast("bigint").cast("double"))
    return out


def fit(df: DataFrame, model_type: str = "mlp", n_features: int | None = None, n_classes: int | None = None,
        **params):
    """Fit on an assembled frame (features, label); class count from the data when not
    given (D05)."""
    if n_classes is None:
        n_classes = int(df.agg(F.max("label")).first()[0]) + 1
    if n_features is None:
        n_features = len(df.select("features").first()[0])
    est = create_estimator(model_type, n_features, n_classes, **params)
    return PipelineModel(stages=[est.fit(df)])


def loss_history(model: PipelineModel) -> DataFrame | None:
    """Objective value per iteration (models with a training summary)."""
    m = model.stages[-1]
    if not getattr(m, "hasSummary", False):
        return None
    summ = m.summary() if callable(m.summary) else m.summary
    hist = list(summ.objectiveHistory)
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def best_epoch(history: DataFrame, metric: str = "accuracy", loss: str = "eval_loss",
               epoch: str = "epoch") -> DataFrame:
    """The epoch with the highest metric (else the lowest loss); the first one wins ties."""
    key = F.col(metric).desc_nulls_last() if metric in history.columns else F.col(loss).asc_nulls_last()
    return history.orderBy(key, F.col(epoch).asc()).limit(1)


def score(model: PipelineModel, df: DataFrame, version: str = "unknown") -> DataFrame:
    """Class, class probabilities (array) and model version."""
    out = model.transform(df)
    cols = [c for c in df.columns]
    if "probability" in out.columns:
        probs = vector_to_array("probability")
    else:
        probs = F.lit(None).cast("array<double>")
    return out.select(*cols, F.col("prediction").cast("long").alias("prediction"),
                      probs.alias("probabilities"), F.lit(version).alias("model_version"))


def score_pair(production: PipelineModel, shadow: PipelineModel, df: DataFrame) -> DataFrame:
    """Both models over one scan; predictions side by side (no join needed)."""
    a = production.transform(df).withColumn("production_probabilities", vector_to_array("probability")) \
                  .withColumnRenamed("prediction", "production_prediction") \
                  .drop("rawPrediction", "probability")
    b = shadow.transform(a).withColumn("shadow_probabilities", vector_to_array("probability")) \
              .withColumnRenamed("prediction", "shadow_prediction").drop("rawPrediction", "probability")
    return b


def evaluate(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(metrics row incl. loss, scored rows) on an assembled frame."""
    return evaluate_scored(score(model, df))


def evaluate_scored(s: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metrics row incl. loss of scored rows (label, prediction, probabilities)."""
    m = classification_metrics(s, "label", "prediction")
    ll = log_loss(s.where(F.col("probabilities").isNotNull()).withColumn(
        "__p", F.transform("probabilities", lambda p: F.greatest(p, F.lit(1e-15)))), "label", "__p", from_logits=False)
    both = m.unionByName(ll.select("loss"), allowMissingColumns=True)   # two one-row results, no join
    return both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns]), s


def evaluate_rows(rows: DataFrame, label: str, scorer, num_classes: int) -> tuple[DataFrame, DataFrame]:
    """E09 / E10 core: drop rows without a valid target (P06; an error when none is left), score
    the rest with ``scorer`` (a function or a Spark ML model giving prediction and
    probabilities), and return (metrics with loss, AUC over all classes and the number of
    rows kept and dropped; confusion matrix)."""
    kept, counts = valid_targets(rows, label, num_classes)
    n = counts.first()
    if not n["kept"]:
        raise ValueError("no row with a valid target is left")
    data = kept.withColumn("label", F.col(label).cast("double"))
    checkpoint_dir(rows.sparkSession)
    s = (score(scorer, data) if hasattr(scorer, "transform") else scorer(data)) \
        .select("label", F.col("prediction").cast("long").alias("prediction"), "probabilities").checkpoint()
    metrics, _ = evaluate_scored(s)
    auc = roc_auc_ovr(s, "label", "probabilities").select("auc")
    both = metrics.unionByName(auc, allowMissingColumns=True)
    row = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    return (row.withColumns({"kept": F.lit(n["kept"]).cast("bigint"), "dropped": F.lit(n["dropped"]).cast("bigint")}),
            confusion_matrix(s, "label", "prediction"))


def evaluate_path(spark, model, data_path: str, feature_cols: list[str] | str, label: str, num_classes: int):
    """Evaluate a model (a scorer, or the path of a saved Spark ML model) on a data path."""
    from cadence.sources.readers import load_training_data
    scorer = load_model(model) if isinstance(model, str) else model
    rows = load_training_data(spark, data_path)
    if hasattr(scorer, "transform"):
        rows = assemble(rows, feature_cols)
    return evaluate_rows(rows, label, scorer, num_classes)


def evaluate_run(runs: DataFrame, run_name: str, load, rows: DataFrame, label: str, num_classes: int):
    """The newest run of that name (R07; an error when there is none) -> ``load(run_id)`` its
    scorer -> evaluate. Returns (run id, metrics, confusion matrix)."""
    from cadence.operators.registry import find_run
    hit = find_run(runs.where(F.col("run_name") == run_name)).select("run_id").limit(1).collect()
    if not hit:
        raise ValueError(f"no run named {run_name}")
    metrics, cells = evaluate_rows(rows, label, load(hit[0]["run_id"]), num_classes)
    return hit[0]["run_id"], metrics, cells


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def train_epochs(train: DataFrame, val: DataFrame, epochs: int, path: str, model_type: str = "mlp", iterations: int = 10,
                 n_features: int | None = None, n_classes: int | None = None, resume: bool = False, **params) -> dict[str, Any]:
    """Training in epochs of ``iterations`` optimiser steps on assembled frames, validated after each.

    An epoch goes on from the weights of the one before (models that take no initial weights are fitted
    anew with as many steps more; their optimiser walks the same path again). Its model is saved under ``path`` as
    ``epoch=<n>`` with a row of the history (epoch, train_loss, eval_loss, accuracy); ``best`` names the epoch with the
    highest accuracy, the first one among equals, and `load_best` gives its model back. With ``resume`` the
    epochs that a run before has finished are kept and training goes on behind them."""
    spark = train.sparkSession
    checkpoint_dir(spark)
    n_classes = n_classes or int(train.agg(F.max("label")).first()[0]) + 1
    n_features = n_features or len(train.select("features").first()[0])
    data = {"train": train.select("features", "label").checkpoint(), "val": val.select("features", "label").checkpoint()}
    rows = [r.asDict() for r in read_history(spark, path).orderBy("epoch").collect()] if resume else []  # one row an epoch
    weights = load_model(f"{path}/epoch={rows[-1]['epoch']}").stages[-1].weights if rows and model_type in WARM else None
    for epoch in range(len(rows) + 1, epochs + 1):
        warm = model_type in WARM
        est = create_estimator(model_type, n_features, n_classes, max_iter=iterations if warm else iterations * epoch, **params)
        if weights is not None:
            est = est.setInitialWeights(weights)
        model = PipelineModel(stages=[est.fit(data["train"])])
        weights = model.stages[-1].weights if warm else None
        losses = loss_history(model).orderBy(F.col("iteration").desc()).first()["loss"]
        result, _ = evaluate(model, data["val"])
        m = result.first()
        save_model(model, f"{path}/epoch={epoch}")
        rows.append({"epoch": epoch, "train_loss": float(losses), "eval_loss": m["loss"], "accuracy": m["accuracy"]})
        spark.createDataFrame([(rows[-1]["epoch"], rows[-1]["train_loss"], rows[-1]["eval_loss"], rows[-1]["accuracy"])], HISTORY) \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/history/run={epoch}")
    best = best_epoch(read_history(spark, path)).first()["epoch"]
    return {"model_path": f"{path}/epoch={best}", "best_epoch": best, "final_metrics": rows[-1], "history": rows}


def read_history(spark, path: str) -> DataFrame:
    """(epoch, train_loss, eval_loss, accuracy) of the finished epochs under ``path``."""
    try:
        return spark.read.parquet(f"{path}/history").drop("run")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY)


def load_best(spark, path: str) -> PipelineModel:
    """The model of the best finished epoch under ``path``."""
    best = best_epoch(read_history(spark, path)).first()
    if best is None:
        raise FileNotFoundError(f"no finished epoch under {path}")
    return load_model(f"{path}/epoch={best['epoch']}")


def train_run(df: DataFrame, feature_cols: list[str] | str, label: str, key: str, model_type: str = "mlp",
              val_split: float = 0.2, seed: int = 42, **params) -> dict:
    """Split (D02) -> fit (T01) -> evaluate on val (T05) -> result dict with the metrics
    logged at run end (R16). Errors are raised; ``lifecycle.training_cycle`` records them as a
    failed run first."""
    from cadence.operators.split import train_val_split
    split = train_val_split(df, key, val_split, seed)
    data = assemble(split, feature_cols, label)
    model = fit(data.where(F.col("split") == "train"), model_type, seed=seed, **params)
    metrics, _ = evaluate(model, data.where(F.col("split") == "val"))
    row = metrics.first().asDict()
    hist = loss_history(model)
    final_loss = hist.orderBy(F.col("iteration").desc()).first()["loss"] if hist is not None else None
    return {"status": "FINISHED", "model": model, "final_train_loss": final_loss,
            "final_accuracy": row["accuracy"], "final_f1_score": row["f1_score"], "val_loss": row["loss"]}


__all__ = ["MODELS", "assemble", "best_epoch", "create_estimator", "evaluate", "evaluate_path", "evaluate_rows", "evaluate_run", "fit",
           "list_model_types", "load_best", "load_model", "loss_history", "read_history", "register_model_type", "save_model",
           "score", "score_pair", "train_epochs", "train_run"]
