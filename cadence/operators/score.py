"""Scoring (B01-B06, P10-P13).

Linear and nearest-centroid scorers are pure column expressions over array columns (the
weights / centroids are small literals, size-checked), so scoring is a projection with no
join and no shuffle (the array arithmetic runs as built-in higher-order functions). Spark ML models score through
``model.transform``; foreign Python models score through an Arrow-batched pandas UDF with
the model broadcast once.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.arrays import argmax, dot, output_switch, softmax
from cadence.session import checkpoint_dir

MAX_CENTROID_CELLS = 200_000   # classes x dimensions up to which centroids are literals; beyond, the size of a block


def linear_logits(x: Column, weights: list[list[float]], bias: list[float] | None = None) -> Column:
    """logits[c] = sum_i x_i * w[c][i] + b[c] as an array column."""
    bias = bias or [0.0] * len(weights)
    return F.array(*[dot(x, F.lit(np.array(w, dtype=float))) + F.lit(float(b))
                     for w, b in zip(weights, bias)])


def score_logits(df: DataFrame, logits: Column, version: str = "unknown") -> DataFrame:
    """B01 on a logit column: softmax probabilities, argmax class, model version."""
    pred, probs = output_switch(logits)
    return df.withColumn("__logits", logits).withColumns({
        "prediction": pred, "probabilities": probs, "model_version": F.lit(version)}).drop("__logits")


def centroid_cells(df: DataFrame, vec: str, label: str) -> DataFrame:
    """Class centroids as (label, pos, c): posexplode -> groupBy(label, pos).avg (map-side combined, k x d rows)."""
    return (df.select(F.col(label).cast("long").alias("label"), F.posexplode(F.col(vec).cast("array<double>")).alias("pos", "x"))
            .groupBy("label", "pos").agg(F.avg("x").alias("c")))


def fit_centroids(cells: DataFrame, max_cells: int = MAX_CENTROID_CELLS) -> tuple[list[int], list[list[float]]] | None:
    """(labels, centroids) of at most ``max_cells`` cells; None if there are more."""
    rows = cells.limit(max_cells + 1).collect()
    if len(rows) > max_cells:
        return None
    by: dict[int, dict[int, float]] = {}
    for r in rows:
        by.setdefault(r["label"], {})[r["pos"]] = r["c"]
    labels = sorted(by)
    dim = max(len(v) for v in by.values()) if by else 0
    return labels, [[by[lab].get(i, 0.0) for i in range(dim)] for lab in labels]


def centroid_scores(vec: Column, centroids: list[list[float]]) -> Column:
    """Dot product of the vector with every centroid (array of k doubles)."""
    x = vec.cast("array<double>")
    return F.array(*[dot(x, F.lit(np.array(c, dtype=float))) for c in centroids])


def nearest_centroid(df: DataFrame, vec: str, label: str, fit_df: DataFrame | None = None,
                     max_cells: int = MAX_CENTROID_CELLS) -> DataFrame:
    """prediction = label of the centroid with the largest dot product (first label on
    ties), probabilities = softmax of the dot products, in the order of the labels. Up to ``max_cells`` cells the
    centroids are literals of a projection; more are met block by block (`centroid_scores_by_blocks`)."""
    cells = centroid_cells(fit_df if fit_df is not None else df, vec, label)
    fitted = fit_centroids(cells, max_cells)
    if fitted is None:
        scored = centroid_scores_by_blocks(df, vec, cells, max_cells)
        return scored.withColumn("probabilities", softmax(F.col("__s"))).drop("__s")
    labels, cents = fitted
    scores = centroid_scores(F.col(vec), cents)
    lab_arr = F.lit(np.array(labels, dtype=np.int64)) if labels else F.array().cast("array<bigint>")
    return df.withColumn("__s", scores).withColumns({
        "prediction": F.element_at(lab_arr, argmax(F.col("__s")) + 1).cast("long"),
        "probabilities": softmax(F.col("__s"))}).drop("__s")


BLOCK_VALUES = 8_000_000   # numbers of the vectors that meet a block of centroids at once


def centroid_scores_by_blocks(df: DataFrame, vec: str, cells: DataFrame, block_cells: int = MAX_CENTROID_CELLS) -> DataFrame:
    """``df`` with ``prediction`` and ``__s``, the dot products with all centroids in the order of their labels.

    A blocked matrix product: centroids come in blocks of ``block_cells`` numbers, vectors in chunks, and each pair
    of a block and a chunk is multiplied in a task of its own; the best label and the block's products go
    back to the row. No centroid table is held by the driver or sent to all tasks."""
    from cadence.functions.quantiles import small_table
    from cadence.functions.ranking import global_rank
    checkpoint_dir(df.sparkSession)
    rows = df.withColumn("__row", F.monotonically_increasing_id()).checkpoint()
    vectors = cells.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "c"))), lambda x: x["c"]).alias("centroid"))
    centroids = small_table(global_rank(vectors, ["label"], "at"))
    size = centroids.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("centroid")).alias("d")).first()
    per_block = max(1, block_cells // size["d"])
    blocks, chunks = -(-size["k"] // per_block), max(1, -(-rows.count() * size["d"] // BLOCK_VALUES))
    left = (rows.select("__row", F.col(vec).cast("array<double>").alias("x")).withColumn("chunk", F.pmod(F.xxhash64("__row"), F.lit(chunks)))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))))
    right = (centroids.withColumn("block", F.floor(F.col("at") / per_block).cast("bigint"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>"))))

    def multiply(v, c):
        import pyarrow as pa
        names = ["__row", "block", "label", "best", "products"]
        if not v.num_rows or not c.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64())))})
        matrix = lambda col: np.asarray(col.combine_chunks().flatten()).reshape(len(col), -1)
        c = c.sort_by("at")
        products = matrix(v.column("x")) @ matrix(c.column("centroid")).T
        best = products.argmax(axis=1)  # the first label among equal ones
        n, k = products.shape
        return pa.table([v.column("__row"), v.column("block"), c.column("label").take(pa.array(best)).cast(pa.int64()),
                         pa.array(products[np.arange(n), best]),
                         pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), pa.array(products.ravel()))], names=names)

    met = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(
        multiply, "__row long, block long, label long, best double, products array<double>")
    whole = met.groupBy("__row").agg(F.max_by("label", F.struct("best", -F.col("label"))).alias("prediction"),
                                     F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "products"))), lambda b: b["products"])).alias("__s"))
    return rows.join(whole, "__row", "left").drop("__row")


def validate_features(df: DataFrame, features: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose feature array has the expected width and no NULL/NaN go to the first
    output, all others (with a reason) to the reject output."""
    ok_size = F.size(features) == width
    ok_vals = F.forall(features, lambda v: v.isNotNull() & ~F.isnan(v))
    reason = (F.when(F.col(features).isNull(), "missing features")
              .when(~ok_size, F.format_string("expected %d features, got %d", F.lit(width), F.size(features)))
              .when(~ok_vals, "null or NaN feature"))
    tagged = df.withColumn("__reason", reason)
    return (tagged.where(F.col("__reason").isNull()).drop("__reason"),
            tagged.where(F.col("__reason").isNotNull()).withColumnRenamed("__reason", "reject_reason"))


def response_shape(df: DataFrame, version: str | None = None, request_id: str = "request_id",
                   latency_col: str | None = None) -> DataFrame:
    """request_id (generated when absent), prediction, probabilities, model version
    (``unknown`` when not given), latency and an ISO timestamp."""
    rid = F.col(request_id) if request_id in df.columns else F.lit(None).cast("string")
    lat = F.col(latency_col) if latency_col else F.lit(None).cast("double")
    return df.select(
        F.coalesce(rid.cast("string"), F.concat(F.lit("req_"), F.expr("uuid()"))).alias("request_id"),
        "prediction", "probabilities",
        F.lit(version or "unknown").alias("model_version"), lat.alias("latency_ms"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"))


def pandas_model_scorer(spark, predict: Callable[[Any], Any], n_features: int) -> Callable[[Column], Column]:
    """B01 for foreign (non-Spark) models: an Arrow-batched pandas UDF; ``predict`` maps an
    (n, d) float array to (n, k) logits and is shipped once per executor via broadcast."""
    from pyspark import cloudpickle
    bc = spark.sparkContext.broadcast(cloudpickle.dumps(predict))   # closures and lambdas too
    loaded: dict = {}

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _score(features: pd.Series) -> pd.Series:
        import pickle

        import numpy as np
        if "fn" not in loaded:               # once per Python worker
            loaded["fn"] = pickle.loads(bc.value)
        fn = loaded["fn"]
        x = np.stack(features.to_numpy()).astype("float32").reshape(-1, n_features)
        out = np.asarray(fn(x), dtype="float64")
        return pd.Series(list(out))

    return _score
