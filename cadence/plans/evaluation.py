"""Evaluation queries (E01-E08, B03, B06, P06, P11, P12) over labels, documents, embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.functions.arrays import argmax, softmax
from cadence.functions.columns import round_doubles
from cadence.operators.metrics import (classification_metrics, classification_report,
                                       confusion_matrix, log_loss, per_class_scores, roc_auc,
                                       roc_auc_ovr, valid_targets)
from cadence.operators.score import linear_logits, nearest_centroid, response_shape, score_logits
from cadence.plans.catalog import query
from cadence.tables import table


def scored_documents(spark, sf_dir):
    """labels joined with documents; p(quality) = n_chars / (n_chars + 500), class = p >= 0.5."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    p = F.col("n_chars").cast("double") / (F.col("n_chars").cast("double") + F.lit(500.0))
    return lab.join(doc, "doc_id").select(
        "doc_id", F.col("quality").alias("y"), p.alias("p"),
        (p >= 0.5).cast("int").alias("pred"), F.array(1.0 - p, p).alias("probs"))


_DOCS = """d AS (SELECT l.doc_id, l.quality AS y, CAST(x.n_chars AS DOUBLE) / (CAST(x.n_chars AS DOUBLE) + 500.0) AS p
          FROM labels l JOIN documents x ON l.doc_id = x.doc_id),
dp AS (SELECT doc_id, y, p, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS pred FROM d)"""

_PER_CLASS = """pc AS (SELECT y AS label, pred AS prediction, count(*) AS cnt FROM {src} GROUP BY 1, 2),
roles AS (SELECT label AS cls, cnt AS support, 0 AS predicted, CASE WHEN label = prediction THEN cnt ELSE 0 END AS tp FROM pc
          UNION ALL SELECT prediction, 0, cnt, 0 FROM pc),
per AS (SELECT cls, sum(tp) AS tp, sum(support) AS support, sum(predicted) AS predicted FROM roles GROUP BY cls),
sc AS (SELECT cls, tp, support, predicted,
              CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall FROM per),
sf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM sc)"""


def _weighted_sql(src_ctes: str, src: str) -> str:
    return f"""WITH {src_ctes}, {_PER_CLASS.format(src=src)}
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(precision * support) / sum(support), 6) AS precision,
       round(sum(recall * support) / sum(support), 6) AS recall,
       round(sum(f1 * support) / sum(support), 6) AS f1_score,
       CAST(sum(support) AS BIGINT) AS num_samples FROM sf"""


@query("binary_metrics", "E01 E02", _weighted_sql(_DOCS, "dp"))
def q_binary_metrics(spark, sf_dir):
    return round_doubles(classification_metrics(scored_documents(spark, sf_dir), "y", "pred"))


@query("binary_metrics_macro", "E02", f"""WITH {_DOCS}, {_PER_CLASS.format(src='dp')}
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(avg(precision), 6) AS precision,
       round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1_score, CAST(sum(support) AS BIGINT) AS num_samples FROM sf""")
def q_binary_metrics_macro(spark, sf_dir):
    return round_doubles(classification_metrics(scored_documents(spark, sf_dir), "y", "pred", "macro"))


@query("binary_metrics_micro", "E02", f"""WITH {_DOCS}, {_PER_CLASS.format(src='dp')},
m AS (SELECT sum(tp) / sum(predicted) AS mp, sum(tp) / sum(support) AS mr, sum(tp) / sum(support) AS acc,
             sum(support) AS n FROM sf)
SELECT round(acc, 6) AS accuracy, round(mp, 6) AS precision, round(mr, 6) AS recall,
       round(CASE WHEN mp + mr = 0 THEN 0.0 ELSE 2 * mp * mr / (mp + mr) END, 6) AS f1_score,
       CAST(n AS BIGINT) AS num_samples FROM m""")
def q_binary_metrics_micro(spark, sf_dir):
    return round_doubles(classification_metrics(scored_documents(spark, sf_dir), "y", "pred", "micro"))


def _auc_sql(src_ctes: str, src: str, group: str | None = None) -> str:
    g = f"{group}, " if group else ""
    part = f"PARTITION BY {group} " if group else ""
    return f"""WITH {src_ctes},
c AS (SELECT {g}s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y <> 1) AS neg FROM {src} GROUP BY {g}s),
w AS (SELECT {g}s, pos, neg,
             COALESCE(sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
a AS (SELECT {g}CAST(sum(pos) AS BIGINT) AS pos_total, CAST(sum(neg) AS BIGINT) AS neg_total,
             sum(pos * (below + neg / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auc FROM w {'GROUP BY ' + group if group else ''})"""


@query("roc_auc", "E05", _auc_sql(_DOCS + ", s AS (SELECT y, p AS s FROM dp)", "s")
       + " SELECT pos_total, neg_total, round(CASE WHEN pos_total > 0 AND neg_total > 0 THEN auc END, 6) AS auc FROM a")
def q_roc_auc(spark, sf_dir):
    return round_doubles(roc_auc(scored_documents(spark, sf_dir), "y", "p"))


@query("log_loss", "E08", f"""WITH {_DOCS}
SELECT round(avg(-ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)), 6) AS loss, CAST(count(*) AS BIGINT) AS num_samples FROM dp""")
def q_log_loss(spark, sf_dir):
    return round_doubles(log_loss(scored_documents(spark, sf_dir), "y", "probs", from_logits=False))


@query("confusion", "E04 J06", f"""WITH {_DOCS},
g AS (SELECT a.l AS label, b.l AS prediction FROM (SELECT y AS l FROM dp UNION SELECT pred FROM dp) a,
                                                  (SELECT y AS l FROM dp UNION SELECT pred FROM dp) b),
c AS (SELECT y AS label, pred AS prediction, count(*) AS cnt FROM dp GROUP BY 1, 2)
SELECT CAST(g.label AS BIGINT) AS label, CAST(g.prediction AS BIGINT) AS prediction, CAST(COALESCE(c.cnt, 0) AS BIGINT) AS count
FROM g LEFT JOIN c ON g.label = c.label AND g.prediction = c.prediction""")
def q_confusion(spark, sf_dir):
    return confusion_matrix(scored_documents(spark, sf_dir), "y", "pred")


@query("target_filter", "P06", """
SELECT CAST(count(*) FILTER (WHERE quality + toxic >= 0 AND quality + toxic < 2) AS BIGINT) AS kept,
       CAST(count(*) FILTER (WHERE NOT (quality + toxic >= 0 AND quality + toxic < 2) OR quality + toxic IS NULL) AS BIGINT) AS dropped
FROM labels""")
def q_target_filter(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").withColumn("y", F.col("quality") + F.col("toxic"))
    _, counts = valid_targets(lab, "y", 2)
    return counts


# ----------------------------------------------------------------------------------------
# Multi-class: nearest-centroid scorer over embeddings

def centroid_scored(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return nearest_centroid(emb, "embedding", "label").select(
        "vec_id", F.col("label").cast("long").alias("y"), F.col("prediction").alias("pred"), "probabilities")


_EMB = """u AS (SELECT vec_id, label, unnest(embedding) AS x, unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
cen AS (SELECT label AS cls, i, avg(CAST(x AS DOUBLE)) AS c FROM u GROUP BY label, i),
dots AS (SELECT u.vec_id, cen.cls, sum(CAST(u.x AS DOUBLE) * cen.c) AS s FROM u JOIN cen ON u.i = cen.i GROUP BY u.vec_id, cen.cls),
mx AS (SELECT vec_id, max(s) AS m FROM dots GROUP BY vec_id),
pr AS (SELECT d.vec_id, d.cls, exp(d.s - mx.m) / sum(exp(d.s - mx.m)) OVER (PARTITION BY d.vec_id) AS prob,
              row_number() OVER (PARTITION BY d.vec_id ORDER BY d.s DESC, d.cls) AS rk
       FROM dots d JOIN mx ON d.vec_id = mx.vec_id),
ep AS (SELECT e.vec_id, CAST(e.label AS BIGINT) AS y, CAST(p.cls AS BIGINT) AS pred
       FROM embeddings e JOIN pr p ON e.vec_id = p.vec_id AND p.rk = 1)"""


@query("nearest_centroid", "B06 P11 P12", f"""WITH {_EMB}
SELECT y AS label, pred AS prediction, CAST(count(*) AS BIGINT) AS n FROM ep GROUP BY 1, 2""")
def q_nearest_centroid(spark, sf_dir):
    s = centroid_scored(spark, sf_dir)
    return s.groupBy(F.col("y").alias("label"), F.col("pred").alias("prediction")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


@query("nearest_centroid_blocks", "B06", f"""WITH {_EMB}
SELECT y AS label, pred AS prediction, CAST(count(*) AS BIGINT) AS n FROM ep GROUP BY 1, 2""")
def q_nearest_centroid_blocks(spark, sf_dir):
    """The centroids in blocks of a few classes, as a table too large for literals is scored."""
    s = nearest_centroid(table(spark, sf_dir, "embeddings"), "embedding", "label", max_cells=200)
    return s.groupBy(F.col("label").cast("long").alias("label"), "prediction").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("multiclass_metrics", "E01 E02 B06", _weighted_sql(_EMB, "ep"))
def q_multiclass_metrics(spark, sf_dir):
    return round_doubles(classification_metrics(centroid_scored(spark, sf_dir), "y", "pred"))


@query("per_class_f1", "E03", f"""WITH {_EMB}, {_PER_CLASS.format(src='ep')}
SELECT CAST(cls AS BIGINT) AS label, CAST(tp AS BIGINT) AS tp, CAST(support AS BIGINT) AS support,
       CAST(predicted AS BIGINT) AS predicted, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1 FROM sf""")
def q_per_class_f1(spark, sf_dir):
    return round_doubles(per_class_scores(centroid_scored(spark, sf_dir), "y", "pred"))


@query("auc_ovr", "E06", f"""WITH {_EMB},
ps AS (SELECT p.cls, CAST(e.label AS BIGINT) AS lab, p.prob AS s FROM pr p JOIN embeddings e ON e.vec_id = p.vec_id),
c AS (SELECT cls, s, count(*) FILTER (WHERE lab = cls) AS pos, count(*) FILTER (WHERE lab <> cls) AS neg FROM ps GROUP BY cls, s),
w AS (SELECT cls, s, pos, neg,
             COALESCE(sum(neg) OVER (PARTITION BY cls ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
a AS (SELECT cls, sum(pos) AS pt, sum(pos * (below + neg / 2.0)) / (sum(pos) * CAST(sum(neg) AS DOUBLE)) AS auc
      FROM w GROUP BY cls HAVING sum(pos) > 0)
SELECT CAST(count(*) AS BIGINT) AS classes, round(sum(auc * pt) / sum(pt), 6) AS auc FROM a""")
def q_auc_ovr(spark, sf_dir):
    s = centroid_scored(spark, sf_dir)
    return round_doubles(roc_auc_ovr(s, "y", "probabilities"))


@query("classification_report", "E07", f"""WITH {_EMB}, {_PER_CLASS.format(src='ep')}
SELECT CAST(cls AS VARCHAR) AS name, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM sf
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM sf
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM sf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM sf""")
def q_classification_report(spark, sf_dir):
    return round_doubles(classification_report(centroid_scored(spark, sf_dir), "y", "pred"))


# ----------------------------------------------------------------------------------------
# Logit helpers

_CLASSES = 3
_W = [[((i * (c + 2)) % 7 - 3) / 4.0 for i in range(64)] for c in range(_CLASSES)]
_LOGIT = "list_sum(list_transform(range(0, 64), lambda i: CAST(embedding[i + 1] AS DOUBLE) * ((i * ({c} + 2)) % 7 - 3) / 4.0)) AS l{c}"


@query("softmax_argmax", "P11 P12 P13 B03 B01", f"""
WITH l AS (SELECT vec_id, {", ".join(_LOGIT.format(c=c) for c in range(_CLASSES))} FROM embeddings),
m AS (SELECT *, greatest(l0, l1, l2) AS mx FROM l),
p AS (SELECT vec_id, CASE WHEN l0 = mx THEN 0 WHEN l1 = mx THEN 1 ELSE 2 END AS k,
             1.0 / (exp(l0 - mx) + exp(l1 - mx) + exp(l2 - mx)) AS pmax FROM m)
SELECT CAST(k AS DOUBLE) AS prediction, CAST(count(*) AS BIGINT) AS n, round(avg(pmax), 6) AS mean_top_probability
FROM p GROUP BY k""")
def q_softmax_argmax(spark, sf_dir):
    """A linear model over all 64 dimensions with weights from a rule."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    s = score_logits(emb, linear_logits(F.col("x"), _W), version="linear-v1")
    return round_doubles(s.groupBy("prediction").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.avg(F.array_max("probabilities")).alias("mean_top_probability")))


@query("response_shape", "B04 B01", f"""
WITH l AS (SELECT vec_id, {", ".join(_LOGIT.format(c=c) for c in range(_CLASSES))} FROM embeddings),
p AS (SELECT vec_id, CASE WHEN l0 = greatest(l0, l1, l2) THEN 0 WHEN l1 = greatest(l0, l1, l2) THEN 1 ELSE 2 END AS k FROM l)
SELECT 'linear-v1' AS model_version, CAST(k AS DOUBLE) AS prediction, CAST(count(*) AS BIGINT) AS n,
       CAST(count(*) FILTER (WHERE vec_id % 2 = 1) AS BIGINT) AS generated_ids,
       CAST(sum(CASE WHEN vec_id % 2 = 0 THEN vec_id ELSE 0 END) AS BIGINT) AS given_ids FROM p GROUP BY k""")
def q_response_shape(spark, sf_dir):
    """Responses to scored requests; those with an odd id come without one."""
    emb = table(spark, sf_dir, "embeddings").select(
        F.when(F.col("vec_id") % 2 == 0, F.col("vec_id").cast("string")).alias("request_id"),
        F.col("embedding").cast("array<double>").alias("x"))
    r = response_shape(score_logits(emb, linear_logits(F.col("x"), _W)), "linear-v1")
    made = F.col("request_id").startswith("req_")
    return r.groupBy("model_version", "prediction").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.count_if(made).cast("bigint").alias("generated_ids"),
        F.coalesce(F.sum(F.when(~made, F.col("request_id")).cast("bigint")), F.lit(0)).cast("bigint").alias("given_ids"))


__all__ = ["argmax", "softmax"]


# ----------------------------------------------------------------------------------------
# Training frame preparation (P03-P05, P10) and feature validation

from cadence.operators.prepare import drop_target_marker, resolve_target, training_types  # noqa: E402
from cadence.operators.score import validate_features  # noqa: E402


@query("training_frame", "P03 P04 P05 P10", """
WITH t AS (SELECT doc_id, quality, toxic, quality - toxic AS label FROM labels)
SELECT CAST(label AS BIGINT) AS label, CAST(count(*) AS BIGINT) AS n,
       round(sum(CAST(CAST(doc_id AS FLOAT) AS DOUBLE)), 6) AS doc_id_sum, round(sum(CAST(quality AS FLOAT)), 6) AS quality_sum
FROM t WHERE label <> -1 GROUP BY 1""")
def q_training_frame(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").withColumn("label", F.col("quality") - F.col("toxic"))
    tgt = resolve_target(lab.columns, "target")          # not configured, no 'target': last column
    t = training_types(drop_target_marker(lab, tgt), tgt)
    return round_doubles(t.groupBy(tgt).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                            F.sum(F.col("doc_id").cast("double")).alias("doc_id_sum"),
                                            F.sum(F.col("quality").cast("double")).alias("quality_sum")))


@query("feature_validation", "B05", """
WITH f AS (SELECT vec_id, CASE WHEN label = 0 THEN embedding[1:63] ELSE embedding END AS features FROM embeddings),
r AS (SELECT CASE WHEN features IS NULL THEN 'missing features'
                  WHEN len(features) <> 64 THEN printf('expected %d features, got %d', 64, len(features))
                  WHEN list_bool_or(list_transform(features, lambda v: v IS NULL OR isnan(v))) THEN 'null or NaN feature' END AS reject_reason
      FROM f)
SELECT COALESCE(reject_reason, 'ok') AS outcome, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY 1""")
def q_feature_validation(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    f = emb.select("vec_id", F.when(F.col("label") == 0, F.slice("embedding", 1, 63))
                   .otherwise(F.col("embedding")).alias("features"))
    ok, bad = validate_features(f, "features", 64)
    return ok.select(F.lit("ok").alias("outcome")).unionByName(bad.select(F.col("reject_reason").alias("outcome"))) \
             .groupBy("outcome").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
