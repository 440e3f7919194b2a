"""Classification metrics computed on executors.

Everything starts from one grouped count per (label, prediction) pair - a map-side combined
aggregate whose output has at most k^2 rows - so accuracy, precision / recall / F1
(weighted, macro, micro, per class), the confusion matrix and the report never move rows.
ROC-AUC is exact (ties count one half) and distributed: rows collapse to distinct scores
with positive / negative counts in ranges of about equal size, and each takes the negatives
below it from its range and the totals of the ranges below. No window runs over a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.arrays import log_softmax_at
from cadence.functions.quantiles import equal_ranges, small_table
from cadence.functions.ranking import global_rank
from cadence.functions.stats import ratio_or_zero
from cadence.session import checkpoint_dir


def valid_targets(df: DataFrame, label: str, num_classes: int) -> tuple[DataFrame, DataFrame]:
    """Keep ``0 <= y < k`` and non-null; returns (kept rows, one-row counts)."""
    ok = F.col(label).isNotNull() & (F.col(label) >= 0) & (F.col(label) < num_classes)
    counts = df.agg(F.count_if(ok).cast("bigint").alias("kept"),
                    F.count_if(~F.coalesce(ok, F.lit(False))).cast("bigint").alias("dropped"))
    return df.where(ok), counts


def pair_counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    """(label, prediction, count): the sufficient statistic of every count-based metric."""
    return df.groupBy(F.col(label).cast("long").alias("label"),
                      F.col(pred).cast("long").alias("prediction")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"))


def per_class_scores(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Label, tp, support, predicted, precision, recall, f1 for each class in the
    union of true and predicted labels (zero division -> 0)."""
    pc = pair_counts(df, label, pred)
    roles = pc.select(F.explode(F.array(
        F.struct(F.col("label").alias("cls"), F.col("count").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0).cast("bigint").alias("tp")),
        F.struct(F.col("prediction").alias("cls"), F.lit(0).cast("bigint").alias("support"), F.col("count").alias("predicted"),
                 F.lit(0).cast("bigint").alias("tp")))).alias("r")).select("r.*")
    per = roles.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                   F.sum("predicted").alias("predicted"))
    p = ratio_or_zero(F.col("tp"), F.col("predicted"))
    r = ratio_or_zero(F.col("tp"), F.col("support"))
    return (per.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", ratio_or_zero(2 * F.col("precision") * F.col("recall"),
                                            F.col("precision") + F.col("recall")))
            .withColumnRenamed("cls", "label")
            .select("label", "tp", "support", "predicted", "precision", "recall", "f1"))


def classification_metrics(df: DataFrame, label: str, pred: str, average: str = "weighted") -> DataFrame:
    """E01 + E02: one row accuracy, precision, recall, f1_score, num_samples."""
    if average not in ("weighted", "macro", "micro"):
        raise ValueError("average must be weighted, macro or micro")
    per = per_class_scores(df, label, pred)
    n = F.sum("support")
    acc = ratio_or_zero(F.sum("tp"), n)
    if average == "weighted":
        agg = [ratio_or_zero(F.sum(F.col(m) * F.col("support")), n).alias(m) for m in ("precision", "recall", "f1")]
    elif average == "macro":
        agg = [F.avg(m).alias(m) for m in ("precision", "recall", "f1")]
    else:  # micro over all classes of single-label data equals accuracy
        mp = ratio_or_zero(F.sum("tp"), F.sum("predicted"))
        mr = ratio_or_zero(F.sum("tp"), n)
        agg = [mp.alias("precision"), mr.alias("recall"),
               ratio_or_zero(2 * mp * mr, mp + mr).alias("f1")]
    return per.agg(acc.alias("accuracy"), *agg, n.cast("bigint").alias("num_samples")) \
              .withColumnRenamed("f1", "f1_score")


def confusion_matrix(df: DataFrame, label: str, pred: str) -> DataFrame:
    """E04 long form (label, prediction, count), zero-filled over the grid of all classes seen.

    The pair counts are written once (at most one row per pair that occurs). The classes are numbered;
    every class lists the numbers of all others, which are joined to their classes, so the k x k cells
    come from k rows in as many tasks as there are partitions, and no row holds the classes."""
    checkpoint_dir(df.sparkSession)
    pc = pair_counts(df, label, pred).checkpoint()
    classes = pc.select(F.explode(F.array("label", "prediction")).alias("c")).where(F.col("c").isNotNull()).distinct()
    numbered = small_table(global_rank(classes, ["c"], "at"))
    last = numbered.agg(F.max("at")).first()[0]
    every = F.sequence(F.lit(0), F.lit(-1 if last is None else last).cast("int")).cast("array<bigint>")
    grid = (numbered.where("at is not null").select(F.col("c").alias("label"), F.explode(every).alias("at"))
            .join(numbered.select(F.col("c").alias("prediction"), "at"), "at").select("label", "prediction"))
    return grid.join(pc, ["label", "prediction"], "left") \
               .select("label", "prediction", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def confusion_wide(df: DataFrame, label: str, pred: str) -> DataFrame:
    """E04 dense form: one row per true label with the counts of all predictions, by class."""
    return confusion_matrix(df, label, pred).groupBy("label").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("prediction", "count")))).alias("counts"))


def _auc(rows: DataFrame, groups: list[str]) -> DataFrame:
    """rows: (groups..., score, hit), hit telling positives. Returns (groups..., pos_total, neg_total,
    auc) with ties counted one half.

    Scores are dealt to ranges of about equal size. A range's totals say how many negatives lie below
    it, and inside a range the distinct scores are sorted by themselves, so ties are exact and no
    task sees more than a range."""
    ranged = equal_ranges(rows, "score", groups, out="__range")
    keys = [*groups, "__range"]
    counts = ranged.groupBy(*keys, "score").agg(F.count_if("hit").alias("pos"), F.count_if(~F.col("hit")).alias("neg"))
    inside = Window.partitionBy(*keys).orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    below = F.sum("neg").over(inside) - F.col("neg")
    totals = counts.withColumn("__below", below).groupBy(*keys).agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.sum(F.col("pos") * (F.col("__below") + F.col("neg") / 2.0)).alias("__won"))
    # At most a few thousand ranges a group.
    earlier = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("__range").rowsBetween(
        Window.unboundedPreceding, 0)
    won = F.col("__won") + F.col("pos") * (F.sum("neg").over(earlier) - F.col("neg"))
    return totals.withColumn("__won", won).groupBy(*groups).agg(
        F.sum("pos").cast("bigint").alias("pos_total"), F.sum("neg").cast("bigint").alias("neg_total"),
        F.sum("__won").alias("__num")).select(
        *groups, "pos_total", "neg_total",
        F.try_divide(F.col("__num"), F.col("pos_total") * F.col("neg_total").cast("double")).alias("auc"))


def scored(df: DataFrame, score: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a score (neither NULL nor NaN), and a one-row count of the others (dropped)."""
    ok = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
    return df.where(ok), df.agg(F.count_if(~ok).cast("bigint").alias("dropped"))


def roc_auc(df: DataFrame, label: str, score: str, positive: int = 1) -> DataFrame:
    """One row (pos_total, neg_total, auc); auc NULL with a single class. Rows without a
    score don't rank; ``scored`` counts them."""
    df = scored(df, score)[0].where(F.col(label).isNotNull())
    out = _auc(df.select(F.col(score).cast("double").alias("score"), (F.col(label) == positive).alias("hit")), [])
    return out.select("pos_total", "neg_total",
                      F.when((F.col("pos_total") > 0) & (F.col("neg_total") > 0), F.col("auc")).alias("auc"))


def roc_auc_ovr(df: DataFrame, label: str, probs: str, average: str = "weighted") -> DataFrame:
    """One-vs-rest AUC per class from a probability array, averaged by support
    (``weighted``) or plainly (``macro``). Returns one row (classes, auc)."""
    exploded = df.select(F.col(label).cast("long").alias("y"),
                         F.posexplode(probs).alias("cls", "score"))
    exploded = scored(exploded, "score")[0].where(F.col("y").isNotNull())
    per = _auc(exploded.select("cls", F.col("score").cast("double").alias("score"), (F.col("y") == F.col("cls")).alias("hit")),
               ["cls"]).where(F.col("pos_total") > 0)
    if average == "weighted":
        auc = F.try_divide(F.sum(F.col("auc") * F.col("pos_total")), F.sum("pos_total").cast("double"))
    else:
        auc = F.avg("auc")
    return per.agg(F.count(F.lit(1)).cast("bigint").alias("classes"), auc.alias("auc"))


def log_loss(df: DataFrame, label: str, col: str, from_logits: bool = True) -> DataFrame:
    """Mean cross-entropy. From logits with log-sum-exp; from probabilities -ln p[y]."""
    y = F.col(label).cast("int")
    if from_logits:
        ll = -log_softmax_at(F.col(col), y)
    else:
        ll = -F.ln(F.element_at(F.col(col), y + 1))
    return df.agg(F.avg(ll).alias("loss"), F.count(F.lit(1)).cast("bigint").alias("num_samples"))


def classification_report(df: DataFrame, label: str, pred: str,
                          class_names: dict[int, str] | None = None) -> DataFrame:
    """E07 as rows: one per class (name, precision, recall, f1, support) then accuracy,
    macro avg and weighted avg."""
    checkpoint_dir(df.sparkSession)
    per = per_class_scores(df, label, pred).checkpoint()  # read four times, one row per class
    names = class_names or {}
    name = F.col("label").cast("string")
    if names:
        m = F.create_map(*[x for k, v in names.items() for x in (F.lit(k), F.lit(v))])
        name = F.coalesce(F.element_at(m, F.col("label")), name)
    rows = per.select(name.alias("name"), "precision", "recall", "f1", "support")
    n = F.sum("support")
    acc = per.agg(F.lit("accuracy").alias("name"), F.lit(None).cast("double").alias("precision"),
                  F.lit(None).cast("double").alias("recall"), ratio_or_zero(F.sum("tp"), n).alias("f1"), n.alias("support"))
    macro = per.agg(F.lit("macro avg").alias("name"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), n.alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("name"),
                       *[ratio_or_zero(F.sum(F.col(m) * F.col("support")), n).alias(m) for m in ("precision", "recall", "f1")],
                       n.alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted) \
               .withColumn("support", F.col("support").cast("bigint"))
