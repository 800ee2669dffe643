"""Evaluation (V1-V9) for train and test rows in one pass.

Predictions of both sides live in one frame with an ``is_test`` flag; each
report is a single aggregate with conditional sums, not one job per side.

ROC AUC (V7) is exact with ties counted half: scores are grouped first
(one row per distinct score and side), then each score needs the number of
negatives below it -- a running total over range partitions of the score
(:mod:`larch.operators.ranking`), so no window sees the whole table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larch.functions.scalar import label_from_p0
from larch.operators import ranking

SPLIT = "is_test"
SIDES = (("train", False), ("test", True))


def _side(c: Column, side: bool) -> Column:
    return F.when(F.col(SPLIT) == F.lit(side), c)


def regression_report(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """V1 + V2 (+ F7): rmse and mae of each side, one row."""
    err = F.col(label).cast("double") - F.col(prediction)
    aggs = []
    for name, side in SIDES:
        aggs.append(F.sqrt(F.avg(_side(err * err, side))).alias(f"rmse_{name}"))
    for name, side in SIDES:
        aggs.append(F.avg(_side(F.abs(err), side)).alias(f"mae_{name}"))
    return pred.agg(*aggs)


def regression_reports(pred: DataFrame, label: str, predictions: list[str]) -> list[dict]:
    """V8 for many prediction columns of the same rows in ONE aggregate
    (a whole search is scored in a single pass)."""
    y = F.col(label).cast("double")
    aggs = []
    for j, p in enumerate(predictions):
        err = y - F.col(p)
        for name, side in SIDES:
            aggs.append(F.sqrt(F.avg(_side(err * err, side))).alias(f"rmse_{name}__{j}"))
            aggs.append(F.avg(_side(F.abs(err), side)).alias(f"mae_{name}__{j}"))
    r = pred.agg(*aggs).first().asDict()
    return [{m: r[f"{m}__{j}"] for m in METRIC_ORDER_REGRESSION} for j in range(len(predictions))]


def auc_of_scores(by_score: DataFrame, group_cols: list[str], n_buckets: int) -> DataFrame:
    """AUC per group from (groups, _s, _pos, _neg), one row per distinct score."""
    ranged = ranking.with_range_bucket(by_score, "_s", n_buckets).persist(StorageLevel.MEMORY_AND_DISK)
    d = ranking.running_totals(ranged, ["_s"], {"_negc": F.col("_neg")}, F.col("_bkt"), group_cols)
    term = F.col("_pos") * (F.col("_negc_before") + F.col("_neg") / F.lit(2.0))
    out = d.groupBy(*group_cols).agg(
        F.sum(term).alias("_u"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                 F.col("_u") / (F.col("_p").cast("double") * F.col("_n").cast("double")))
    out = out.select(*group_cols, auc.alias("roc_auc"))
    rows = out.collect()  # one row per group
    ranged.unpersist()
    return by_score.sparkSession.createDataFrame(rows, out.schema)


def _class_counts(d: DataFrame, y: Column, keys: list) -> DataFrame:
    return d.groupBy(*keys).agg(F.sum((y == 1).cast("long")).alias("_pos"), F.sum((y == 0).cast("long")).alias("_neg"))


def roc_auc(df: DataFrame, label: str, score: str, group_cols: list[str] | None = None,
            rows_per_bucket: int = ranking.ROWS_PER_BUCKET) -> DataFrame:
    """V7: exact ROC AUC per group; ties between a positive and a negative
    count one half. NULL when a group has only one class. Runs at once; the
    rows are aggregated to distinct scores in one pass over ``df``."""
    group_cols = list(group_cols or [])
    by_score = _class_counts(df, F.col(label).cast("int"), [*group_cols, F.col(score).cast("double").alias("_s")]).persist(
        StorageLevel.MEMORY_AND_DISK)
    out = auc_of_scores(by_score, group_cols, ranking.bucket_count(by_score.count(), rows_per_bucket))
    by_score.unpersist()
    return out


def classification_report(pred: DataFrame, label: str, p1: str | None = None,
                          predicted: str | Column | None = None,
                          threshold: float = 0.5, score: str | None = None) -> DataFrame:
    """V3-V9: accuracy, precision, recall, f1 and ROC AUC of each side.

    The predicted label is ``predicted`` when given, else F9 on
    ``1 - p1`` (P(class 0)) with ``threshold``. AUC uses ``score`` (default
    ``p1``). Precision, recall and f1 are 0 when undefined.

    One pass over ``pred``: rows are counted by (side, score, predicted label)
    and class; the confusion sums and the AUC both come from these counts."""
    if predicted is None:
        predicted = label_from_p0(F.lit(1.0) - F.col(p1), threshold)
    elif isinstance(predicted, str):
        predicted = F.col(predicted)
    has_score = bool(score or p1)
    shown = F.col(score or p1).cast("double") if has_score else F.lit(None).cast("double")
    counts = _class_counts(pred, F.col(label).cast("int"), [F.col(SPLIT), shown.alias("_s"), predicted.cast("int").alias("_yhat")]).persist(
        StorageLevel.MEMORY_AND_DISK)
    said = F.col("_yhat") == 1

    def total(when: Column, c: str) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))

    tp, fp = total(said, "_pos"), total(said, "_neg")
    fn, tn = total(F.col("_yhat") == 0, "_pos"), total(F.col("_yhat") == 0, "_neg")
    out = counts.groupBy(SPLIT).agg(
        ((tp + tn) / F.nullif(F.sum(F.col("_pos") + F.col("_neg")), F.lit(0))).alias("accuracy"),
        F.coalesce(tp / F.nullif(tp + fp, F.lit(0)), F.lit(0.0)).alias("precision"),
        F.coalesce(tp / F.nullif(tp + fn, F.lit(0)), F.lit(0.0)).alias("recall"),
        F.coalesce(2 * tp / F.nullif(2 * tp + fp + fn, F.lit(0)), F.lit(0.0)).alias("f1_score"),
        F.count(F.lit(1)).alias("_scores"))
    sides = out.collect()  # one row per side
    spark = pred.sparkSession
    per_side = spark.createDataFrame(sides, out.schema)
    metrics = ["accuracy", "precision", "recall", "f1_score"]
    if has_score:
        by_score = counts.groupBy(SPLIT, "_s").agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        n = ranking.bucket_count(sum(r["_scores"] for r in sides))
        per_side = per_side.join(auc_of_scores(by_score, [SPLIT], n), SPLIT, "left")
        metrics.append("roc_auc")
    counts.unpersist()
    return per_side.agg(*[F.max(_side(F.col(m), side)).alias(f"{m}_{name}")
                          for m in metrics for name, side in SIDES])


METRIC_ORDER_CLASSIFICATION = [
    "accuracy_train", "accuracy_test", "precision_train", "precision_test",
    "recall_train", "recall_test", "roc_auc_train", "roc_auc_test",
    "f1_score_train", "f1_score_test"]
METRIC_ORDER_REGRESSION = ["rmse_train", "rmse_test", "mae_train", "mae_test"]
