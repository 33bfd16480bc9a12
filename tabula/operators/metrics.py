"""Evaluation metrics as aggregates over ``(y, prediction, p1)`` (V1-V17).

Classification metrics come from one grouped count per (true, predicted) class
pair; the confusion table has classes^2 rows whatever the data size.  The exact
ROC-AUC and the curve points work on the table of distinct scores with a
range-partitioned prefix sum (no single-task global window).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabula.operators.ordering import prefix_sum

# fixed values: metric names and whether larger is better
DIRECTION = {
    "accuracy": True, "f1": True, "precision": True, "recall": True, "roc_auc": True, "r2": True,
    "mse": False, "mae": False, "log_loss": False,
}
CLASSIFICATION = ("accuracy", "f1", "precision", "recall", "roc_auc", "log_loss")
REGRESSION = ("r2", "mse", "mae")
LOG_LOSS_EPS = 2.220446049250313e-16


def confusion(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Long confusion counts ``(y, pred, count)``."""
    return df.groupBy(F.col(y).alias("y"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, y: str, pred: str, labels: Sequence) -> DataFrame:
    """Wide confusion matrix: one row per true class, one column per predicted class."""
    return (confusion(df, y, pred).groupBy("y").pivot("pred", list(labels)).agg(F.first("count"))
            .na.fill(0))


def per_class(df: DataFrame, y: str, pred: str) -> DataFrame:
    """``(label, tp, n_pred, support, precision, recall, f1)``; a 0/0 ratio is 0."""
    cm = confusion(df, y, pred)
    tp = cm.where(F.col("y") == F.col("pred")).select(F.col("y").alias("label"), F.col("count").alias("tp"))
    npred = cm.groupBy(F.col("pred").alias("label")).agg(F.sum("count").alias("n_pred"))
    sup = cm.groupBy(F.col("y").alias("label")).agg(F.sum("count").alias("support"))
    t = sup.join(npred, "label", "full").join(tp, "label", "left").na.fill(0, ["tp", "n_pred", "support"])
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    t = t.select("label", "tp", "n_pred", "support", prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return t.withColumn("f1", f1)


def classification_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Per-class rows plus ``macro avg`` and ``weighted avg`` rows, and an
    ``accuracy`` row (precision = recall = f1 = accuracy)."""
    pc = per_class(df, y, pred).where(F.col("support") > 0)
    rows = pc.select(F.col("label").cast("string").alias("label"), "precision", "recall", "f1",
                     F.col("support").cast("bigint").alias("support"))
    tot = pc.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        (F.sum("tp") / F.sum("support")).alias("acc"),
        F.sum("support").cast("bigint").alias("n"))
    summary = tot.select(F.expr(
        "stack(3, 'macro avg', mp, mr, mf, n, 'weighted avg', wp, wr, wf, n, 'accuracy', acc, acc, acc, n)"
        " as (label, precision, recall, f1, support)"))
    return rows.unionByName(summary)


def weighted_scores(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Accuracy and support-weighted precision / recall / F1 in one row."""
    pc = per_class(df, y, pred)
    return pc.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))


def score_counts(df: DataFrame, y: str, score: str, positive=1, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (per key group)."""
    is_pos = (F.col(y) == F.lit(positive)).cast("bigint")
    return df.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("score")).agg(
        F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg"))


def roc_auc(df: DataFrame, y: str, score: str, positive=1, keys: Sequence[str] = ()) -> DataFrame:
    """Exact ROC-AUC (ties count one half), per key group when ``keys`` given:
    sum_s pos_s * (neg below s + neg_s / 2) / (P * N)."""
    keys = list(keys)
    sc = score_counts(df, y, score, positive, keys)
    cum = prefix_sum(sc, keys, ["score"], ["neg"], suffix="_below", inclusive=False)
    return cum.groupBy(*keys).agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
         / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def auc_of_counts(counts: DataFrame, key: str, ranges: int) -> DataFrame:
    """``(key, roc_auc)`` as ``roc_auc`` gives it, from ``(key, score, pos, neg)`` rows of which several may hold
    the same score.  They are sorted once, in ``ranges`` ranges; a range sends a row a key."""
    merged = counts.repartitionByRange(ranges, key, "score").groupBy(key, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    merged = merged.sortWithinPartitions(key, "score").select(key, "pos", "neg")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), {}  # key -> positives, negatives, pairs in order (ties: half)
        for batch in batches:
            k, pos, neg = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            for lo, hi in itertools.pairwise([*np.flatnonzero(np.r_[True, k[1:] != k[:-1]]), len(k)] if len(k) else []):
                p, n, pairs = held.get(k[lo], (0, 0, 0.0))
                own, other = pos[lo:hi], neg[lo:hi]
                pairs += float((own * (n + np.cumsum(other) - other / 2.0)).sum())
                held[k[lo]] = p + int(own.sum()), n + int(other.sum()), pairs
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(held), pa.int32()), pa.array(list(held), pa.int32()),
                                              *(pa.array([v[i] for v in held.values()], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64())))],
                                             names=["part", key, "pos", "neg", "pairs"])

    seg = merged.mapInArrow(run, f"part int, {key} int, pos long, neg long, pairs double")
    w = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    seg = seg.withColumn("below", F.coalesce(F.sum("neg").over(w), F.lit(0)))
    return seg.groupBy(key).agg((F.sum(F.col("pairs") + F.col("pos") * F.col("below")) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def roc_points(df: DataFrame, y: str, score: str, positive=1) -> DataFrame:
    """One ROC point per distinct threshold (all points, no thinning):
    ``(threshold, tp, fp, tpr, fpr)`` for the rule ``score >= threshold``."""
    sc = score_counts(df, y, score, positive)
    tot = sc.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    cum = prefix_sum(sc.withColumn("__desc", -F.col("score")), [], ["__desc"], ["pos", "neg"],
                     suffix="_cum", inclusive=True)
    return cum.select(
        F.col("score").alias("threshold"), F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"),
        (F.col("pos_cum") / F.lit(float(tot["P"] or 0))).alias("tpr"),
        (F.col("neg_cum") / F.lit(float(tot["N"] or 0))).alias("fpr"))


def pr_points(df: DataFrame, y: str, score: str, positive=1) -> DataFrame:
    """Precision and recall of ``score >= threshold`` per distinct threshold."""
    roc = roc_points(df, y, score, positive)
    return roc.select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.col("tpr").alias("recall"))


def log_loss(df: DataFrame, y: str, p1: str, positive=1, eps: float = LOG_LOSS_EPS) -> DataFrame:
    p = F.least(F.greatest(F.col(p1).cast("double"), F.lit(eps)), F.lit(1 - eps))
    pos = F.col(y) == F.lit(positive)
    return df.agg(F.avg(-F.when(pos, F.log(p)).otherwise(F.log(1 - p))).alias("log_loss"))


def regression_scores(df: DataFrame, y: str, pred: str) -> DataFrame:
    """R2, MSE, MAE and the min / max limits of actual and predicted, one pass."""
    yy, pp = F.col(y).cast("double"), F.col(pred).cast("double")
    r = yy - pp
    agg = df.agg(
        F.count(F.lit(1)).alias("n"), F.sum(r * r).alias("sse"), F.avg(F.abs(r)).alias("mae"),
        F.var_pop(yy).alias("var_y"), F.least(F.min(yy), F.min(pp)).alias("lower"),
        F.greatest(F.max(yy), F.max(pp)).alias("upper"))
    return agg.select(
        (1 - F.col("sse") / (F.col("var_y") * F.col("n"))).alias("r2"),
        (F.col("sse") / F.col("n")).alias("mse"), "mae", "lower", "upper")


def residuals(df: DataFrame, y: str, pred: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.col(y).alias("actual"), F.col(pred).alias("predicted"),
                     (F.col(y) - F.col(pred)).alias("residual"))


def positive_label(df: DataFrame, y: str):
    """Larger of two labels (None if the label is not binary) — computed by Spark."""
    r = df.agg(F.countDistinct(y).alias("k"), F.max(y).alias("m")).first()
    return r["m"] if r["k"] == 2 else None


def metric_suite(df: DataFrame, y: str, pred: str, p1: str | None = None,
                 task: str = "classification") -> DataFrame:
    """All metrics of the task type as one row."""
    if task == "classification":
        out = weighted_scores(df, y, pred)
        if p1 is not None:
            auc = roc_auc(df, y, p1).first()["roc_auc"]
            ll = log_loss(df, y, p1).first()["log_loss"]
            out = out.withColumn("roc_auc", F.lit(auc)).withColumn("log_loss", F.lit(ll))
        return out
    return regression_scores(df, y, pred).select("r2", "mse", "mae")
