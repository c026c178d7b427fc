"""Classification metrics as aggregates over (label, prediction) rows.

Per-class tp / fp / fn come from one grouped aggregate over the distinct
(label, prediction) pairs (at most k^2 rows), so every report below is a
small table computed from a single pass over the predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

R = 4


def pair_counts(preds: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return preds.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class(preds: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """class, support, tp, fp, fn, precision, recall, f1 (0 when undefined).

    One pass: each (label, prediction, n) pair row contributes to its actual
    class and its predicted class, then one small grouped sum."""
    pc = pair_counts(preds, label, pred)
    zero = F.lit(0).cast("long")
    eq = F.col("label") == F.col("prediction")
    parts = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"),
                 F.when(eq, F.col("n")).otherwise(zero).alias("tp"), zero.alias("n_pred")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("support"), zero.alias("tp"),
                 F.col("n").alias("n_pred")),
    )
    j = pc.select(F.inline(parts)).groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("tp").alias("tp"), F.sum("n_pred").alias("n_pred"))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return j.select(F.col("cls").alias("class"), "support", "tp",
                    (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("support") - F.col("tp")).alias("fn"),
                    prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def confusion_matrix(preds: DataFrame, labels: list[str], label: str = "label",
                     pred: str = "prediction") -> DataFrame:
    """Actual x predicted, fixed label order, zeros kept."""
    counts = preds.groupBy(F.col(label).alias("label")).pivot(pred, labels).agg(F.count(F.lit(1)))
    fixed = preds.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    return fixed.join(counts, "label", "left").na.fill(0)


def summary(preds: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """accuracy, macro_f1, weighted_f1 in one row."""
    pcs = per_class(preds, label, pred)
    return pcs.agg(
        F.round(F.sum("tp") / F.sum("support"), R).alias("accuracy"),
        F.round(F.avg("f1"), R).alias("macro_f1"),
        F.round(F.sum(F.col("f1") * F.col("support")) / F.sum("support"), R).alias("weighted_f1"),
    )


def classification_report(preds: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision / recall / f1 / support, plus macro and weighted rows."""
    # one pass: a class counts for its own row and for both averages
    per = per_class(preds, label, pred)
    row = lambda kind, name, weight: F.struct(F.lit(kind).alias("kind"), name.alias("class"), weight.cast("double").alias("w"))
    spread = per.select("precision", "recall", "f1", "support", F.explode(F.array(
        row(0, F.col("class"), F.lit(1)), row(1, F.lit("macro avg"), F.lit(1)),
        row(2, F.lit("weighted avg"), F.col("support")))).alias("r"))
    mean = lambda c: F.round(F.try_divide(F.sum(F.col(c) * F.col("r.w")), F.sum("r.w")), R).alias(c)
    return (spread.groupBy("r.kind", "r.class").agg(mean("precision"), mean("recall"), mean("f1"), F.sum("support").alias("support"))
            .drop("kind"))


def fold_mean_std(scores: DataFrame, metric: str, group: str = "model") -> DataFrame:
    """Mean and population std of a metric over folds."""
    return scores.groupBy(group).agg(
        F.round(F.avg(metric), R).alias("mean"), F.round(F.stddev_pop(metric), R).alias("std"),
        F.count(F.lit(1)).alias("n_folds"))
