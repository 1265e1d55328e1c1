"""Scores, thresholds and confusion counts. Counts come from one aggregate each."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from riskmill.functions.columns import share


def with_score(predictions: DataFrame, probability: str = "probability", target: str = "score") -> DataFrame:
    """Add the probability of class 1 as a plain number."""
    return predictions.withColumn(target, vector_to_array(F.col(probability))[1])


def apply_threshold(
    df: DataFrame, score: str, threshold: float | DataFrame, target: str = "prediction_tuned"
) -> DataFrame:
    """Add 1.0 where the score reaches the threshold, else 0.0.

    The threshold may be the one-row result of ``best_threshold``; it stays on the cluster.
    """
    cut = threshold.select("threshold").scalar() if isinstance(threshold, DataFrame) else F.lit(threshold)
    return df.withColumn(target, F.when(F.col(score) >= cut, 1.0).otherwise(0.0))


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: tp, tn, fp, fn."""
    actual, predicted = F.col(label), F.col(prediction)

    def cell(a, p):
        return F.count_if((actual == a) & (predicted == p))

    return df.agg(
        cell(1, 1).alias("tp"), cell(0, 0).alias("tn"),
        cell(0, 1).alias("fp"), cell(1, 0).alias("fn"),
    )


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(share(part, whole), F.lit(0.0))


def f1_of(precision: Column, recall: Column) -> Column:
    """Harmonic mean, 0 when both are 0."""
    return F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))


def class_metrics(counts: DataFrame) -> DataFrame:
    """Add precision, recall and F1 of the positive class; 0 where nothing can be divided."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    rated = counts.withColumns({
        "precision": _or_zero(tp, tp + fp), "recall": _or_zero(tp, tp + fn),
    })
    return rated.withColumn("f1", f1_of(F.col("precision"), F.col("recall")))


def overall_metrics(counts: DataFrame) -> DataFrame:
    """Add accuracy and the precision and recall of both classes weighted by class size."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    rows, positives, negatives = tp + tn + fp + fn, tp + fn, tn + fp
    precision = _or_zero(positives, rows) * _or_zero(tp, tp + fp) + _or_zero(
        negatives, rows
    ) * _or_zero(tn, tn + fn)
    recall = _or_zero(positives, rows) * _or_zero(tp, positives) + _or_zero(
        negatives, rows
    ) * _or_zero(tn, negatives)
    return counts.withColumns({
        "accuracy": _or_zero(tp + tn, rows),
        "precision_weighted": precision,
        "recall_weighted": recall,
    })
