"""Model comparison: one row per model, built from confusion counts and curve areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskmill.operators.curves import curve_areas
from riskmill.operators.metrics import class_metrics, confusion_counts, overall_metrics
from riskmill.operators.ordering import argmax_row, union_by_name
from riskmill.spec import TableSpec

METRICS = (
    "accuracy", "precision_weighted", "recall_weighted", "auc_roc", "auc_pr",
    "precision", "recall", "f1",
)


def _number(value: int | DataFrame) -> Column:
    """A count given as a number or as a one-row DataFrame."""
    return value.scalar() if isinstance(value, DataFrame) else F.lit(value).cast("bigint")


def evaluate(
    df: DataFrame, label: str, score: str, prediction: str, model: str,
    threshold: float | DataFrame = 0.5, train_rows: int | DataFrame = 0,
    validation_f1: float | DataFrame | None = None, areas: DataFrame | None = None,
) -> DataFrame:
    """One row for a model: counts, class and overall metrics, curve areas, sizes.

    Stored predictions are read once for the counts and once for the areas. Areas do not
    depend on the threshold, so pass them in when a model is rated at two thresholds.
    """
    cut = (
        threshold.select("threshold").scalar() if isinstance(threshold, DataFrame)
        else F.lit(float(threshold))
    )
    chosen_f1 = (
        validation_f1.select("f1").scalar() if isinstance(validation_f1, DataFrame)
        else F.lit(validation_f1).cast("double")
    )
    counts = overall_metrics(class_metrics(confusion_counts(df, label, prediction)))
    area = (areas if areas is not None else curve_areas(df, label, score)).select(
        F.struct("auc_roc", "auc_pr").alias("area")
    ).scalar()
    return counts.select(
        F.lit(model).alias("model"), F.lit(prediction).alias("prediction_column"),
        cut.alias("threshold"), "accuracy", "precision_weighted", "recall_weighted",
        area["auc_roc"].alias("auc_roc"), area["auc_pr"].alias("auc_pr"),
        _number(train_rows).alias("train_rows"),
        (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("test_rows"),
        "tp", "tn", "fp", "fn", "precision", "recall", "f1",
        chosen_f1.alias("validation_f1"),
    )


def threshold_table(tuned: DataFrame) -> DataFrame:
    """Model, chosen threshold, and F1 where it was chosen and where it is reported."""
    return tuned.select("model", "threshold", "validation_f1", F.col("f1").alias("test_f1"))


def confusion_table(evaluations: DataFrame, tuned: bool = False) -> DataFrame:
    """Confusion counts per model, with the threshold for tuned predictions."""
    return evaluations.select("model", *(["threshold"] if tuned else []), "tp", "tn", "fp", "fn")


def compare_models(plain: DataFrame, tuned: DataFrame, digits: int = 4) -> DataFrame:
    """Metrics at the plain and at the tuned threshold, two rows per model."""
    def side(df, name):
        return df.select(
            "model", F.lit(name).alias("cut"), F.round("threshold", digits).alias("threshold"),
            *[F.round(c, digits).alias(c) for c in METRICS],
        )

    return side(plain, "plain").unionByName(side(tuned, "tuned")).orderBy("model", "cut")


def select_best(evaluations: DataFrame, metric: str = "f1") -> DataFrame:
    """The row of the best model; give validation rows so that test rows stay a fair report."""
    return argmax_row(evaluations, metric, ties=["model"])


def model_summary(
    plain: DataFrame, tuned: DataFrame, balance: DataFrame, spec: TableSpec,
    best: Sequence[tuple[str, DataFrame, str]] = (), split: str = "split",
) -> DataFrame:
    """Key results as rows (metric, name, value): sizes, rates, features, metrics, best models.

    ``best`` lists (metric, one-row winner, column), as from ``select_best``.
    """
    def finding(df, metric, name, value):
        return df.select(
            F.lit(metric).alias("metric"), name.cast("string").alias("name"),
            F.round(value.cast("double"), 6).alias("value"),
        )

    parts = [
        finding(balance, "rows", F.col(split), F.col("n_rows")),
        finding(balance, "positive_share", F.col(split), F.col("rate")),
    ]
    one = plain.sparkSession.range(1)
    parts.append(finding(one, "features", F.lit(", ".join(spec.features)), F.lit(len(spec.features))))
    parts.append(
        finding(one, "engineered", F.lit(", ".join(spec.engineered)), F.lit(len(spec.engineered)))
    )
    metrics = ["auc_roc", "auc_pr", "precision", "recall", "f1", "threshold"]
    for cut, df in (("plain", plain), ("tuned", tuned)):
        long = df.unpivot("model", metrics, "metric", "value")
        parts.append(long.select(
            F.concat("metric", F.lit(f"_{cut}")).alias("metric"), F.col("model").alias("name"),
            F.round("value", 6).alias("value"),
        ))
    for metric, winner, column in best:
        parts.append(finding(winner, f"best_by_{metric}", F.col("model"), F.col(column)))
    return union_by_name(*parts)
