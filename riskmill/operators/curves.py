"""Exact ROC and precision-recall curves, their areas, and the threshold sweep.

Running counts over all scores are taken slice by slice. A slice is a function of the score:
its bounds are approximate quantiles of the rows, taken once in a pass that merges sketches.
Any bounds give the same counts; good ones make slices of like size. Each slice adds up its own
scores and starts from the totals of the slices before it. No task sees more than a slice,
however the scores crowd together, and tied scores are one row from the start. Nothing is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from riskmill.functions.columns import share
from riskmill.operators.metrics import f1_of

# The threshold grid, and the threshold when there is nothing to choose from.
SWEEP_LOW, SWEEP_HIGH, SWEEP_STEP = 0.05, 0.96, 0.01
FALLBACK_THRESHOLD = 0.5
#: Slices that running counts are taken in.
SLICES = 128


def slice_bounds(scores: DataFrame, slices: int = SLICES) -> list[float]:
    """At most `slices` - 1 numbers that part the rows of the column `score` about evenly."""
    shares = F.array(*(F.lit(i / slices) for i in range(1, slices)))
    found = scores.agg(F.percentile_approx("score", shares, 20 * slices)).first()[0] or []
    return sorted({x for x in found if np.isfinite(x)}) or [0.0]


def running_counts(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), slices: int = SLICES
) -> DataFrame:
    """Per distinct score, from the highest: pos, neg, running tp and fp, and class totals.

    Rows without a score or with a label other than 0 and 1 do not take part. With ``by`` every
    group has its own curve. One small action finds the bounds of the slices.
    """
    valid = df.filter(F.col(label).isin(0, 1) & F.col(score).isNotNull()).select(
        *by, F.col(label).alias("actual"), F.col(score).cast("double").alias("score")
    )
    tied = valid.groupBy(*by, "score").agg(
        F.count_if(F.col("actual") == 1).alias("pos"), F.count_if(F.col("actual") == 0).alias("neg"),
    )
    sliced = Bucketizer(
        splits=[float("-inf"), *slice_bounds(valid, slices), float("inf")], inputCol="score",
        outputCol="slice", handleInvalid="keep",
    ).transform(tied)  # NaN, the highest score of all, has the highest slice
    totals = sliced.groupBy(*by, "slice").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # At most `slices` + 1 rows in each of these groups.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy(F.col("slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "slice",
        F.coalesce(F.sum("pos").over(earlier), F.lit(0)).alias("pos_before"),
        F.coalesce(F.sum("neg").over(earlier), F.lit(0)).alias("neg_before"),
        F.sum("pos").over(group).alias("positives"),
        F.sum("neg").over(group).alias("negatives"),
    )
    within = Window.partitionBy(*by, "slice").orderBy(F.col("score").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return sliced.join(offsets if by else F.broadcast(offsets), [*by, "slice"]).select(
        *by, "score", "pos", "neg",
        (F.col("pos_before") + F.sum("pos").over(within)).alias("tp"),
        (F.col("neg_before") + F.sum("neg").over(within)).alias("fp"),
        "positives", "negatives",
    )


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Points (score, fpr, tpr), one per distinct score, after the start (NULL, 0, 0).

    With a class missing the curve is the diagonal (0, 0), (1, 1).
    """
    return roc_from(running_counts(df, label, score))


def roc_from(running: DataFrame) -> DataFrame:
    """``roc_points`` from running counts."""
    both = (F.col("positives") > 0) & (F.col("negatives") > 0)
    points = running.filter(both).select(
        "score",
        share(F.col("fp"), F.col("negatives")).alias("fpr"),
        share(F.col("tp"), F.col("positives")).alias("tpr"),
    )
    classes = running.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
    )
    corners = F.when(both, F.array(F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))
    ends = classes.select(F.explode(corners).alias("at")).select(
        F.lit(None).cast("double").alias("score"), F.col("at").alias("fpr"), F.col("at").alias("tpr")
    )
    return ends.unionByName(points)


def pr_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Points (score, precision, recall), one per distinct score, and the start (NULL, 1, 0).

    Recall is 1 throughout when there is no positive.
    """
    return pr_from(running_counts(df, label, score))


def pr_from(running: DataFrame) -> DataFrame:
    """``pr_points`` from running counts."""
    points = running.select(
        "score",
        share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(share(F.col("tp"), F.col("positives")), F.lit(1.0)).alias("recall"),
    )
    start = running.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("score"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return start.unionByName(points)


def curve_areas(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: auc_roc and auc_pr by trapezoids and the step-wise average precision.

    NULL where the curve is undefined because a class is missing.
    """
    return areas_from(running_counts(df, label, score))


def areas_from(running: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``curve_areas`` from running counts, one row per group."""
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    precision = tp / (tp + fp)
    precision_before = F.coalesce(F.try_divide(tp - pos, (tp - pos) + (fp - neg)), precision)
    totals = running.groupBy(*by).agg(
        F.sum(neg * (tp - pos / 2)).alias("under_roc"),
        F.sum(pos * (precision + precision_before) / 2).alias("under_pr"),
        F.sum(pos * precision).alias("steps"),
        F.max("positives").alias("p"),
        F.max("negatives").alias("n"),
    )
    return totals.select(
        *by, share(F.col("under_roc"), F.col("p").cast("double") * F.col("n")).alias("auc_roc"),
        share(F.col("under_pr"), F.col("p")).alias("auc_pr"),
        share(F.col("steps"), F.col("p")).alias("average_precision"),
    )


def auc_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: area under the ROC curve."""
    return curve_areas(df, label, score).select("auc_roc")


def auc_pr(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: area under the precision-recall curve by trapezoids."""
    return curve_areas(df, label, score).select("auc_pr")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row: precision averaged over the steps in recall."""
    return curve_areas(df, label, score).select("average_precision")


def threshold_grid(
    low: float = SWEEP_LOW, high: float = SWEEP_HIGH, step: float = SWEEP_STEP
) -> list[float]:
    """Thresholds from low to below high."""
    if not 0.0 < step <= 1.0:
        raise ValueError("step must be in (0, 1]")
    return np.arange(low, high, step).tolist()


def threshold_sweep(
    df: DataFrame, label: str, score: str, low: float = SWEEP_LOW, high: float = SWEEP_HIGH,
    step: float = SWEEP_STEP, thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Counts, precision, recall and F1 when scores at or above each threshold are positive.

    Each row is placed once between two thresholds; the rest works on one row per gap.
    """
    grid = sorted(set(thresholds)) if thresholds is not None else threshold_grid(low, high, step)
    if not grid:
        return df.sparkSession.sql(
            "SELECT 0D AS threshold, 0L AS tp, 0L AS fp, 0L AS fn, 0D AS precision,"
            " 0D AS recall, 0D AS f1 WHERE false"
        )
    # NaN reaches every threshold, as it does in a comparison; NULL reaches none.
    value = F.nanvl(F.col(score).cast("double"), F.lit(float("inf")))
    values = df.filter(F.col(label).isin(0, 1)).select(
        (F.col(label) == 1).alias("positive"), F.coalesce(value, F.lit(float("-inf"))).alias("score")
    )
    # The gap number is how many thresholds the score reaches.
    gaps = (
        Bucketizer(
            splits=[float("-inf"), *grid, float("inf")], inputCol="score", outputCol="gap",
            handleInvalid="keep",
        )
        .transform(values)
        .groupBy(F.coalesce(F.col("gap").cast("int"), F.lit(0)).alias("gap"))
        .agg(
            F.count_if(F.col("positive")).alias("pos"), F.count_if(~F.col("positive")).alias("neg")
        )
    )
    steps = df.sparkSession.range(1).select(
        F.posexplode(F.lit([float("-inf"), *grid])).alias("gap", "threshold")
    )
    # At most one row per gap on both sides: small enough to broadcast and for one task.
    reached = Window.orderBy(F.col("gap").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    everything = reached.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = steps.join(F.broadcast(gaps), "gap", "left").select(
        "gap", "threshold",
        F.sum(F.coalesce("pos", F.lit(0))).over(reached).alias("tp"),
        F.sum(F.coalesce("neg", F.lit(0))).over(reached).alias("fp"),
        F.sum(F.coalesce("pos", F.lit(0))).over(everything).alias("positives"),
    )
    tp, fp = F.col("tp"), F.col("fp")
    rated = counts.filter(F.col("gap") > 0).select(
        "threshold", "tp", "fp", (F.col("positives") - tp).alias("fn"),
        F.coalesce(share(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(share(tp, F.col("positives")), F.lit(0.0)).alias("recall"),
    )
    return rated.withColumn("f1", f1_of(F.col("precision"), F.col("recall")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """One row (threshold, f1): the highest F1, the lowest threshold among equals.

    The fallback threshold with F1 -1 if the sweep is empty.
    """
    fallback = sweep.sparkSession.range(1).select(
        F.lit(FALLBACK_THRESHOLD).alias("threshold"), F.lit(-1.0).alias("f1")
    )
    return (
        sweep.select("threshold", "f1")
        .unionByName(fallback)
        .orderBy(F.col("f1").desc(), "threshold")
        .limit(1)
    )
