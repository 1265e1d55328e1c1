"""Evaluation against brute force over the same rows."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from riskmill.operators import curves, metrics, ordering, profile, report
from riskmill.spec import LOANS


def frame(spark, labels, scores):
    rows = [(int(y), float(s)) for y, s in zip(labels, scores)]
    return spark.createDataFrame(rows, "y int, s double")


def brute(labels, scores):
    """Counts at and above every distinct score, from the highest."""
    y, s = np.asarray(labels), np.asarray(scores)
    cuts = sorted(set(scores), reverse=True)
    tp = np.array([int(((s >= c) & (y == 1)).sum()) for c in cuts])
    fp = np.array([int(((s >= c) & (y == 0)).sum()) for c in cuts])
    return cuts, tp, fp


def trapezoid(x, y):
    return float(sum((x[i] - x[i - 1]) * (y[i] + y[i - 1]) / 2 for i in range(1, len(x))))


@pytest.fixture(scope="module")
def tied():
    rng = np.random.default_rng(7)
    scores = np.round(rng.random(400) ** 2, 2)
    labels = (rng.random(400) < 0.1 + 0.4 * scores).astype(int)
    return labels.tolist(), scores.tolist()


def test_curves_and_areas(spark, tied):
    labels, scores = tied
    df = frame(spark, labels, scores)
    cuts, tp, fp = brute(labels, scores)
    p, n = tp[-1], fp[-1]
    roc = sorted((tuple(r) for r in curves.roc_points(df, "y", "s").collect()),
                 key=lambda r: (-2 if r[0] is None else -r[0]))
    assert roc == [(None, 0.0, 0.0)] + [(c, f / n, t / p) for c, t, f in zip(cuts, tp, fp)]
    pr = sorted((tuple(r) for r in curves.pr_points(df, "y", "s").collect()),
                key=lambda r: (-2 if r[0] is None else -r[0]))
    assert pr == [(None, 1.0, 0.0)] + [(c, t / (t + f), t / p) for c, t, f in zip(cuts, tp, fp)]

    recall, precision = tp / p, tp / (tp + fp)
    areas = curves.curve_areas(df, "y", "s").first()
    assert areas["auc_roc"] == pytest.approx(trapezoid([0, *(fp / n)], [0, *recall]), abs=1e-12)
    assert areas["auc_pr"] == pytest.approx(
        trapezoid([0, *recall], [precision[0], *precision]), abs=1e-12)
    steps = np.diff([0, *recall])
    assert areas["average_precision"] == pytest.approx(float((steps * precision).sum()), abs=1e-12)


@pytest.mark.parametrize("metric, column", [("areaUnderROC", "auc_roc"), ("areaUnderPR", "auc_pr")])
def test_areas_equal_the_evaluator(spark, tied, metric, column):
    df = frame(spark, *tied)
    evaluator = BinaryClassificationEvaluator(
        labelCol="y", rawPredictionCol="s", metricName=metric, numBins=0
    )
    assert curves.curve_areas(df, "y", "s").first()[column] == pytest.approx(
        evaluator.evaluate(df), abs=1e-12)


def test_many_slices_equal_one(spark):
    """Scores crowded into a narrow band, a third of the rows tied, over many partitions."""
    rng = np.random.default_rng(11)
    scores = np.where(rng.random(6000) < 0.33, 0.05, 0.05 + rng.random(6000) * 1e-6)
    labels = (rng.random(6000) < 0.2).astype(int)
    df = frame(spark, labels, scores).repartition(5)
    cuts, tp, fp = brute(labels.tolist(), scores.tolist())
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        running = curves.running_counts(df, "y", "s")
        found = sorted(((r["score"], r["tp"], r["fp"]) for r in running.collect()), reverse=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert found == list(zip(cuts, tp.tolist(), fp.tolist()))


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_only(spark, label):
    df = frame(spark, [label] * 3, [0.1, 0.5, 0.9])
    assert sorted(r[1:] for r in curves.roc_points(df, "y", "s").collect()) == [(0.0, 0.0), (1.0, 1.0)]
    assert curves.auc_roc(df, "y", "s").first()[0] is None
    assert {r["recall"] for r in curves.pr_points(df, "y", "s").filter("score = 0.1").collect()} == {1.0}


def test_no_rows(spark):
    df = frame(spark, [1], [0.5]).filter("false")
    assert curves.curve_areas(df, "y", "s").first()[:] == (None, None, None)
    assert curves.roc_points(df, "y", "s").count() == 2
    assert {r["f1"] for r in curves.threshold_sweep(df, "y", "s").collect()} == {0.0}
    empty = curves.threshold_sweep(df, "y", "s", thresholds=[])
    assert curves.best_threshold(empty).first()[:] == (0.5, -1.0)


def test_sweep(spark, tied):
    labels, scores = map(np.asarray, tied)
    sweep = curves.threshold_sweep(frame(spark, *tied), "y", "s")
    found = {r["threshold"]: r for r in sweep.collect()}
    best = (0.5, -1.0)
    assert sorted(found) == np.arange(0.05, 0.96, 0.01).tolist()
    for t in sorted(found):
        tp = int(((scores >= t) & (labels == 1)).sum())
        fp = int(((scores >= t) & (labels == 0)).sum())
        fn = int(((scores < t) & (labels == 1)).sum())
        precision = tp / (tp + fp) if tp + fp else 0.0
        recall = tp / (tp + fn) if tp + fn else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        assert (found[t]["tp"], found[t]["fp"], found[t]["fn"]) == (tp, fp, fn)
        assert found[t]["f1"] == pytest.approx(f1, abs=1e-15)
        if f1 > best[1]:
            best = (t, f1)
    assert curves.best_threshold(sweep).first()["threshold"] == best[0]
    with pytest.raises(ValueError):
        curves.threshold_grid(step=0.0)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.floats(0.01, 0.99)), min_size=2, max_size=40))
def test_area_ignores_monotone_change(spark, pairs):
    labels, scores = zip(*pairs)
    # Halving is exact, so it keeps every order and every tie.
    plain = curves.auc_roc(frame(spark, labels, scores), "y", "s").first()[0]
    halved = curves.auc_roc(frame(spark, labels, [s / 2 for s in scores]), "y", "s").first()[0]
    assert plain == halved


def test_counts_and_metrics(spark, tied):
    df = metrics.apply_threshold(frame(spark, *tied), "s", 0.3, "p")
    counts = metrics.confusion_counts(df, "y", "p")
    assert sum(counts.first()) == df.count()
    row = metrics.overall_metrics(metrics.class_metrics(counts)).first()
    typed = df.select(F.col("y").cast("double").alias("y"), "p")
    for name, column in (("accuracy", "accuracy"), ("weightedPrecision", "precision_weighted"),
                         ("weightedRecall", "recall_weighted")):
        evaluator = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert row[column] == pytest.approx(evaluator.evaluate(typed), abs=1e-12)
    nothing = metrics.overall_metrics(metrics.class_metrics(
        metrics.confusion_counts(df.filter("false"), "y", "p"))).first().asDict()
    assert set(nothing.values()) == {0, 0.0}


def test_reports(spark, tied):
    df = frame(spark, *tied)
    best = curves.best_threshold(curves.threshold_sweep(df, "y", "s"))
    plain, tuned = [], []
    for name, column in (("good", "s"), ("bad", "r")):
        scored = df.withColumn("r", 1 - F.col("s"))
        half = metrics.apply_threshold(scored, column, 0.5, "p")
        plain.append(report.evaluate(half, "y", column, "p", name, train_rows=7))
        cut = metrics.apply_threshold(scored, column, best, "p")
        tuned.append(report.evaluate(
            cut, "y", column, "p", name, best, profile.row_count(df), validation_f1=best
        ))
    plain, tuned = (ordering.union_by_name(*rows) for rows in (plain, tuned))
    assert report.select_best(tuned, "auc_roc").first()["model"] == "good"
    rows = {r["model"]: r for r in tuned.collect()}
    assert rows["good"]["train_rows"] == rows["good"]["test_rows"] == 400
    assert rows["good"]["f1"] == pytest.approx(rows["good"]["validation_f1"])
    assert report.threshold_table(tuned).columns == ["model", "threshold", "validation_f1", "test_f1"]
    assert report.confusion_table(plain).columns == ["model", "tp", "tn", "fp", "fn"]
    assert report.compare_models(plain, tuned).count() == 4
    balance = df.select(F.lit("test").alias("split"), F.lit(1).alias("n_rows"), F.lit(0.5).alias("rate"))
    summary = report.model_summary(plain, tuned, balance.limit(1), LOANS, [
        ("f1", report.select_best(tuned), "f1")])
    found = {(r["metric"], r["name"]) for r in summary.collect()}
    assert {("rows", "test"), ("auc_roc_plain", "good"), ("best_by_f1", "good")} <= found
