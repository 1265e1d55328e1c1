"""Train and compare classifiers: ``python -m riskmill.plans.train_models CLEAN OUTPUT``.

Model rows, predictions and evaluations are written and read back, so that nothing upstream
runs twice. Choices are made on the validation part and reported on the test part.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmill.operators import clean, curves, encode, metrics, models, profile, report, split
from riskmill.operators.ordering import union_by_name
from riskmill.session import get_session
from riskmill.sources.tables import (
    read_table, require_columns, write_parquet_table, write_prediction_sample, write_result,
)
from riskmill.spec import LOANS, TableSpec


def _stored(df: DataFrame, path: str) -> DataFrame:
    write_parquet_table(df, path)
    return read_table(df.sparkSession, path, "parquet")


def _model_rows(
    df: DataFrame, spec: TableSpec, output: str, fraction: float
) -> DataFrame:
    """Prepared rows, one folder per split. ``fraction`` samples the training rows alone."""
    require_columns(df, [spec.key, *spec.raw_columns])
    rows = clean.prepare_features(df, spec, keep=[spec.key])
    parts = split.stratified_split(rows, spec.label, spec.key)
    if fraction < 1.0:
        train = clean.sample_rows(parts.filter("split = 'train'"), fraction, by_key=[spec.key])
        parts = parts.filter("split <> 'train'").unionByName(train)
    path = f"{output}/data/model_rows"
    parts.write.mode("overwrite").partitionBy("split").parquet(path)
    return read_table(df.sparkSession, path, "parquet")


def train_models(
    spark: SparkSession, source: str, output: str, spec: TableSpec = LOANS, fmt: str = "parquet",
    fraction: float = 1.0, search: bool = False, preset: str = "full", metric: str = "areaUnderPR",
    undersample: float | None = None, step: float = curves.SWEEP_STEP,
    kinds: Sequence[str] = tuple(models.CLASSIFIERS),
    params: Mapping[str, Mapping] | None = None,
    searches: Mapping[str, models.Search] | None = None,
) -> DataFrame:
    """Write models, predictions and comparison tables; returns the tuned test evaluations.

    ``search`` cross-validates over the preset grids, ``searches`` over given ones.
    """
    table = read_table(spark, source, fmt)
    rows = _model_rows(table, spec, output, fraction)
    train, val, test = (rows.filter(F.col("split") == p).drop("split") for p in split.PARTS)
    if undersample is not None:
        train = split.undersample(train, spec.label, spec.key, undersample)
    train = split.add_class_weights(train, spec.label)
    preparations = {
        scaled: encode.feature_pipeline(spec, scaled).fit(train)
        for scaled in {kind == "logistic" for kind in kinds}
    }
    balance = split.split_balance(rows, spec.label)
    train_rows = profile.row_count(train)
    sweep_of, plain, tuned, chosen = {}, [], [], []

    def save(name: str, df: DataFrame) -> None:
        write_result(df, f"{output}/tables/{name}")

    for kind in kinds:
        grid = models.search_preset(kind, preset, metric=metric, fold_key=[spec.key])
        model, results = models.train_classifier(
            train, spec, kind, preparation=preparations[kind == "logistic"],
            search=(searches or {}).get(kind, grid if search else None),
            **(params or {}).get(kind, {}),
        )
        model.write().overwrite().save(f"{output}/models/{kind}")
        if results is not None:
            save(f"search_{kind}", results)
        if kind != "logistic":
            save(f"feature_importance_all_{kind}", models.feature_importance(model, train, spec, k=None))
            save(f"feature_importance_{kind}", models.feature_importance(model, train, spec))
        keep = [spec.key, spec.label]
        val_scores, test_scores = (
            _stored(models.score(model, part, keep), f"{output}/data/{name}_{kind}")
            for name, part in (("val", val), ("test", test))
        )
        sweep = curves.threshold_sweep(val_scores, spec.label, "score", step=step)
        sweep_of[kind] = _stored(sweep, f"{output}/data/sweep_{kind}")
        best = curves.best_threshold(sweep_of[kind])
        running = _stored(
            curves.running_counts(test_scores, spec.label, "score"), f"{output}/data/curve_{kind}"
        )
        areas = curves.areas_from(running)
        tuned_scores = metrics.apply_threshold(test_scores, "score", best)
        tuned_val = metrics.apply_threshold(val_scores, "score", best)
        common = {"model": kind, "train_rows": train_rows}
        plain.append(report.evaluate(
            test_scores, spec.label, "score", "prediction", areas=areas, **common
        ))
        tuned.append(report.evaluate(
            tuned_scores, spec.label, "score", "prediction_tuned", areas=areas,
            threshold=best, validation_f1=best, **common,
        ))
        chosen.append(report.evaluate(
            tuned_val, spec.label, "score", "prediction_tuned", threshold=best, **common
        ))
        write_parquet_table(curves.roc_from(running), f"{output}/data/roc_{kind}")
        write_parquet_table(curves.pr_from(running), f"{output}/data/pr_{kind}")

    plain, tuned, chosen = (
        _stored(union_by_name(*evaluations), f"{output}/data/{name}")
        for name, evaluations in (("plain", plain), ("tuned", tuned), ("validation", chosen))
    )
    save("model_metrics", plain.drop("validation_f1"))
    save("model_metrics_tuned", tuned)
    save("model_metrics_validation", chosen.drop("validation_f1"))
    save("threshold_tuning", report.threshold_table(tuned))
    save("confusion_matrices", report.confusion_table(plain))
    save("confusion_matrices_tuned", report.confusion_table(tuned, tuned=True))
    save("model_comparison", report.compare_models(plain, tuned))
    save("split_balance", balance)
    best_f1, best_auc = (report.select_best(chosen, m) for m in ("f1", "auc_roc"))
    save("model_summary", report.model_summary(
        plain, tuned, balance, spec,
        best=[("f1", best_f1, "f1"), ("auc_roc", best_auc, "auc_roc")],
    ))
    winner = best_f1.first()["model"]
    predictions = metrics.apply_threshold(
        read_table(spark, f"{output}/data/test_{winner}", "parquet"), "score",
        curves.best_threshold(sweep_of[winner]),
    )
    write_prediction_sample(
        predictions, f"{output}/tables/predictions_sample",
        [spec.label, "prediction_tuned", "score"], order_by=[spec.key],
    )
    return tuned


def main() -> None:
    """Command line."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--fraction", type=float, default=1.0)
    parser.add_argument("--preset", choices=sorted(models.PRESETS), default="full")
    parser.add_argument("--search", action="store_true")
    parser.add_argument("--metric", choices=models.SEARCH_METRICS, default="areaUnderPR")
    parser.add_argument("--undersample", type=float)
    parser.add_argument("--threshold-step", type=float, default=curves.SWEEP_STEP)
    parser.add_argument("--kinds", nargs="+", choices=list(models.CLASSIFIERS),
                        default=list(models.CLASSIFIERS))
    args = parser.parse_args()
    train_models(
        get_session("riskmill-train"), args.source, args.output, fmt=args.format,
        fraction=args.fraction, search=args.search, preset=args.preset, metric=args.metric,
        undersample=args.undersample, step=args.threshold_step, kinds=args.kinds,
    )


if __name__ == "__main__":
    main()
