"""Profile and clean a table: ``python -m riskmill.plans.profile_table INPUT OUTPUT``.

Text input is parsed once and kept as parquet, so that every result after it reads only the
columns it needs. Wide shuffles and the cleaned rows are written too; a lost executor costs
its own tasks, not the steps before.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from riskmill.operators import clean, correlation, dedup, profile, relevance
from riskmill.session import get_session
from riskmill.sources.tables import (
    read_table, require_columns, table_shape, write_csv_table, write_parquet_table, write_result,
)
from riskmill.spec import LOANS, TableSpec


def _stored(df: DataFrame, path: str) -> DataFrame:
    write_parquet_table(df, path)
    return read_table(df.sparkSession, path, "parquet")


def profile_table(
    spark: SparkSession, source: str, output: str, spec: TableSpec = LOANS, fmt: str = "csv",
    schema: str | None = None, multi_line: bool = False, csv_copy: bool = False,
    nulls: str = "pairwise", top: int = 25,
) -> DataFrame:
    """Write every profiling result under ``output`` and return the cleaned table.

    ``nulls`` is the correlation mode, ``csv_copy`` adds the cleaned table as CSV.
    """
    raw = read_table(spark, source, fmt, schema, multi_line)
    require_columns(raw, [spec.key, spec.entity, spec.label])
    if fmt != "parquet":
        raw = _stored(raw, f"{output}/data/raw")

    def save(name: str, df: DataFrame, small: bool = True) -> None:
        write_result(df, f"{output}/tables/{name}", small)

    save("table_shape", table_shape(raw))
    report = dedup.duplicate_report(raw, spec.key, spec.entity).persist()
    save("duplicate_check", report)
    unique = raw
    if report.first()["rows_removed"] > 0:
        unique = _stored(dedup.dedup_by_key(raw, spec.key), f"{output}/data/unique")
        repeated = dedup.duplicate_keys(raw, spec.key)
        write_parquet_table(repeated, f"{output}/data/duplicate_keys")
        save("duplicate_keys_sample", repeated.orderBy(spec.key).limit(5))
    report.unpersist()

    save("summary_statistics", profile.summary_stats(unique, spec.summary))
    all_nulls = profile.null_profile(unique).persist()
    save("null_counts_all", all_nulls)
    save("null_counts_top", all_nulls.orderBy(F.col("null_count").desc(), "column").limit(top))
    all_nulls.unpersist()
    save("class_balance", profile.class_balance(unique, spec.label, spec.label_names))

    labelled = clean.drop_null_target(unique, spec.label)
    sparse = clean.sparse_columns(labelled)
    cleaned = _stored(clean.clean_table(unique, spec, sparse), f"{output}/data/clean")
    if csv_copy:
        write_csv_table(cleaned, f"{output}/data/clean_csv")
    save("cleaning_summary", profile.cleaning_funnel([
        ("raw", raw), ("unique_key", unique), ("labelled", labelled), ("core_complete", cleaned),
    ]))

    for group in spec.ordered_rate_columns:
        if group in cleaned.columns:
            save(f"rate_by_{group}", profile.rate_by(cleaned, group, spec.label, order="key"), small=False)
    rates = profile.rates_for_columns(cleaned, spec.rate_columns, spec.label)
    rates = _stored(rates, f"{output}/data/category_rates")
    # As many rows as there are categories: written by all tasks.
    save("rates_by_category", rates.orderBy("column", F.col("rate").desc(), "category"), small=False)
    save("rates_by_category_top", profile.top_categories(rates).orderBy("column", "position"))

    numeric = clean.columns_by_type(cleaned, exclude=spec.non_predictors)
    save("constant_columns", profile.constant_columns(cleaned, numeric))
    correlations = correlation.correlation_with_target(cleaned, numeric, spec.label, nulls)
    save("correlation_with_target", correlations)
    save("correlation_matrix", correlation.correlation_matrix(cleaned, spec.matrix_columns))
    plotted = [c for c in spec.histogram_columns if c in cleaned.columns]
    save("histograms", profile.histogram_by_label(cleaned, plotted, spec.label).orderBy(
        "feature", "label", "bin"
    ))
    save("feature_relevance", relevance.feature_relevance(cleaned, spec).orderBy("kind", "position"))
    save("recommended_features", relevance.recommended_features(cleaned, spec))
    groups = [c for c in (*spec.ordered_rate_columns, *spec.rate_columns) if c in cleaned.columns]
    save("stage_summary", relevance.stage_summary(unique, cleaned, spec, groups, correlations))
    return cleaned


def main() -> None:
    """Command line."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("output")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--schema", help="column types as in 'id bigint, term string'")
    parser.add_argument("--multi-line", action="store_true")
    parser.add_argument("--csv-copy", action="store_true")
    parser.add_argument("--nulls", choices=["pairwise", "zero"], default="pairwise")
    args = parser.parse_args()
    profile_table(
        get_session("riskmill-profile"), args.source, args.output, fmt=args.format,
        schema=args.schema, multi_line=args.multi_line, csv_copy=args.csv_copy, nulls=args.nulls,
    )


if __name__ == "__main__":
    main()
