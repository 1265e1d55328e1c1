"""Counts, summaries, null shares and label rates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskmill.functions.columns import comparable, is_missing, named_label, share
from riskmill.operators.reshape import long_form


def _rows(structs: Sequence[Column]) -> Column:
    """Turn a one-row aggregate into one row per struct."""
    return F.inline(F.array(*structs))


def row_count(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count("*").alias("n_rows"))


def distinct_count(df: DataFrame, names: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column, NULL not counted.

    Exact counts shuffle the distinct (column, value) pairs of all columns at once, after a
    map-side combine; ``approx`` shuffles one sketch per task and column.
    """
    if approx:
        totals = df.agg(*[F.approx_count_distinct(c).alias(c) for c in names])
        return totals.select(_rows([
            F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in names
        ]))
    types = {f.name: f.dataType for f in df.schema.fields}
    values = long_form(
        df, {c: comparable(F.col(c), types[c]) for c in names}, ["whole", "real", "text"], "column"
    )
    present = F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("text").isNotNull()
    return (
        values.groupBy("column", "whole", "real", "text").agg(F.count("*").alias("n"))
        .groupBy("column")
        .agg(F.count_if(present).alias("n_distinct"))
    )


def summary_stats(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column.

    Values are read leniently, so text that is no number counts as NULL. One aggregate.
    """
    present = [c for c in names if c in df.columns]
    values = df.select(*[F.col(c).try_cast("double").alias(c) for c in present])
    stats = values.agg(*[
        F.struct(
            F.lit(c).alias("feature"), F.count(c).alias("n"), F.mean(c).alias("mean"),
            F.stddev(c).alias("stddev"), F.min(c).alias("min"), F.max(c).alias("max"),
        ).alias(c)
        for c in present
    ])
    return stats.select(_rows([F.col(c) for c in present]))


def null_shares(df: DataFrame) -> DataFrame:
    """One row: the missing share of every column under the column's own name."""
    return df.agg(*[
        share(F.count_if(is_missing(F.col(f.name), f.dataType)), F.count("*")).alias(f.name)
        for f in df.schema.fields
    ])


def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and share per column, most missing first. One aggregate for all columns."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(is_missing(F.col(f.name), f.dataType)).alias(f.name) for f in df.schema.fields],
    )
    return counts.select(_rows([
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("null_count"),
            share(F.col(c), F.col("_rows")).alias("null_share"),
        )
        for c in df.columns
    ])).orderBy(F.col("null_count").desc(), "column")


def top_nulls(df: DataFrame, k: int = 25) -> DataFrame:
    """The k columns with most missing values."""
    return null_profile(df).orderBy(F.col("null_count").desc(), "column").limit(k)


def class_balance(df: DataFrame, label: str, names: Mapping[int, str] | None = None) -> DataFrame:
    """Rows and share per class, over the rows with a label.

    The total is a scalar subquery over the same aggregate, so the table is read once.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        label,
        named_label(F.col(label), names or {}).alias("class_name"),
        "n",
        share(F.col("n"), total).alias("share"),
    ).orderBy(label)


def rate_by(
    df: DataFrame, group: str, label: str, positive: int = 1, order: str = "rate"
) -> DataFrame:
    """Rows and positive share per category; NULL is a category, NULL labels count as rows.

    ``order`` is ``'rate'`` (highest first) or ``'key'``.
    """
    rates = df.groupBy(group).agg(*_rate(F.col(label) == positive))
    return rates.orderBy(F.col("rate").desc(), group) if order == "rate" else rates.orderBy(group)


def _rate(is_positive: Column) -> list[Column]:
    return [
        F.count("*").alias("n"),
        share(F.count_if(is_positive), F.count("*")).alias("rate"),
    ]


def rates_for_columns(
    df: DataFrame, names: Sequence[str], label: str, positive: int = 1
) -> DataFrame:
    """``rate_by`` for several columns in one scan; absent columns are skipped."""
    present = [c for c in names if c in df.columns]
    flagged = df.select(
        (F.col(label) == positive).alias("_positive"),
        *[F.col(c).cast("string").alias(c) for c in present],
    )
    long = flagged.unpivot("_positive", present, "column", "category")
    return long.groupBy("column", "category").agg(*_rate(F.col("_positive")))


def top_categories(rates: DataFrame, k: int = 10) -> DataFrame:
    """The k highest rates of each column of ``rates_for_columns``."""
    best_first = Window.partitionBy("column").orderBy(F.col("rate").desc(), "category")
    return rates.withColumn("position", F.row_number().over(best_first)).filter(
        F.col("position") <= k
    )


def rate_ranking(rates: DataFrame, category: str) -> DataFrame:
    """Categories from the lowest to the highest rate."""
    return rates.orderBy("rate", category)


def constant_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns that do not vary: deviation 0, or NULL with fewer than two values."""
    deviations = df.agg(*[F.stddev(F.col(c).cast("double")).alias(c) for c in names])
    return deviations.select(_rows([
        F.struct(F.lit(c).alias("column"), F.col(c).alias("stddev")) for c in names
    ])).filter(F.col("stddev").isNull() | (F.col("stddev") == 0))


def histogram_by_label(
    df: DataFrame, names: str | Sequence[str], label: str, bins: int = 40, per_class: bool = False
) -> DataFrame:
    """Counts per column, class and equal-width bin, over all rows with label 0 or 1.

    The classes share a column's range unless ``per_class``. Empty bins have no row. NaN and
    infinite values have no bin and are left out like NULL. The ranges come from a scalar
    subquery with one entry per column and class.
    """
    columns = [names] if isinstance(names, str) else list(names)
    labelled = df.filter(F.col(label).isin(0, 1)).select(
        F.col(label).cast("int").alias("label"),
        *[F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")).alias(c) for c in columns],
    )
    in_class = F.col("label") == 1
    classes = [("0", ~in_class), ("1", in_class)] if per_class else [("", None)]

    def bound(pick, c, condition):
        return pick(F.col(c) if condition is None else F.when(condition, F.col(c)))

    ranges = labelled.agg(F.create_map(*[
        item
        for c in columns
        for suffix, condition in classes
        for item in (
            F.lit(c + suffix),
            F.struct(bound(F.min, c, condition).alias("low"), bound(F.max, c, condition).alias("high")),
        )
    ])).scalar()
    long = labelled.unpivot("label", columns, "feature", "value").filter(F.col("value").isNotNull())
    suffix = F.col("label").cast("string") if per_class else F.lit("")
    placed = long.withColumn("_range", F.try_element_at(ranges, F.concat("feature", suffix)))
    low, high = F.col("_range.low"), F.col("_range.high")
    position = F.coalesce(F.try_divide((F.col("value") - low) * bins, high - low), F.lit(0.0))
    return (
        placed.select(
            "feature", "label", low.alias("low"), high.alias("high"),
            F.least(F.floor(position).cast("int"), F.lit(bins - 1)).alias("bin"),
        )
        .groupBy("feature", "label", "low", "high", "bin")
        .agg(F.count("*").alias("n"))
        .select(
            "feature", "label", "bin",
            (F.col("low") + F.col("bin") * (F.col("high") - F.col("low")) / bins).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * (F.col("high") - F.col("low")) / bins).alias("bin_end"),
            "n",
        )
    )


def cleaning_funnel(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows, share of the first stage and column count after each step."""
    counts = None
    for position, (name, df) in enumerate(stages):
        row = df.agg(
            F.lit(position).alias("position"), F.lit(name).alias("stage"),
            F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        )
        counts = row if counts is None else counts.unionByName(row)
    # One row per stage, so one task for the window is enough.
    first = F.first("n_rows").over(Window.orderBy("position"))
    return counts.withColumn("share", share(F.col("n_rows"), first)).orderBy("position")
