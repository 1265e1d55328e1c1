"""Pearson correlations of many columns in one scan.

Columns become rows before the map-side aggregate. Its code then stays small and compiled for
any number of columns, and only one row per task and column is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from riskmill.functions.columns import guarded_corr
from riskmill.operators.clean import require_complete


def correlation_with_target(
    df: DataFrame, names: Sequence[str], label: str, nulls: str = "pairwise", digits: int = 4
) -> DataFrame:
    """Pearson r of each column with the label, strongest first; constants are left out.

    ``nulls='pairwise'`` uses the rows where both values exist. ``nulls='zero'`` counts a
    missing value as 0, which is what ``DataFrame.stat.corr`` does.
    """
    if nulls not in ("pairwise", "zero"):
        raise ValueError("nulls must be 'pairwise' or 'zero'")

    def value(name):
        column = F.col(name).cast("double")
        return F.coalesce(column, F.lit(0.0)) if nulls == "zero" else column

    values = df.select(value(label).alias("_label"), *[value(c).alias(c) for c in names])
    r = F.round(guarded_corr(F.col("value"), F.col("_label")), digits)
    return (
        values.unpivot("_label", list(names), "feature", "value")
        .groupBy("feature").agg(r.alias("correlation"))
        .filter(F.col("correlation").isNotNull())
        .orderBy(F.abs("correlation").desc(), "feature")
    )


def skipped_correlations(df: DataFrame, names: Sequence[str], label: str) -> DataFrame:
    """Rows (feature, reason) for the columns without an r: why ``correlation_with_target`` leaves them out.

    Only rows where both values exist count.
    """
    numbers = df.select(F.col(label).cast("double").alias("_label"), *[F.col(c).cast("double").alias(c) for c in names])
    value, target = (F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("value", "_label"))
    pair = F.when(value.isNotNull() & target.isNotNull(), F.struct(value.alias("x"), target.alias("y")))
    facts = numbers.unpivot("_label", list(names), "feature", "value").groupBy("feature").agg(
        F.count(pair).alias("pairs"), F.min(pair["x"]).alias("low"), F.max(pair["x"]).alias("high"),
        F.min(pair["y"]).alias("least"), F.max(pair["y"]).alias("most"),
    )
    reason = (
        F.when(F.col("pairs") == 0, "no values").when(F.col("low") == F.col("high"), "constant")
        .when(F.col("least") == F.col("most"), "one class")
    )
    return facts.select("feature", reason.alias("reason")).filter("reason IS NOT NULL").orderBy("feature")


def correlation_matrix(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Pearson r of every pair of columns, as rows (row_name, col_name, r).

    Every task adds its rows to one matrix of centred products, and these are added up in a tree; the matrix
    of columns by columns is all that moves. Rows that lack any of the columns are skipped. A constant column
    gives NULL, and a table without complete rows gives no rows.
    """
    present = [c for c in names if c in df.columns]
    schema = "row_name string, col_name string, r double"
    values = require_complete(df.select(*[F.col(c).cast("double").alias(c) for c in present]), present)
    if not present or values.isEmpty():
        return df.sparkSession.createDataFrame([], schema)
    vectors = VectorAssembler(inputCols=present, outputCol="features").transform(values).select("features")
    matrix = Correlation.corr(vectors, "features").first()[0].toArray()
    moments = values.agg(*(F.min(c) for c in present), *(F.max(c) for c in present)).first()
    constant = [low == high for low, high in zip(moments[: len(present)], moments[len(present) :])]
    rows = [
        (a, b, None if constant[i] or constant[j] else float(matrix[i, j]))
        for i, a in enumerate(present) for j, b in enumerate(present)
    ]
    return df.sparkSession.createDataFrame(rows, schema)
