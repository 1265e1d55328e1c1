"""Tables in and out of files, all read and written by executors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType, StructType


#: Rows that one file, written by one task, may have.
SMALL_ROWS = 100_000


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read a table; CSV takes a header and RFC 4180 quoting.

    Give a schema where you can: inference is one more pass over the text. ``multi_line``
    keeps quoted line breaks whole, but such files cannot be split among tasks, so prefer
    parquet for tables that carry free text.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # An empty field is NULL and a quoted empty field is empty text: the reader tells them
        # apart only if the text that stands for NULL is not itself empty.
        reader = reader.options(
            header=True, quote='"', escape='"', multiLine=multi_line, nullValue="\u0000"
        )
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The same table, or an error that lists the missing columns."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def table_shape(df: DataFrame, leading: int = 20) -> DataFrame:
    """One row: rows, columns, numeric columns and the first column names."""
    numeric = sum(isinstance(f.dataType, NumericType) for f in df.schema.fields)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(numeric).alias("n_numeric"),
        F.lit(", ".join(df.columns[:leading])).alias("leading_columns"),
    )


def write_csv_table(df: DataFrame, path: str) -> None:
    """CSV with a header and RFC 4180 quoting, one file per task."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def write_parquet_table(df: DataFrame, path: str) -> None:
    """Parquet, the default hand-over format. A failed write raises."""
    df.write.mode("overwrite").parquet(path)


def write_result(df: DataFrame, path: str, small: bool = True) -> None:
    """Result table as CSV; ``small`` results, bounded by categories or columns, get one file.

    More than `SMALL_ROWS` rows are no small result: that raises before anything is written.
    """
    if small and df.select(F.lit(1)).limit(SMALL_ROWS + 1).count() > SMALL_ROWS:
        raise ValueError(f"more than {SMALL_ROWS} rows; write them with small=False")
    write_csv_table(df.coalesce(1) if small else df, path)


def read_result(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read a result table back."""
    return read_table(spark, path, schema=schema)


def prediction_sample(
    predictions: DataFrame, columns: Sequence[str], order_by: Sequence[str], n: int = 1000
) -> DataFrame:
    """The first n predictions in key order, so that a rerun gives the same sample."""
    keys = [*order_by, *[c for c in columns if c not in order_by]]
    return predictions.orderBy(*keys).limit(n).select(*columns)


def write_prediction_sample(
    predictions: DataFrame, path: str, columns: Sequence[str], order_by: Sequence[str], n: int = 1000
) -> None:
    """Write ``prediction_sample`` as one CSV file."""
    write_result(prediction_sample(predictions, columns, order_by, n), path)
