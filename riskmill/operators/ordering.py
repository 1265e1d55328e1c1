"""Sorts, limits and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def order_by(
    df: DataFrame, names: Sequence[str], desc: bool = False, ties: Sequence[str] = ()
) -> DataFrame:
    """Sort by columns, ties broken in ascending order of further columns."""
    order = [F.col(c).desc() if desc else F.col(c).asc() for c in names]
    return df.orderBy(*order, *ties)


def order_by_abs(df: DataFrame, name: str, ties: Sequence[str] = ()) -> DataFrame:
    """Sort by magnitude, largest first."""
    return df.orderBy(F.abs(F.col(name)).desc(), *ties)


def first_rows(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """The first n rows, in the given order if any."""
    return (df.orderBy(*order) if order else df).limit(n)


def top_k(df: DataFrame, name: str, k: int, ties: Sequence[str] = ()) -> DataFrame:
    """The k rows with the largest value; each task keeps only k rows."""
    return order_by(df, [name], desc=True, ties=ties).limit(k)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by name."""
    return reduce(DataFrame.unionByName, tables)


def argmax_row(df: DataFrame, name: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the largest value; NULL and NaN are no candidates."""
    value = F.col(name)
    usable = df.filter(value.isNotNull() & ~F.isnan(value.cast("double")))
    return top_k(usable, name, 1, ties)
