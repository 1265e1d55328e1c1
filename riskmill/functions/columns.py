"""Parsing, cleaning and feature expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F
from pyspark.sql.types import (
    BinaryType, BooleanType, DataType, DoubleType, FloatType, IntegralType, TimestampType,
)


def parse_unit_suffix(column: Column, unit: str, data_type: str = "int") -> Column:
    """Number in text such as ``' 36 months'``; NULL when no number is left."""
    return F.trim(F.regexp_replace(column, unit, "")).try_cast(data_type)


def parse_percent(column: Column) -> Column:
    """Number in text such as ``'45%'``; numbers pass through, other text is NULL."""
    return F.regexp_replace(column, "%", "").try_cast("double")


def known_category(column: Column, level: str = "UNKNOWN", blank_is_missing: bool = True) -> Column:
    """Text of a category with a level of its own for NULL and, by default, for ''."""
    text = column.cast("string")
    return F.coalesce(F.nullif(text, F.lit("")) if blank_is_missing else text, F.lit(level))


def map_ordinal(
    column: Column, mapping: Mapping[str, float], default: float, normalize: bool = False
) -> Column:
    """Rank of an ordered category; ``normalize`` trims and uppercases before the lookup."""
    text = F.upper(F.trim(column)) if normalize else column
    pairs = [F.lit(item) for pair in mapping.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), text), F.lit(default))


def safe_ratio(
    numerator: Column, denominator: Column, upper: float | None = None, zero_only: bool = False
) -> Column:
    """Quotient, NULL unless the denominator is positive (``zero_only``: unless it is not 0)."""
    usable = denominator != 0 if zero_only else denominator > 0
    ratio = F.when(usable, numerator / denominator)
    return ratio if upper is None else clip_upper(ratio, upper)


def interaction(left: Column, right: Column) -> Column:
    """Product of two features."""
    return left * right


def clip_upper(column: Column, cap: float) -> Column:
    """Values above the cap become the cap; NULL and NaN stay as they are."""
    value = column.cast("double")
    return F.when((value > cap) & ~F.isnan(value), F.lit(float(cap))).otherwise(value)


def named_label(column: Column, names: Mapping[int, str]) -> Column:
    """Readable class name; values without a name appear as their own text."""
    text = column.cast("string")
    named = F.lit(None).cast("string")
    for value, name in names.items():
        named = F.when(column == value, F.lit(name)).otherwise(named)
    return F.coalesce(named, text)


def without_nan(column: Column, data_type: DataType) -> Column:
    """The column with NaN as NULL, where its type has NaN (``isnan`` on text may raise)."""
    if isinstance(data_type, (DoubleType, FloatType)):
        return F.nanvl(column, F.lit(None).cast(data_type))
    return column


def is_missing(column: Column, data_type: DataType) -> Column:
    """NULL or NaN."""
    return without_nan(column, data_type).isNull()


def comparable(column: Column, data_type: DataType) -> list[Column]:
    """The value as (whole, real, text), two of them NULL, so that columns of any type can
    share one grouping. Equal exactly when the values are equal."""
    whole, real, text = F.lit(None).cast("bigint"), F.lit(None).cast("double"), F.lit(None).cast("string")
    if isinstance(data_type, (IntegralType, BooleanType)):
        whole = column.cast("bigint")
    elif isinstance(data_type, TimestampType):
        whole = F.unix_micros(column)  # local times repeat when clocks go back
    elif isinstance(data_type, (DoubleType, FloatType)):
        real = column.cast("double")
    else:
        text = F.hex(column) if isinstance(data_type, BinaryType) else column.cast("string")
    return [whole, real, text]


def share(part: Column, whole: Column) -> Column:
    """Part over whole as a double, NULL when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


#: Stands for NULL in a hashed key.
NULL_KEY = "\x00null"


def unit_hash(keys: list[str], seed: int, salt: str = "") -> Column:
    """Uniform number in [0, 1) fixed by the key, whatever the partitioning or retries.

    Rows with equal keys get equal numbers, so copies stay on one side of a split. NULL is a
    value of its own at its place in the key.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY)) for k in keys]
    text = F.concat_ws("|", *parts, F.lit(f"{seed}{salt}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def guarded_corr(left: Column, right: Column) -> Column:
    """Pearson r over complete pairs, NaN counted as missing; NULL for a constant, where
    ``corr`` raises under ANSI."""
    nothing = F.lit(None).cast("double")
    left, right = (F.nanvl(c.cast("double"), nothing) for c in (left, right))
    x = F.when(right.isNotNull(), left)
    y = F.when(left.isNotNull(), right)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
