"""Reproducible splits, class weights and undersampling. All narrow but for one-row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskmill.functions.columns import share, unit_hash
from riskmill.spec import SEED

# The shares of the three parts.
FRACTIONS = (0.64, 0.16, 0.20)
PARTS = ("train", "val", "test")


def stratified_split(
    df: DataFrame, label: str, key: str | Sequence[str],
    fractions: Sequence[float] = FRACTIONS, seed: int = SEED,
    names: Sequence[str] = PARTS, target: str = "split",
) -> DataFrame:
    """Add the part each row belongs to; rows with a label other than 0 and 1 are dropped.

    The part follows from a hash of the key, so every class is split in the same shares,
    copies of a row stay together, and neither partitioning nor a retry moves a row.
    """
    if len(fractions) != len(names):
        raise ValueError("one name per fraction")
    if abs(sum(fractions) - 1.0) > 1e-6:
        raise ValueError("split fractions must sum to 1")
    u = unit_hash([key] if isinstance(key, str) else list(key), seed)
    part, edge = None, 0.0
    for name, fraction in zip(names[:-1], fractions[:-1]):
        edge = round(edge + fraction, 12)
        part = F.when(u < edge, name) if part is None else part.when(u < edge, name)
    part = F.lit(names[-1]) if part is None else part.otherwise(names[-1])
    return df.filter(F.col(label).isin(0, 1)).withColumn(target, part)


def split_balance(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows and positive share of each part."""
    positives = F.count_if(F.col(label) == 1)
    return df.groupBy(split).agg(
        F.count("*").alias("n_rows"), positives.alias("positives"),
        share(positives, F.count("*")).alias("rate"),
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """One row: negatives, positives, their ratio and the positive share."""
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(
        n0.alias("negatives"), n1.alias("positives"),
        share(n0, n1).alias("ratio"), share(n1, n0 + n1).alias("rate"),
    )


def add_class_weights(
    df: DataFrame, label: str, target: str = "weight", source: DataFrame | None = None
) -> DataFrame:
    """Weight positives by negatives / positives of ``source`` (default: the table itself).

    Fails when the query runs if there is no positive row.
    """
    ratio = class_counts(source if source is not None else df, label).select(
        F.coalesce("ratio", F.raise_error(F.lit("no positive labels")).cast("double"))
    ).scalar()
    return df.withColumn(target, F.when(F.col(label) == 1, ratio).otherwise(1.0))


def undersample(
    df: DataFrame, label: str, key: str | Sequence[str], max_ratio: float, seed: int = SEED
) -> DataFrame:
    """Keep all positives and about ``max_ratio`` negatives for each; unchanged if below."""
    keys = [key] if isinstance(key, str) else list(key)
    wanted = F.floor(F.col("positives") * F.lit(float(max_ratio)))
    fraction: Column = class_counts(df, label).select(
        F.when(wanted >= F.col("negatives"), 1.0).otherwise(share(wanted, F.col("negatives")))
    ).scalar()
    kept = F.col(label).isin(0, 1) & (
        (F.col(label) == 1) | (unit_hash(keys, seed, "|undersample") < fraction)
    )
    return df.filter((fraction >= 1.0) | kept)
