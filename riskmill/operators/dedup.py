"""Duplicate counting and removal."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StringType, StructType

#: Slots of the marks of digests that repeat (a power of two); 64 share a row, so at most 2**20 rows are broadcast.
SLOTS = 1 << 26


def _digest(df: DataFrame) -> Column:
    """A hash that equal rows share. Nested columns, and text compared by a collation, are left to the comparison of whole rows."""
    plain = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType) and not f.dataType.isUTF8BinaryCollation():
            continue
        if isinstance(f.dataType, (DoubleType, FloatType)):
            plain.append(F.col(f"`{f.name}`") + F.lit(0.0))  # 0.0 and -0.0 are equal
        elif not isinstance(f.dataType, (ArrayType, MapType, StructType)):
            plain.append(F.col(f"`{f.name}`"))
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def duplicate_report(df: DataFrame, key: str, entity: str) -> DataFrame:
    """One row of counts, exact, in two phases.

    First (key, entity, row digest) are grouped: a row whose group is its own differs from all others.
    Whole rows are compared only where a group repeats, after a semi join with those groups. A NULL key is no
    key: it counts as a duplicate, and deduplication keeps one row for it.
    """
    digest = _digest(df)
    groups = df.select(F.col(key).alias("_key"), F.col(entity).alias("_entity"), digest.alias("_digest")).groupBy(
        "_key", "_entity", "_digest"
    ).agg(F.count("*").alias("copies"))
    repeated = groups.filter(F.col("copies") > 1)
    same = (
        F.col(key).eqNullSafe(F.col("_key")) & F.col(entity).eqNullSafe(F.col("_entity")) & (F.col("_own") == F.col("_digest"))
    )
    compared = df.withColumn("_own", digest).join(repeated, same, "left_semi").groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(
        F.count("*").alias("_copies")
    ).agg(F.count("*"))
    totals = groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_raw"),
        F.count_distinct("_key").alias("distinct_key"),
        F.count_distinct("_entity").alias("distinct_entity"),
        F.count_if(F.col("copies") == 1).alias("alone"),
        F.count_if(F.col("_key").isNull()).alias("null_keys"),
    )
    rows_after = F.col("distinct_key") + F.when(F.col("null_keys") > 0, 1).otherwise(0)
    return totals.withColumn("distinct_rows", F.col("alone") + compared.scalar()).select(
        "rows_raw",
        "distinct_key",
        "distinct_entity",
        (F.col("rows_raw") - F.col("distinct_key")).alias("duplicate_keys"),
        (F.col("rows_raw") - F.col("distinct_rows")).alias("identical_rows"),
        (F.col("rows_raw") - rows_after).alias("rows_removed"),
        rows_after.alias("rows_after"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def _repeats_apart(df: DataFrame, names: Sequence[str], resolve: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All rows whose digest of the named columns no other row has, and ``resolve`` of the others.

    Only digests are shuffled, and the whole rows that repeat. Digests that repeat set one of ``SLOTS`` bits, so what
    every task gets is bounded; a row that meets another's bit is resolved too, which changes nothing. The rows
    are computed three times, and have to be the same each time.
    """
    digest = _digest(df.select(*(F.col(f"`{c}`") for c in names)))
    repeated = df.select(digest.alias("_digest")).groupBy("_digest").agg(F.count("*").alias("_n")).filter(F.col("_n") > 1)

    def place(value):
        slot = F.pmod(value, F.lit(SLOTS))
        return F.shiftright(slot, 6), (slot % 64).cast("int")

    word, bit = place(F.col("_digest"))
    marks = F.broadcast(repeated.groupBy(word.alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_marks")
    ))
    word, bit = place(digest)
    placed = df.select(*(F.col(f"`{c}`") for c in df.columns), word.alias("_word"), bit.alias("_bit"))
    alone = placed.join(marks, "_word", "left").filter(F.coalesce(F.getbit("_marks", "_bit"), F.lit(0)) == 0)
    others = placed.join(marks, "_word").filter(F.getbit("_marks", "_bit") == 1)
    plain = [F.col(f"`{c}`") for c in df.columns]
    return alone.select(*plain).union(resolve(others.select(*plain)))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows. Whole rows are shuffled and compared only where their digest repeats."""
    return _repeats_apart(df, df.columns, lambda rows: rows.dropDuplicates())


def dedup_by_key(
    df: DataFrame, key: str, order_by: Sequence[str | Column] | None = ()
) -> DataFrame:
    """One row per key: the first by ``order_by``, then by all columns, so reruns agree.

    Only rows whose key repeats are shuffled and sorted. Spark limits each group to one row before the shuffle
    (WindowGroupLimit), so a key that holds a large part of the table sends one row per task. With ``order_by=None``
    any row may survive, which saves the sort.
    """
    if order_by is None:
        return df.dropDuplicates([key])
    order = [*order_by, *[F.col(c) for c in df.columns if c != key]]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return _repeats_apart(
        df, [key], lambda rows: rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
    )
