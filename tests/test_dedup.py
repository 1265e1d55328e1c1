"""Duplicates are found without moving the rows that have none."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskmill.operators import dedup, split
from riskmill.plans import queries

SCHEMA = "k long, o long, d double, t string, a array<int>"
ROWS = [
    (1, 2, 0.0, "x", [1]), (1, 1, 0.0, "x", [1]), (1, 1, 0.0, "w", [1]), (2, 1, -0.0, None, None), (2, 1, 0.0, None, None),
    (None, 3, float("nan"), "", []), (None, 3, float("nan"), "", []), (None, 1, None, "", []), (3, None, 1.0, "a", [1]),
    (4, 1, 1.0, "a", [1]), (4, 1, 1.0, "a", [2]), (5, 1, 1.0, "a", None),
]


def shown(df):
    return sorted(repr(tuple(0.0 if v == 0 and isinstance(v, float) else v for v in r)) for r in df.collect())


@pytest.mark.parametrize("slots", [dedup.SLOTS, 64])  # 64: rows meet the marks of others
def test_results_equal_the_plain_ones(spark, monkeypatch, slots):
    monkeypatch.setattr(dedup, "SLOTS", slots)
    df = spark.createDataFrame(ROWS + [(i, i, 0.5, str(i), None) for i in range(100, 400)], SCHEMA).repartition(5)
    assert shown(dedup.drop_duplicate_rows(df)) == shown(df.dropDuplicates())
    first = df.selectExpr("*", "row_number() OVER (PARTITION BY k ORDER BY o, d, t, a) AS r").filter("r = 1").drop("r")
    assert shown(dedup.dedup_by_key(df, "k", order_by=["o"])) == shown(first)
    assert dedup.drop_duplicate_rows(df.limit(0)).count() == dedup.dedup_by_key(df.limit(0), "k").count() == 0


def test_text_equal_by_collation_is_one_row(spark):
    df = spark.sql("SELECT t COLLATE UTF8_LCASE AS t, 1 AS n FROM VALUES ('a'), ('A'), ('b') AS v(t)")
    assert dedup.drop_duplicate_rows(df).count() == dedup.dedup_by_key(df, "t").count() == 2


def shuffled_rows(df):
    """Rows written by all shuffles of a query."""
    df.collect()
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName() == "Exchange":
            found.append((len(node.output().mkString(",").split(",")), node.metrics().apply("shuffleRecordsWritten").value()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return found


@pytest.mark.parametrize("of", [dedup.drop_duplicate_rows, lambda df: dedup.dedup_by_key(df, "k", ["v3"])])
def test_rows_that_do_not_repeat_are_not_shuffled(spark, of):
    df = spark.range(3000).select(F.col("id").alias("k"), *(F.lit(i).alias(f"v{i}") for i in range(8)))
    df = df.union(df.filter("k % 500 = 0"))
    wide = [rows for columns, rows in shuffled_rows(of(df)) if columns >= 9]
    assert sum(wide) <= 12
    assert of(df).count() == 3000


def test_parts_are_written_without_a_sort(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("id"), (F.col("id") % 2).alias("default_ind"))
    stored = queries._stored_split(rows, "parts")
    assert stored.groupBy("split").count().count() == len(split.PARTS) and stored.count() == 1000
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= len(split.PARTS)
