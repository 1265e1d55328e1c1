import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskmill.functions import columns as C
from riskmill.operators import clean
from riskmill.spec import LOANS

NAN = float("nan")


def values(df, name):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize("text, months, percent", [
    (" 36 months", 36, None), ("60months", 60, None), ("n/a", None, None), (None, None, None),
    ("12.5", None, 12.5), (" 7 ", 7, 7.0), ("45%", None, 45.0), ("1,000", None, None),
])
def test_units_and_percents(spark, text, months, percent):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(
        C.parse_unit_suffix(F.col("t"), "months").alias("m"), C.parse_percent(F.col("t")).alias("p")
    ).first()
    assert (row.m, row.p) == (months, percent)


def test_percent_of_a_number(spark):
    assert values(spark.range(3).select(C.parse_percent(F.col("id")).alias("p")), "p") == [0.0, 1.0, 2.0]


def test_lenient_cast_keeps_the_rest(spark):
    df = spark.createDataFrame([("1", "x"), ("bad", "y"), (None, "z")], "a string, b string")
    out = clean.cast_lenient(df, {"a": "int", "absent": "int"})
    assert [tuple(r) for r in out.collect()] == [(1, "x"), (None, "y"), (None, "z")]


def test_complete_rows_exclude_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (NAN, 2), (None, 3), (4.0, None)], "a double, b int")
    assert values(clean.require_complete(df, ["a", "b", "absent"]), "b") == [1]
    assert values(clean.require_complete(df, ["a"]), "b") == [1, None]
    assert clean.require_complete(df, []).count() == 4


def test_sparse_is_strictly_above_the_threshold(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (1, 2, None), (1, 2, 3)],
                               "a int, half int, most int")
    assert clean.sparse_columns(df, 0.5) == ["most"]
    assert clean.drop_sparse_columns(df.limit(0)).columns == ["a", "half", "most"]


def test_categories_get_a_level(spark):
    df = spark.createDataFrame([("x", 1), ("", None), (None, 2)], "a string, n int")
    out = clean.fill_unknown(df, ["a", "n"])
    assert values(out, "a") == ["x", "UNKNOWN", "UNKNOWN"]
    assert values(out, "n") == ["1", "UNKNOWN", "2"]
    assert values(clean.fill_unknown(df, ["a"], blank_is_missing=False), "a") == ["x", "", "UNKNOWN"]


def test_ordinals_exact_or_normalized(spark):
    df = spark.createDataFrame([("A",), (" b ",), (None,), ("Z",)], "g string")
    mapping = {"A": 1.0, "B": 2.0}
    assert values(clean.map_ordinal(df, "g", "o", mapping, 4.0), "o") == [1.0, 4.0, 4.0, 4.0]
    assert values(clean.map_ordinal(df, "g", "o", mapping, 4.0, True), "o") == [1.0, 2.0, 4.0, 4.0]


def test_ratios_guard_the_denominator(spark):
    df = spark.createDataFrame([(6.0, 2.0), (6.0, 0.0), (6.0, -2.0), (6.0, None)], "a double, b double")
    pair = {"r": ("a", "b")}
    assert values(clean.safe_ratio(df, pair), "r") == [3.0, None, None, None]
    assert values(clean.safe_ratio(df, pair, zero_only=True), "r") == [3.0, None, -3.0, None]
    assert values(clean.safe_ratio(df, pair, {"r": 2.5}), "r") == [2.5, None, None, None]


def test_cap_leaves_null_and_nan(spark):
    df = spark.createDataFrame([(9.0,), (1.0,), (None,), (NAN,)], "a double")
    out = values(clean.clip_upper(df, {"a": 5.0}), "a")
    assert out[:3] == [5.0, 1.0, None] and math.isnan(out[3])


def test_unnamed_labels_show_as_text(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "y int")
    named = clean.label_names(df, "y", {0: "no", 1: "yes"})
    assert values(named, "label") == ["no", "yes", "7", None]


def test_columns_by_type_sees_every_numeric(spark):
    df = spark.sql("SELECT 1 a, 2L b, 3.5D c, 1.25BD d, 'x' e, true f")
    assert clean.columns_by_type(df, exclude=["a"]) == ["b", "c", "d"]
    assert clean.columns_by_type(df, numeric=False) == ["e", "f"]


def test_clean_table_drops_free_text_and_sparse(spark, loans):
    spec = replace(LOANS, free_text=("description",))
    out = clean.clean_table(loans, spec)
    assert not {"description", "sparse_col"} & set(out.columns)
    assert dict(out.dtypes)["term"] == "int" and dict(out.dtypes)["revol_util"] == "double"


def test_samples(spark, loans):
    with pytest.raises(ValueError):
        clean.sample_rows(loans, 0.0)
    by_key = clean.sample_rows(loans.select("id"), 0.1, by_key=["id"])
    again = clean.sample_rows(loans.select("id").repartition(13), 0.1, by_key=["id"])
    assert sorted(values(by_key, "id")) == sorted(values(again, "id"))
    assert 0.07 < by_key.count() / loans.count() < 0.13
    assert 0 < clean.sample_rows(loans.select("id"), 0.1).count() < loans.count() / 2


def test_prepared_rows_are_complete(spark, loans):
    rows = clean.prepare_features(clean.clean_table(loans, LOANS, sparse=()), LOANS, keep=["id"])
    assert set(LOANS.features) <= set(rows.columns)
    bad = sum((F.col(c).isNull() | F.isnan(c)).cast("int") for c in LOANS.model_numeric)
    assert rows.filter(bad > 0).count() == 0
