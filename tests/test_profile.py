import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmill.operators.correlation import correlation_with_target
from riskmill.operators.profile import histogram_by_label
from riskmill.operators import correlation, dedup, ordering, profile, relevance
from riskmill.spec import LOANS

NAN = float("nan")


@pytest.fixture(scope="module")
def nan_nulls(spark):
    return spark.createDataFrame([(1.0, 1), (NAN, 2), (None, 3), (4.0, None)], "a double, b int")


@pytest.fixture(scope="module")
def corr_nulls(spark):
    rows = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 1.0), (4.0, 9.0)]
    return spark.createDataFrame(rows, "a double, b double")


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_null_profile_counts_nan(nan_nulls):
    assert rows(profile.null_profile(nan_nulls)) == [("a", 2, 0.5), ("b", 1, 0.25)]


def test_null_profile_of_nothing(nan_nulls):
    assert rows(profile.null_profile(nan_nulls.limit(0))) == [("a", 0, None), ("b", 0, None)]


def test_summary_counts_non_null(nan_nulls):
    by_name = {r["feature"]: r for r in profile.summary_stats(nan_nulls, ["a", "b", "absent"]).collect()}
    assert by_name["a"]["n"] == 3 and np.isnan(by_name["a"]["max"])
    assert (by_name["b"]["n"], by_name["b"]["mean"], by_name["b"]["stddev"]) == (3, 2.0, 1.0)


def test_distinct_counts_of_any_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 0.0D, 'x', true, DATE'2020-01-01', X'01', 1.0BD),"
        " (1, -0.0D, NULL, false, DATE'2020-01-02', X'02', 1.0BD),"
        " (NULL, double('NaN'), '', NULL, NULL, NULL, NULL) AS t(i, d, s, b, dt, bin, dec)"
    )
    expected = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).first().asDict()
    assert dict(rows(profile.distinct_count(df, df.columns))) == expected
    assert dict(rows(profile.distinct_count(df, ["i", "s"], approx=True))) == {"i": 1, "s": 2}


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], ["a {b} 'c'", "e f"])
    assert dict(rows(profile.distinct_count(df, df.columns))) == {"a {b} 'c'": 2, "e f": 1}


def test_rates_keep_null_categories_and_labels(spark):
    df = spark.createDataFrame(
        [("x", 1), ("x", 0), (None, 1), ("y", None), ("y", 0)], "g string, y int"
    )
    assert rows(profile.rate_by(df, "g", "y")) == [(None, 1, 1.0), ("x", 2, 0.5), ("y", 2, 0.0)]
    assert [r[0] for r in rows(profile.rate_by(df, "g", "y", order="key"))] == [None, "x", "y"]
    long = profile.rates_for_columns(df, ["g", "absent"], "y")
    assert {r[1]: r[2:] for r in rows(long)} == {None: (1, 1.0), "x": (2, 0.5), "y": (2, 0.0)}
    assert [r["category"] for r in profile.top_categories(long, 1).collect()] == [None]


def test_class_balance_ignores_missing_labels(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "y int")
    assert rows(profile.class_balance(df, "y", {1: "yes"})) == [(0, "0", 3, 0.75), (1, "yes", 1, 0.25)]


def test_constants_and_single_values(spark):
    df = spark.createDataFrame([(1.0, 1.0, None), (1.0, 2.0, 3.0)], "a double, b double, c double")
    assert {r[0] for r in rows(profile.constant_columns(df, ["a", "b", "c"]))} == {"a", "c"}


@pytest.mark.parametrize("nulls, r", [("pairwise", 0.963123), ("zero", 0.823754)])
def test_correlation_null_modes(corr_nulls, nulls, r):
    found = correlation.correlation_with_target(corr_nulls, ["a"], "b", nulls, digits=6).first()
    assert found["correlation"] == r


def test_zero_mode_is_stat_corr(corr_nulls):
    found = correlation.correlation_with_target(corr_nulls, ["a"], "b", "zero", digits=12).first()
    assert found["correlation"] == pytest.approx(corr_nulls.stat.corr("a", "b"), abs=1e-11)


def test_constant_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert rows(correlation.correlation_with_target(df, ["a"], "b")) == []
    matrix = {r[:2]: r[2] for r in rows(correlation.correlation_matrix(df, ["a", "b"]))}
    assert matrix[("a", "b")] is None and matrix[("b", "b")] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        correlation.correlation_with_target(df, ["a"], "b", "other")


def test_matrix_equals_numpy(spark):
    data = np.random.default_rng(3).normal(size=(200, 4))
    data[:, 3] += data[:, 0]
    df = spark.createDataFrame(data.tolist() + [[NAN, 1.0, 1.0, 1.0], [None, 1.0, 1.0, 1.0]],
                               "a double, b double, c double, d double")
    found = {r[:2]: r[2] for r in rows(correlation.correlation_matrix(df, list("abcd")))}
    expected = np.corrcoef(data.T)
    assert len(found) == 16
    for i, x in enumerate("abcd"):
        for j, y in enumerate("abcd"):
            assert found[(x, y)] == pytest.approx(expected[i, j], abs=1e-12)


@pytest.mark.parametrize("per_class", [False, True])
def test_histogram_counts_every_value(loans, per_class):
    names = ["loan_amnt", "dti"]
    counts = profile.histogram_by_label(loans, names, LOANS.label, 40, per_class)
    per_feature = {r[0]: r[1] for r in rows(counts.groupBy("feature").agg(F.sum("n")))}
    labelled = loans.filter(F.col(LOANS.label).isNotNull()).count()
    assert per_feature == {name: labelled for name in names}
    assert counts.agg(F.min("bin"), F.max("bin")).first()[:] == (0, 39)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0, 0), (5.0, 1), (None, 1)], "a double, y int")
    assert {(r["label"], r["bin"], r["n"]) for r in profile.histogram_by_label(df, "a", "y").collect()} == {
        (0, 0, 1), (1, 0, 1)
    }


def test_duplicates_with_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (None, 3, "d"), (2, 3, "e")],
        "k int, e int, v string",
    )
    report = dedup.duplicate_report(df, "k", "e").first()
    assert report[:] == (6, 2, 3, 4, 1, 3, 3)
    kept = dedup.dedup_by_key(df, "k", [F.col("v").desc()])
    assert sorted(r["v"] for r in kept.collect()) == ["b", "d", "e"]
    assert dedup.dedup_by_key(df, "k", None).count() == report["rows_after"]
    assert sorted(rows(dedup.duplicate_keys(df, "k")), key=str) == [(1, 3), (None, 2)]
    assert dedup.drop_duplicate_rows(df).count() == 5


def test_survivor_does_not_depend_on_partitioning(loans):
    first = dedup.dedup_by_key(loans, "id").exceptAll(dedup.dedup_by_key(loans.repartition(11), "id"))
    assert first.count() == 0


def test_sorts_and_limits(spark):
    df = spark.createDataFrame([("a", -3.0), ("b", 2.0), ("c", None), ("d", NAN)], "n string, v double")
    assert ordering.argmax_row(df, "v").first()["n"] == "b"
    real = df.filter(~F.isnan("v"))
    assert [r["n"] for r in ordering.order_by_abs(real, "v").collect()] == ["a", "b", "c"]
    assert [r["n"] for r in ordering.top_k(real, "v", 1).collect()] == ["b"]
    other = df.select("v", "n").limit(1)
    assert ordering.union_by_name(df, other, other).count() == 6
    assert [r["n"] for r in ordering.first_rows(df, 2, ["n"]).collect()] == ["a", "b"]


def test_relevance_reasons(spark):
    df = spark.range(200).selectExpr(
        "id AS id", "id % 7 AS member_id", "int(id % 2) AS default_ind", "1 AS fixed",
        "IF(id % 5 = 0, concat('x', id % 2), NULL) AS gaps", "concat('u', id) AS unique_text",
        "double(id % 2) + id / 1000D AS signal", "id % 3 AS weak",
    )
    found = relevance.feature_relevance(df, LOANS, k=4, notes={"signal": "follows it"}).collect()
    most = [r for r in found if r["kind"] == "most"]
    least = {r["feature"]: r["reason"] for r in found if r["kind"] == "least"}
    assert most[0]["feature"] == "signal" and most[0]["note"] == "follows it"
    assert least["fixed"] == "constant" and least["gaps"] == "mostly missing"
    assert least["unique_text"] == "nearly unique" and "id" in least


def test_relevance_scans_once_for_both_kinds(spark):
    df = spark.range(30).selectExpr("id", "id AS member_id", "cast(id % 2 AS int) AS default_ind", "id % 5 AS x", "'a' AS t")
    for exact, scans in ((False, 1), (True, 2)):  # distinct counts are a second pass
        found = relevance.feature_relevance(df, LOANS, k=3, exact=exact)
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Range (") == scans
        assert [r.feature for r in found.filter("kind = 'most'").collect()] == ["x"]
        assert {r.feature for r in found.filter("kind = 'least'").collect()} == {"t", "id", "member_id"}



def test_funnel_shares(spark):
    df = spark.range(10)
    out = rows(profile.cleaning_funnel([("all", df), ("even", df.filter("id % 2 = 0"))]))
    assert out == [(0, "all", 10, 1, 1.0), (1, "even", 5, 1, 0.5)]


def test_nan_and_infinity_are_missing_in_histograms_and_correlations(spark):
    rows = [(0, 1.0, 2.0), (1, 2.0, 4.0), (0, 3.0, 6.5), (1, float("nan"), 1.0), (1, float("inf"), 1.0), (0, None, 1.0)]
    df = spark.createDataFrame(rows, "label int, x double, y double")
    bins = histogram_by_label(df, "x", "label", bins=2).collect()
    assert sum(r.n for r in bins) == 3 and {(r.bin_start, r.bin_end) for r in bins} == {(1.0, 2.0), (2.0, 3.0)}
    finite = df.filter("x < double('infinity')")
    r = correlation_with_target(finite, ["x"], "label").collect()
    plain = correlation_with_target(finite.filter("NOT isnan(x)"), ["x"], "label").collect()
    assert r == plain


def test_duplicates_are_compared_exactly(spark):
    nan = float("nan")
    data = [
        (1, 1, 0.0, [1]), (1, 1, -0.0, [1]), (1, 1, 0.0, [2]), (2, None, nan, None), (2, None, nan, None),
        (None, 3, 1.0, [1]), (None, 3, 1.0, [1]), (4, 3, None, [1]),
    ]
    df = spark.createDataFrame(data, "k long, e long, x double, a array<long>")
    report = dedup.duplicate_report(df, "k", "e").first()
    assert report.rows_raw - report.identical_rows == df.distinct().count() == 5
    assert (report.distinct_key, report.distinct_entity, report.rows_after) == (3, 2, 4)


def test_skipped_columns_have_a_reason(spark):
    df = spark.createDataFrame(
        [(1.0, None, 5.0, 1.0, 0), (2.0, None, 5.0, None, 1), (3.0, None, 5.0, None, None), (4.0, float("nan"), 5.0, 2.0, 0)],
        "ok double, none double, same double, oneclass double, y int",
    )
    found = rows(correlation.skipped_correlations(df, ["ok", "none", "same", "oneclass"], "y"))
    assert [tuple(r) for r in found] == [("none", "no values"), ("oneclass", "one class"), ("same", "constant")]
    kept = rows(correlation.correlation_with_target(df, ["ok", "none", "same", "oneclass"], "y"))
    assert [r[0] for r in kept] == ["ok"]


def test_wide_matrix_equals_pairs(spark):
    import numpy as np

    data = np.random.default_rng(1).normal(1e6, 1, (300, 100))
    data[:, 7] = data[:, 3] * 2
    data[:, 9] = 4.0
    names = [f"c{i}" for i in range(100)]
    df = spark.createDataFrame(data.tolist(), ", ".join(f"{n} double" for n in names))
    got = {(r.row_name, r.col_name): r.r for r in correlation.correlation_matrix(df, names).collect()}
    want = np.corrcoef(np.delete(data, 9, axis=1), rowvar=False)
    left = [n for n in names if n != "c9"]
    assert len(got) == 10_000 and all(got["c9", n] is None for n in names)
    assert all(abs(got[a, b] - want[i, j]) < 1e-6 for i, a in enumerate(left) for j, b in enumerate(left))
