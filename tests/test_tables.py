import pytest

from riskmill.sources import tables


def test_quotes_breaks_and_blanks_survive_csv(spark, tmp_path):
    rows = [(1, 'said "ok", then\nleft', ""), (2, None, "plain")]
    df = spark.createDataFrame(rows, "id int, note string, other string")
    tables.write_csv_table(df, f"{tmp_path}/t")
    back = tables.read_table(spark, f"{tmp_path}/t", schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == rows


def test_inferred_types_without_schema(spark, tmp_path):
    tables.write_csv_table(spark.createDataFrame([(1, 2.5, "x")], "a int, b double, c string"), f"{tmp_path}/t")
    assert dict(tables.read_table(spark, f"{tmp_path}/t").dtypes) == {
        "a": "int", "b": "double", "c": "string"
    }


def test_missing_columns_are_listed(spark):
    with pytest.raises(ValueError, match=r"\['y', 'z'\]"):
        tables.require_columns(spark.range(1), ["id", "y", "z"])


def test_result_is_one_file(spark, tmp_path):
    tables.write_result(spark.range(100).repartition(5), f"{tmp_path}/r")
    assert len(list((tmp_path / "r").glob("*.csv"))) == 1
    assert tables.read_result(spark, f"{tmp_path}/r").count() == 100


def test_failed_write_raises(spark, tmp_path):
    (tmp_path / "file").write_text("in the way")
    with pytest.raises(Exception):
        tables.write_parquet_table(spark.range(1), f"{tmp_path}/file/under")


def test_prediction_sample_is_first_by_key(spark):
    df = spark.range(50).selectExpr("id AS k", "id % 2 AS y").repartition(7)
    sample = tables.prediction_sample(df, ["y"], ["k"], n=3)
    assert [r["y"] for r in sample.collect()] == [0, 1, 0]


def test_small_results_have_a_bound(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_ROWS", 10)
    tables.write_result(spark.range(10), f"{tmp_path}/ten")
    with pytest.raises(ValueError, match="more than 10 rows"):
        tables.write_result(spark.range(11), f"{tmp_path}/eleven")
    assert not (tmp_path / "eleven").exists()
    tables.write_result(spark.range(11), f"{tmp_path}/eleven", small=False)
    assert spark.read.csv(f"{tmp_path}/eleven", header=True).count() == 11
