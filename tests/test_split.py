import pytest
from pyspark.sql import functions as F

from riskmill.operators import split
from riskmill.spec import LOANS

LABEL = LOANS.label


@pytest.fixture(scope="module")
def parts(loans):
    return split.stratified_split(loans, LABEL, "id").select("id", LABEL, "split")


def test_parts_are_complete_and_copies_stay_together(loans, parts):
    assert parts.count() == loans.filter(F.col(LABEL).isNotNull()).count()
    assert parts.groupBy("id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0


def test_partitioning_moves_no_row(loans, parts):
    again = split.stratified_split(loans.repartition(17), LABEL, "id").select(*parts.columns)
    assert parts.exceptAll(again).count() == 0


def test_shares_and_rates(parts):
    balance = {r["split"]: r for r in split.split_balance(parts, LABEL).collect()}
    total = sum(r["n_rows"] for r in balance.values())
    for name, fraction in zip(split.PARTS, split.FRACTIONS):
        assert balance[name]["n_rows"] / total == pytest.approx(fraction, abs=0.03)
        assert balance[name]["rate"] == pytest.approx(0.06, abs=0.02)


def test_other_labels_are_dropped(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0), (3, 2.0), (4, None)], "id int, y double")
    assert split.stratified_split(df, "y", ["id"]).count() == 2


def test_bad_fractions(loans):
    with pytest.raises(ValueError):
        split.stratified_split(loans, LABEL, "id", (0.5, 0.1, 0.1))
    with pytest.raises(ValueError):
        split.stratified_split(loans, LABEL, "id", (0.5, 0.5))


def test_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    assert sorted(r["weight"] for r in split.add_class_weights(df, "y").collect()) == [1.0, 1.0, 1.0, 3.0]
    with pytest.raises(Exception, match="no positive labels"):
        split.add_class_weights(df.filter("y = 0"), "y").collect()


def test_undersample(loans, parts):
    positives = parts.filter(F.col(LABEL) == 1).count()
    small = split.undersample(parts, LABEL, "id", 3.0)
    assert small.filter(F.col(LABEL) == 1).count() == positives
    assert small.filter(F.col(LABEL) == 0).count() == pytest.approx(3 * positives, rel=0.15)
    assert split.undersample(parts, LABEL, "id", 1e6).count() == parts.count()
