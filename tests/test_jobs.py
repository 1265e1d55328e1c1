"""Both jobs end to end, from CSV text to the comparison tables."""

import pytest
from pyspark.sql import functions as F

from riskmill.plans import queries
from riskmill.plans.profile_table import profile_table
from riskmill.plans.train_models import train_models
from riskmill.sources.tables import read_result, write_csv_table
from riskmill.spec import LOANS


@pytest.fixture(scope="module")
def output(spark, loans, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("jobs"))
    write_csv_table(loans, f"{folder}/loans")
    profile_table(spark, f"{folder}/loans", f"{folder}/profile", csv_copy=True)
    return folder


def test_profile_results(spark, loans, output):
    def table(name):
        return read_result(spark, f"{output}/profile/tables/{name}")

    funnel = {r["stage"]: r["n_rows"] for r in table("cleaning_summary").collect()}
    clean = spark.read.parquet(f"{output}/profile/data/clean")
    assert funnel["raw"] == loans.count()
    assert funnel["unique_key"] == loans.select("id").distinct().count()
    assert funnel["core_complete"] == clean.count()
    assert "sparse_col" not in clean.columns
    assert table("rate_by_grade").count() == 7
    assert table("correlation_matrix").count() == len(LOANS.matrix_columns) ** 2
    assert table("constant_columns").first()["column"] == "policy_code"
    copy = spark.read.schema(clean.schema).csv(f"{output}/profile/data/clean_csv", header=True)
    assert copy.count() == clean.count()


def test_training_results(spark, output):
    search = {"logistic": queries.models.Search({"regParam": [0.01, 0.1]}, folds=2, fold_key=["id"])}
    tuned = train_models(
        spark, f"{output}/profile/data/clean", f"{output}/training", kinds=["logistic", "forest"],
        params={"logistic": {"maxIter": 10}, "forest": {"numTrees": 10, "maxDepth": 5}}, searches=search, undersample=5.0,
    )
    rows = {r["model"]: r for r in tuned.collect()}
    assert set(rows) == {"logistic", "forest"}
    for row in rows.values():
        assert row["tp"] + row["tn"] + row["fp"] + row["fn"] == row["test_rows"]
        assert 0 < row["auc_roc"] < 1

    def table(name):
        return read_result(spark, f"{output}/training/tables/{name}")

    assert table("search_logistic").count() == 2
    assert table("model_comparison").count() == 4
    assert table("threshold_tuning").count() == 2
    assert table("feature_importance_forest").count() == 20
    assert table("predictions_sample").count() == min(1000, rows["forest"]["test_rows"])
    roc = spark.read.parquet(f"{output}/training/data/roc_forest")
    assert roc.agg(F.max("tpr"), F.max("fpr")).first()[:] == (1.0, 1.0)
    whole = table("feature_importance_all_forest").orderBy(F.desc("importance"), "feature").collect()
    assert len(whole) > 20 and sum(r["importance"] for r in whole) == pytest.approx(1.0)
    assert whole[:20] == table("feature_importance_forest").orderBy(F.desc("importance"), "feature").collect()
    balance = {r["split"]: r["n_rows"] for r in table("split_balance").collect()}
    assert rows["forest"]["train_rows"] < balance["train"]
