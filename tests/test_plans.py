"""Plans that must hold at scale: pruning, one scan, no cross join, early group limits."""

import re

import pytest

from riskmill.operators import dedup, profile, relevance
from riskmill.plans import queries
from riskmill.spec import LOANS


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, loans, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "loans")
    loans.write.parquet(path)
    return spark.read.parquet(path)


def scans(text):
    return len(re.findall(r"FileScan parquet", text))


def test_rates_read_two_columns_once(stored):
    text = plan(profile.rate_by(stored, "grade", LOANS.label))
    assert "ReadSchema: struct<grade:string,default_ind:int>" in text and scans(text) == 1


def test_all_rate_columns_share_a_scan(stored):
    assert scans(plan(profile.rates_for_columns(stored, LOANS.rate_columns, LOANS.label))) == 1


def test_duplicate_report_compares_whole_rows_only_where_groups_repeat(stored):
    lines = plan(dedup.duplicate_report(stored, "id", "member_id")).splitlines()
    wide = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "description" in line]
    semi = [i for i, line in enumerate(lines) if "LeftSemi" in line]
    narrow = [line for line in lines if "Exchange hashpartitioning" in line and "_digest" in line and "description" not in line]
    # A plan reads from the bottom: whole rows move after the semi join with the groups that repeat, or to it.
    assert len(semi) == 1 and narrow and all(i < semi[0] for i in wide)


def test_hot_keys_shrink_before_the_shuffle(stored):
    text = plan(dedup.dedup_by_key(stored, "id"))
    assert "Partial" in text and text.count("WindowGroupLimit") == 2


def test_label_filter_reaches_the_scan(stored):
    text = plan(profile.class_balance(stored, LOANS.label))
    assert f"PushedFilters: [IsNotNull({LOANS.label})]" in text


@pytest.mark.parametrize("name", [
    "class_balance", "histogram_by_label", "class_weights", "undersample", "threshold_sweep",
    "roc_points", "feature_relevance", "stage_summary", "corr_matrix", "cleaning_funnel",
])
def test_no_cross_join(spark, sf, name):
    text = plan(queries.registered()[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_summary_reads_each_table_once(spark, stored):
    raw = stored.filter("member_id >= 0")
    found = relevance.stage_summary(raw, stored.filter("default_ind IS NOT NULL"), LOANS, ["grade", "term", "purpose"])
    assert scans(plan(found)) == 2
