"""Registered queries against their SQL. A quick selection by default; all of them with TABWRIGHT_ALL=1."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences

QUICK = ["types_upload", "target_validation", "missing_table", "corr_pearson_gaps", "outliers_iqr_gaps", "histogram",
         "value_counts_top", "type_mismatch", "high_cardinality", "estimated_thresholds", "impute_median", "iqr_remove",
         "split_stratified", "stratified_folds", "gnb_predict", "roc_auc", "scoring_frame", "csv_bad_rows"]
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES) if os.environ.get("TABWRIGHT_ALL") else QUICK)
def test_query_equals_sql(spark, sf, con, name):
    assert differences(entry.queries()[name](spark, sf), con, ORACLES[name]) is None


def test_every_check_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 3
