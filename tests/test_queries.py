import os

import pytest

import __spark_entry__ as entry_points
from oracle.answers import ANSWERS
from oracle.check import compare, connect
from tripledger.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_every_query_has_an_answer():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ANSWERS) == set(QUERIES)


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [
    "trip_feed", "silver_typed", "dq_evaluated", "silver_trips", "quarantine", "trip_performance",
    "geographic_metrics", "vendor_performance", "data_quality", "exec_tiles", "kpi_rollup",
    "profile_numeric_stats", "threshold_candidates", "demand_profile", "file_hash", "file_profile",
    "schema_drift", "ingest_log", "build_silver_trips", "build_vendor_performance", "can_fail_reason",
    "can_fail_reconciliation", "profile_tables", "duration_log_stats", "duration_boxplot",
])
def test_query_equals_its_sql(spark, tables, name):
    assert compare(entry_points.queries()[name](spark, SF_DIR), tables, ANSWERS[name]) == ""


def test_entry(spark):
    assert entry_points.entry(spark).count() == 2
