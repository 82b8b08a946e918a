"""Registered queries against their SQL on the smallest tables."""

import os

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")

# One of each kind; ``python tests/compare.py 0.01`` runs them all.
CHECKED = ["behavior_normalized", "flex_event_time", "rule_history", "rule_match_asof", "payment_candidates",
           "all_alerts", "arrival_alerts", "alert_table", "alerts_per_hour", "feature_by_ip", "dedup_alerts",
           "case_summary", "pattern_followed_by", "pattern_payment_chain", "csv_clickstream", "arrival_disorder",
           "asof_alerts", "gated_alerts", "features_from_documents", "jsonl_roundtrip", "behavior_rejects"]


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, tables, name):
    assert compare(spark, tables, name, queries()[name], oracle_sql()[name], FOLDER) is None


def test_names_agree():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_flagship_plan_shuffles_events_once(spark):
    """Both passes over the slots read one exchange; what else is shuffled are the maps of slots."""
    alerts = entry(spark)
    alerts.collect()
    plan = alerts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning(groupKey") <= 3 and plan.count("ReusedExchange [groupKey") == 1
    assert "CartesianProduct" not in plan and plan.count("FileScan") == 1
