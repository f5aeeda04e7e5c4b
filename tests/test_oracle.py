"""Registered queries against their SQL. ``TEST_ALL=1`` runs every one, otherwise one per kind of operator."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, oracle
from tillstream.registry import QUERIES

KINDS = ["daily_revenue", "product_performance", "funnel", "fact_orders", "dim_users", "top_products", "cohort_retention_true",
         "aov_by_segment", "revenue_by_day", "product_sales", "merge_orders", "merge_dim_users", "page_flow",
         "rank_over_time", "dq_orders", "dq_check_failures", "ingest_payments", "ingest_dead_letters", "batch_summary",
         "revenue_heatmap", "search_performance", "abandoned_carts"]
NAMES = sorted(set(oracle_sql()) & set(QUERIES)) if os.environ.get("TEST_ALL") else KINDS


@pytest.fixture(scope="module")
def con(folder):
    return oracle(folder)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, con, folder, name):
    status, rows, why = compare(spark, con, folder, name, oracle_sql()[name])
    assert status == "ok", why
    assert rows > 0


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == {"aov_by_segment_approx", "dq_monitor_approx", "ingestion_lag_approx", "monthly_active_users"}


def test_entry_is_lazy_and_has_rows(spark):
    assert entry(spark).count() > 0
