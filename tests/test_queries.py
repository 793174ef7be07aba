"""Registered queries against SQL on the smallest tables; check.py runs all of them at any scale."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from shelfcast.checks import queries as q
from shelfcast.session import materialize

SAMPLE = [
    "brand_sales_3m", "point_features_pivot", "daily_sales_fact", "calendar_features_v1", "calendar_features_v2", "order_history_v1",
    "sales_features_v1", "features_v1_full", "features_v2_full", "scoring_frame", "class_gap_budget", "recommend_orders", "recommendation_summary",
    "time_series_folds", "forecast_sanitise", "replace_slice_roundtrip",
]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, sf, name):
    assert compare(spark, con, name, sf).startswith("ok")


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["state_as_of_day", "scoring_frame_from_state", "category_weekend_models"])
def test_daily_fact_is_stored_once(spark, sf, monkeypatch, name):
    """Queries that read the daily fact several times store it: each reading joined all order lines again."""
    labels = []
    monkeypatch.setattr(q, "materialize", lambda df, label: labels.append(label) or materialize(df, label))
    q.QUERIES[name](spark, sf)
    assert labels == ["daily-sales"]
