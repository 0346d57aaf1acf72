"""The same results where a side is too large to broadcast or collect."""

import pytest

from __spark_entry__ import oracle_sql, queries
from check_oracle import compare, connect
from tallyguard.operators import behaviour, prepare, profile, quantiles

FOLDER = "/root/testdata/sf0.001"
NAMES = [
    "box_stats_by",
    "describe_numeric",
    "stratified_split",
    "ordinal_encode",
    "class_weights",
    "prof_international",
    "prof_weekly_count",
    "feature_table",
]


@pytest.fixture
def nothing_is_small(monkeypatch, spark):
    for module in (behaviour, prepare):
        monkeypatch.setattr(module, "collect_small", lambda df, *rest: None)
    for module in (prepare, profile, quantiles):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df, *rest: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", NAMES)
def test_without_small_tables(spark, nothing_is_small, name):
    fine, note = compare(spark, connect(FOLDER), FOLDER, name, queries()[name], oracle_sql()[name])
    assert fine, note


@pytest.mark.parametrize("name", ["prof_daily_count", "prof_weekly_count", "prof_max_24h", "prof_failed_count", "prof_prev_fraud", "prof_avg_amount"])
def test_every_customer_hot(spark, monkeypatch, name):
    from tallyguard.plans.catalog import history

    plain = history.behaviour.customer_profile
    monkeypatch.setattr(
        history.behaviour, "customer_profile", lambda df, wanted, names, hot_rows: plain(df, wanted, names, 0)
    )
    fine, note = compare(spark, connect(FOLDER), FOLDER, name, queries()[name], oracle_sql()[name])
    assert fine, note


def test_hot_customers_that_do_not_fit_a_list(spark, tables, nothing_is_small):
    rows = tables.transactions().drop("transaction_time")
    listed = behaviour.customer_profile(rows, names=behaviour.HistoryColumns(failed="false", fraud="false"), hot_rows=10**9)
    mixed = behaviour.customer_profile(rows, names=behaviour.HistoryColumns(failed="false", fraud="false"), hot_rows=20)
    assert listed.exceptAll(mixed).count() == 0
    assert mixed.count() == rows.count()
