"""Physical plans: pruned scans, few shuffles, no Python, checked broadcasts."""

import re

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import behaviour, profile, quantiles
from tallyguard.plans.flows import bronze_to_gold
from tallyguard.plans.tables import TXN_HISTORY
from tallyguard.sources.topic import to_bronze


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range|Single)", text))


def test_gold_reads_one_column_and_parses_once(spark, tables):
    text = plan(bronze_to_gold(to_bronze(spark.read.parquet(tables.messages_folder()))))
    assert "ReadSchema: struct<value:binary>" in text
    assert text.count("from_json") == 1
    assert shuffles(text) == 1


def test_profile_shuffles_once_by_customer(tables):
    text = plan(behaviour.customer_profile(tables.transactions(), names=TXN_HISTORY))
    assert shuffles(text) == 1


def test_many_rates_scan_once(tables):
    df = tables.read("orders").withColumn("fraud_label", F.col("o_orderstatus"))
    text = plan(profile.fraud_rate_by(df, ["o_orderpriority", "o_orderstatus"]))
    assert text.count("FileScan") == 1 and "partial_avg" in text
    assert "ReadSchema: struct<o_orderstatus:string,o_orderpriority:string>" in text


def test_quantiles_broadcast_brackets_and_count_before_the_shuffle(tables):
    text = plan(quantiles.grouped_quantiles(tables.read("lineitem"), ["l_returnflag"], "l_extendedprice", [0.5]))
    assert "BroadcastHashJoin" in text and "partial_count" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_dates_filter_reaches_the_scan(tables):
    rows = tables.read("orders").where("o_totalprice > 1000").select("o_orderkey")
    assert "GreaterThan(o_totalprice,1000.0)" in plan(rows)


@pytest.mark.parametrize(
    "name", ["fraud_rate_by", "cardinality", "feature_table", "prof_new_merchant", "ordinal_encode", "box_stats_by"]
)
def test_no_python_and_no_cross_join(spark, name):
    from __spark_entry__ import queries

    text = plan(queries()[name](spark, "/root/testdata/sf0.001"))
    for word in ("Python", "Cartesian", "NestedLoop"):
        assert word not in text
