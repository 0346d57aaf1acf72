import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyguard.operators import behaviour
from tallyguard.operators.behaviour import FEATURES, HistoryColumns, customer_profile

NAMES = HistoryColumns(failed="kind = 'error'", fraud="label = 'Fraud'")
START = dt.datetime(2024, 3, 1)
SCHEMA = "row int, customer_id double, merchant_id int, ts timestamp_ntz, amount double, kind string, label string"


@pytest.fixture(scope="module")
def history():
    """One customer with a third of the rows, one without an id, several rows at one instant, steps that
    fall exactly on the frame ends."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(900):
        customer = 1.0 if rng.random() < 0.34 else [2.0, 3.0, 4.0, None][rng.integers(4)]
        minutes = int(rng.choice([0, 1, 1440, 2880, 10080, rng.integers(0, 20 * 1440)]))
        micros = int(rng.choice([0, 0, 1, 30_000_000]))
        ts = START + dt.timedelta(minutes=minutes, microseconds=micros)
        amount = None if rng.random() < 0.1 else float(rng.integers(1, 500)) / 4
        kind = "error" if rng.random() < 0.3 else "buy"
        label = [None, "Fraud", "Normal"][rng.integers(3)]
        rows.append((i, customer, int(rng.integers(6)), ts, amount, kind, label))
    return rows


def brute_force(rows):
    frame = pd.DataFrame(rows, columns=["row", "c", "m", "ts", "amount", "kind", "label"])
    out = {}
    for r in rows:
        c, ts = r[1], r[3]
        mine = frame[frame["c"].isna()] if c is None else frame[frame["c"] == c]
        past = mine[mine["ts"] <= ts]
        day = past[past["ts"] >= ts - dt.timedelta(days=1)]
        amounts = past["amount"].dropna()
        top = day["amount"].dropna()
        out[r[0]] = (
            int((past["ts"].dt.date == ts.date()).sum()),
            int((past["ts"] >= ts - dt.timedelta(days=7)).sum()),
            amounts.mean() if len(amounts) else None,
            top.max() if len(top) else None,
            int((day["kind"] == "error").sum()),
            int((mine[mine["ts"] < ts]["label"] == "Fraud").sum()),
        )
    return out


@pytest.mark.parametrize("hot_rows", [10_000, 250, 0])
def test_both_plans_match_brute_force(spark, history, hot_rows):
    df = spark.createDataFrame(history, SCHEMA).repartition(5)
    got = customer_profile(df, names=NAMES, hot_rows=hot_rows)
    assert got.columns == [*df.columns, *FEATURES]
    expected = brute_force(history)
    rows = got.collect()
    assert len(rows) == len(history)
    for r in rows:
        mine = tuple(r[f] for f in FEATURES)
        assert mine == pytest.approx(expected[r["row"]]), (r, expected[r["row"]])


def test_invariants(spark, history):
    df = spark.createDataFrame(history, SCHEMA)
    got = customer_profile(df, names=NAMES)
    broken = got.where("daily_count < 1 OR weekly_count < daily_count OR max_24h < amount")
    assert broken.count() == 0


def test_only_the_wanted_features(spark, history):
    df = spark.createDataFrame(history, SCHEMA)
    for hot_rows in (10_000, 0):
        got = customer_profile(df, ("max_24h",), NAMES, hot_rows)
        assert got.columns == [*df.columns, "max_24h"]
    with pytest.raises(ValueError):
        customer_profile(df, ("median",), NAMES)


def test_zoned_timestamps_give_the_same(spark, history):
    df = spark.createDataFrame(history, SCHEMA)
    zoned = df.withColumn("ts", F.col("ts").cast("timestamp"))
    a = customer_profile(df, names=NAMES).drop("ts")
    b = customer_profile(zoned, names=NAMES).drop("ts")
    assert a.exceptAll(b).count() == 0


def test_new_merchant(spark, history):
    df = spark.createDataFrame(history, SCHEMA)
    got = {r["row"]: r["is_new_merchant"] for r in behaviour.new_merchant(df, NAMES).collect()}
    for r in history:
        earlier = [o for o in history if o[1] == r[1] and o[2] == r[2] and o[3] < r[3]]
        assert got[r[0]] == ("No" if earlier else "Yes")


def test_international(spark):
    places = spark.createDataFrame([("Oslo", "NO"), ("Bergen", "NO"), ("Rome", "IT")], "place string, country string")
    trips = [("Oslo", "Rome"), ("Oslo", "Bergen"), ("Oslo", "Atlantis"), (None, "Rome")]
    df = spark.createDataFrame(trips, "home string, away string")
    got = behaviour.international(df, places, "home", "away")
    assert [r[2] for r in got.collect()] == ["Yes", "No", None, None]
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()


def test_unusual_time(spark):
    df = spark.createDataFrame([("23:10",), ("05:59",), ("06:00",), ("x",), (None,)], "transaction_time string")
    assert [r[1] for r in behaviour.unusual_time(df).collect()] == ["Yes", "Yes", "No", "No", "No"]


@pytest.mark.parametrize("hot_rows", [100, 0])
def test_odd_amounts(spark, hot_rows):
    """NaN and infinite amounts make the mean so, huge ones are exact, whatever the order of the rows."""
    nan, inf = float("nan"), float("inf")
    amounts = {
        1.0: [2.0, nan, 4.0],
        2.0: [1e15, 0.1, -1e15, 1.0],
        3.0: [1.0, inf, -inf],
        4.0: [1e27, 3.0, -1e27],
        5.0: [1.0, 1e28, 5.0],
        6.0: [None, -2.0, None],
        7.0: [12345678901234567.25, 0.75],
    }
    rows = [(i, c, 1, START + dt.timedelta(minutes=i), a, "buy", None) for c, v in amounts.items() for i, a in enumerate(v)]
    got = customer_profile(spark.createDataFrame(rows, SCHEMA).repartition(4), ("avg_amount",), NAMES, hot_rows)
    found = {c: [r["avg_amount"] for r in got.where(F.col("customer_id") == c).orderBy("ts").collect()] for c in amounts}
    expected = {
        1.0: [2.0, nan, nan],
        2.0: [1e15, 1e15 / 2, 0.1 / 3, 1.1 / 4],
        3.0: [1.0, inf, nan],
        4.0: [1e27, 5e26, 1.0],
        5.0: [1.0, inf, inf],
        6.0: [None, -2.0, -2.0],
        7.0: [12345678901234567.25, 12345678901234568.0 / 2],
    }
    for c, values in expected.items():
        for a, b in zip(found[c], values, strict=True):
            assert (a is None and b is None) or np.isclose(a, b, rtol=1e-15, equal_nan=True), (c, found[c])
