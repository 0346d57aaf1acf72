import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.operators.behaviour import FEATURES, HistoryColumns, customer_profile, new_merchant
from tallyguard.streaming.history import MessageColumns, enrich_into

NAMES = HistoryColumns(failed="kind = 'error'", fraud="label = 'Fraud'")
OUT = MessageColumns(*FEATURES, "is_new_merchant")
SCHEMA = "row int, customer_id double, merchant_id int, ts timestamp_ntz, amount double, kind string, label string"
START = dt.datetime(2024, 3, 1)


def rows(count, seed):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(count):
        ts = START + dt.timedelta(minutes=int(rng.integers(0, 30 * 1440)), microseconds=int(rng.choice([0, 0, 1])))
        amount = None if rng.random() < 0.1 else float(rng.integers(1, 500)) / 4
        customer = [1.0, 1.0, 2.0, None][rng.integers(4)]
        label = [None, "Fraud", "Normal"][rng.integers(3)]
        out.append((i, customer, int(rng.integers(5)), ts, amount, "error" if rng.random() < 0.3 else "buy", label))
    return out


def run(spark, tmp_path, batches, hot_rows=10**6):
    source, state, mark, sink = (str(tmp_path / n) for n in ("rows", "state", "mark", "out"))

    def use(df, number):
        df.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{sink}/b={number}")

    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(spark.createDataFrame([], SCHEMA).schema).parquet(source)
        enrich_into(stream, use, state, mark, NAMES, OUT, hot_rows, available_now=True).awaitTermination()
    return spark.read.parquet(sink)


COLUMNS = ["row", *FEATURES, "is_new_merchant"]


def expected(spark, data):
    df = customer_profile(spark.createDataFrame(data, SCHEMA), names=NAMES)
    return {r["row"]: tuple(r)[1:] for r in new_merchant(df, NAMES).select(*COLUMNS).collect()}


@pytest.mark.parametrize("hot_rows", [10**6, 20])
def test_rows_in_order_get_the_features_of_the_table(spark, tmp_path, hot_rows):
    data = sorted(rows(300, 1), key=lambda r: r[3])
    cuts = [0, 90, 91, 200, 300]
    # Rows at one instant see each other, so they come in one batch.
    cuts = [0, *[next(k for k in range(c, 301) if k == 300 or data[k][3] > data[k - 1][3]) for c in cuts[1:]]]
    found = run(spark, tmp_path, [data[a:b] for a, b in zip(cuts, cuts[1:])], hot_rows)
    assert {r["row"]: tuple(r)[1:] for r in found.select(*COLUMNS).collect()} == expected(spark, data)


def test_late_rows_see_their_past_and_are_seen_by_what_follows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tallyguard.streaming.generations.FAN_OUT", 2)
    data = rows(240, 2)
    batches = [data[i : i + 60] for i in range(0, 240, 60)]
    found = {r["row"]: tuple(r)[1:] for r in run(spark, tmp_path, batches).select(*COLUMNS).collect()}
    for k, batch in enumerate(batches):
        known = expected(spark, [r for b in batches[: k + 1] for r in b])
        for r in batch:
            assert found[r[0]] == known[r[0]]


def test_a_repeated_batch_and_rows_without_a_time(spark, tmp_path):
    data = [*rows(60, 3), (900, 1.0, 1, None, 5.0, "buy", "Fraud")]
    first = run(spark, tmp_path, [data[:30], data[30:]])
    before = sorted(map(str, first.collect()))
    (odd,) = first.where("row = 900").collect()
    assert [odd[c] for c in (*FEATURES, "is_new_merchant")] == [None] * 7
    for name in ("1", ".1.crc"):
        (tmp_path / "mark" / "commits" / name).unlink(missing_ok=True)
    again = run(spark, tmp_path, [[]])
    rows_again = sorted(map(str, again.where("batch < 2").collect()))
    assert rows_again == before
