import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.operators.behaviour import HOT_ROWS, HistoryColumns, customer_profile
from tallyguard.sources import files
from tallyguard.sources.schemas import BRONZE_SCHEMA, TOPIC_SCHEMA
from tallyguard.sources.topic import to_bronze
from tallyguard.streaming import dedupe, generations, ingest, profile, score, summary

START = dt.datetime(2024, 3, 1)


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def put(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def message(offset, minutes, key="1.0", **fields):
    value = json.dumps({"transaction_id": float(key), **fields}).encode()
    return (bytearray(key.encode()), bytearray(value), 0, offset, at(minutes))


def run(stream, path, checkpoint):
    ingest.append_files(stream, path, checkpoint, available_now=True).awaitTermination()


def test_restart_adds_only_what_is_new(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("topic", "bronze", "mark"))
    put(spark, source, [message(1, 0), message(2, 1)], TOPIC_SCHEMA)
    for expected in (2, 2):
        ingest.write_bronze(to_bronze(ingest.replay_topic(spark, source)), sink, mark, available_now=True).awaitTermination()
        assert files.read_bronze(spark, sink).count() == expected
    put(spark, source, [message(3, 2)], TOPIC_SCHEMA)
    ingest.write_bronze(to_bronze(ingest.replay_topic(spark, source)), sink, mark, available_now=True).awaitTermination()
    stored = files.read_bronze(spark, sink)
    assert sorted(r["kafka_offset"] for r in stored.collect()) == [1, 2, 3]
    assert stored.schema == BRONZE_SCHEMA


def deduped(spark, source, sink, mark):
    stream = to_bronze(ingest.replay_topic(spark, source))
    dedupe.dedupe_into(stream, sink, mark, available_now=True).awaitTermination()
    return sorted(r["kafka_offset"] for r in spark.read.parquet(sink).collect())


def test_dedupe_within_a_batch(spark, tmp_path):
    source = str(tmp_path / "topic")
    copies = [message(i, 0, amount=1) for i in range(40)] + [message(40, 0, amount=2), message(41, 1, "2.0", amount=1)]
    put(spark, source, copies, TOPIC_SCHEMA)
    assert deduped(spark, source, str(tmp_path / "out"), str(tmp_path / "mark")) == [0, 40, 41]
    batch = dedupe.dedupe_messages(to_bronze(spark.read.parquet(source)))
    assert sorted(r["kafka_offset"] for r in batch.collect()) == [0, 40, 41]


def test_dedupe_keeps_late_messages_that_have_no_copy(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("topic", "out", "mark"))
    day = 1440
    batches = [
        [message(5, 10 * day, amount=1), (None, None, 0, 50, at(0))],
        [message(6, 20 * day, amount=1), message(7, 20 * day, amount=2), (None, None, 0, 51, at(1))],
        [message(8, 0, amount=3), message(9, 0, amount=2), message(10, 1, "2.0", amount=1)],
    ]
    for batch, wanted in zip(batches, ([5, 50], [5, 7, 50], [5, 7, 8, 10, 50])):
        put(spark, source, batch, TOPIC_SCHEMA)
        assert deduped(spark, source, sink, mark) == wanted


def test_dedupe_opens_only_folders_that_may_hold_a_copy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dedupe, "SEGMENT", 8)
    source, sink, mark = (str(tmp_path / n) for n in ("topic", "out", "mark"))
    asked = []
    real = dedupe.folders_to_open
    monkeypatch.setattr(dedupe, "folders_to_open", lambda *a: asked.append(real(*a)) or asked[-1])
    batches = [[message(100 * b + i, b, f"{b}.0", amount=i) for i in range(40)] for b in range(4)]
    batches += [[message(900, 9, "2.0", amount=7), message(901, 9, "9.0", amount=1), message(902, 9, "0.0", amount=39)]]
    for batch in batches:
        put(spark, source, batch, TOPIC_SCHEMA)
        kept = deduped(spark, source, sink, mark)
    assert asked == [[], [], [], [], [0, 2]]
    assert len(kept) == 161 and 901 in kept and 900 not in kept and 902 not in kept


def test_dedupe_of_a_backlog_and_of_a_repeated_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(dedupe, "MOST_SOUGHT", 2)
    source, sink, mark = (str(tmp_path / n) for n in ("topic", "out", "mark"))
    put(spark, source, [message(i, 0, amount=i) for i in range(5)], TOPIC_SCHEMA)
    assert deduped(spark, source, sink, mark) == [0, 1, 2, 3, 4]
    put(spark, source, [message(10 + i, 0, amount=i) for i in range(3, 8)], TOPIC_SCHEMA)
    assert deduped(spark, source, sink, mark) == [0, 1, 2, 3, 4, 15, 16, 17]
    for name in ("1", ".1.crc"):
        (tmp_path / "mark" / "commits" / name).unlink(missing_ok=True)
    assert deduped(spark, source, sink, mark) == [0, 1, 2, 3, 4, 15, 16, 17]


def test_filters_hold_what_was_put_in_and_little_else():
    rng = np.random.default_rng(1)
    known, others = (rng.integers(0, 2**64, 20_000, dtype="uint64") for _ in range(2))
    bits = dedupe.made_filter(known)
    assert len(dedupe.may_hold(bits, known)) == 20_000
    assert len(dedupe.may_hold(bits, others)) <= 2
    assert len(dedupe.may_hold(dedupe.made_filter(known[:0]), others)) == 0


def test_windows_are_revised_by_late_rows(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("rows", "out", "mark"))
    schema = "ts timestamp, fraud_label string, amount double"
    day = 1440
    batches = [
        [(at(0), "Fraud", 2.0), (at(5), "Normal", None), (at(day + 10), None, 7.0)],
        [(at(3 * day), "Normal", 1.0), (None, "Fraud", 1.0)],
        [(at(6), "Fraud", 100.0), (at(3 * day + 5), "Fraud", 3.0)],
        [(at(5 * day), "Normal", 1.0)],
    ]
    for batch in batches:
        put(spark, source, batch, schema)
        stream = spark.readStream.schema(schema).parquet(source)
        summary.summary_into(stream, sink, mark, "ts", amount="amount", available_now=True).awaitTermination()
    got = {r["window_start"]: tuple(r)[2:] for r in summary.read_summary(spark, sink).collect()}
    assert got == {
        at(0): (3, 2, 51.0),
        at(day): (1, 0, 7.0),
        at(3 * day): (2, 1, 2.0),
        at(5 * day): (1, 0, 1.0),
    }


def test_odd_amounts_in_windows(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("rows", "out", "mark"))
    schema = "ts timestamp, fraud_label string, amount double"
    nan, inf, day = float("nan"), float("inf"), 1440
    batches = [
        [(at(0), "Fraud", 2.0), (at(day), "x", 1e20), (at(2 * day), "x", inf), (at(3 * day), "x", 1.0)],
        [(at(1), "Fraud", nan), (at(day + 1), "x", 4.0), (at(day + 2), "x", -1e20), (at(2 * day), "x", 1.0)],
        [(at(2), "Fraud", 4.0), (at(3 * day), "x", -1e30)],
    ]
    for batch in batches:
        put(spark, source, batch, schema)
        stream = spark.readStream.schema(schema).parquet(source)
        summary.summary_into(stream, sink, mark, "ts", amount="amount", available_now=True).awaitTermination()
    got = {r["window_start"]: r["avg_amount_million"] for r in summary.read_summary(spark, sink).collect()}
    assert str(got.pop(at(0))) == "nan"
    assert got == {at(day): 4.0 / 3, at(2 * day): inf, at(3 * day): -inf}


def test_event_time(spark):
    df = spark.createDataFrame([("2025-01-02", "9:05"), ("n/a", "9:05"), ("2025-01-02", None)], "d string, t string")
    got = [r[0] for r in df.select(summary.event_time(F.col("d"), F.col("t"))).collect()]
    assert got == [dt.datetime(2025, 1, 2, 9, 5), None, None]


def test_ndjson_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.ndjson").write_text('{"transaction_id":7.0}\n\nbad\n')
    good, _ = files.ingest_ndjson(spark, str(tmp_path / "in"), streaming=True)
    run(good, str(tmp_path / "out"), str(tmp_path / "mark"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("7.0", '{"transaction_id":7.0}')]


def test_profile_over_several_batches_equals_the_table(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("rows", "out", "mark"))
    schema = "row int, customer_id double, ts timestamp_ntz, amount double, event_type string, fraud_label string"
    rows = [
        (i, float(i % 3), at(i * 97), float((i * 37) % 50), "error" if i % 4 == 0 else "buy", "Normal")
        for i in range(120)
    ]
    wanted = ("daily_count", "max_24h", "failed_count", "weekly_count")
    for start in range(0, 120, 30):
        put(spark, source, rows[start : start + 30], schema)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        profile.profile_stream(stream, sink, mark, wanted, available_now=True).awaitTermination()
    got = profile.read_profile(spark, sink)
    expected = customer_profile(spark.createDataFrame(rows, schema), wanted, HistoryColumns())
    assert got.count() == 120
    assert got.select(*expected.columns).exceptAll(expected).count() == 0


def test_profile_revises_rows_after_late_ones(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("rows", "out", "mark"))
    schema = "row int, customer_id double, ts timestamp, amount double, event_type string, fraud_label string"
    stray = dt.datetime(1970, 1, 5)
    batches = [
        [(1, 1.0, at(0), 5.0, "buy", None), (2, 1.0, at(200), 1.0, "buy", None), (6, 2.0, at(0), 4.0, "buy", None)],
        [(3, 1.0, at(10), 99.0, "buy", None), (4, 1.0, at(1500), 9.0, "buy", None), (7, None, stray, 1.0, "buy", None)],
        [(5, 1.0, at(-60), 200.0, "buy", None), (8, None, at(3), 2.0, "buy", None), (9, 1.0, None, 1.0, "buy", None)],
    ]
    for batch in batches:
        put(spark, source, batch, schema)
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        profile.profile_stream(stream, sink, mark, available_now=True).awaitTermination()
    got = profile.read_profile(spark, sink)
    rows = spark.createDataFrame([r for b in batches for r in b if r[2]], schema)
    expected = customer_profile(rows, ("daily_count", "max_24h"), HistoryColumns())
    assert got.count() == 8 and got.select(*expected.columns).exceptAll(expected).count() == 0


@pytest.mark.parametrize("hot_rows", [HOT_ROWS, 3])
def test_profile_writes_only_what_changes_and_merges_folders(spark, tmp_path, monkeypatch, hot_rows):
    """Batches in order write their own rows; a late row writes those after it; equal rows are one record."""
    monkeypatch.setattr(generations, "FAN_OUT", 2)
    path, mark, source = (str(tmp_path / n) for n in ("out", "mark", "rows"))
    schema = "row int, customer_id double, ts timestamp_ntz, amount double, event_type string, fraud_label string"
    batches = [[(10 * b + i, float(i % 2), at(600 * b + 7 * i), float(i), "buy", None) for i in range(6)] for b in range(3)]
    batches.append([(99, 0.0, at(600 * 2 - 1), 1.0, "buy", None)])
    batches.append([(20, 0.0, at(1200), 0.0, "buy", None)] * 2)
    wanted = ("daily_count", "max_24h")
    written = []
    for number, batch in enumerate(batches):
        put(spark, source, batch, schema)
        stream = spark.readStream.schema(schema).parquet(source)
        profile.profile_stream(stream, path, mark, wanted, hot_rows=hot_rows, available_now=True).awaitTermination()
        folders = generations.current(generations.Store(spark, path))
        assert len(folders) == bin(number + 1).count("1")
        every = spark.read.parquet(*[f"{path}/{f.name}/{generations.PART}=*" for f in folders])
        written.append(every.where(F.col("_batch") == number).count())
        so_far = spark.createDataFrame([r for b in batches[: number + 1] for r in b], schema)
        expected = customer_profile(so_far, wanted, HistoryColumns())
        got = profile.read_profile(spark, path).select(*expected.columns)
        assert got.count() == expected.count() and got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    # In order: six new rows. Late: itself and the three later rows of its customer that day. Copies: the record
    # of the row, and two rows after it.
    assert written == [6, 6, 6, 4, 3]


def test_profile_reads_the_days_it_needs(spark, tmp_path, monkeypatch):
    path, mark, source = (str(tmp_path / n) for n in ("out", "mark", "rows"))
    schema = "row int, customer_id double, ts timestamp_ntz, amount double, event_type string, fraud_label string"
    asked = []
    plain = profile.read_generations
    monkeypatch.setattr(profile, "read_generations", lambda *a, **k: asked.append((k["parts"], plain(*a, **k))) or asked[-1][1])
    for day in (0, 1, 30):
        put(spark, source, [(day, 1.0, at(1440 * day), 1.0, "buy", None)], schema)
        stream = spark.readStream.schema(schema).parquet(source)
        profile.profile_stream(stream, path, mark, available_now=True).awaitTermination()
    parts, frame = asked[-1]
    assert len(parts) == 3 and frame.inputFiles() == []
    assert len(asked[1][1].inputFiles()) == 1


def test_profile_refuses_features_without_a_bound(spark, tmp_path):
    stream = spark.readStream.schema("customer_id double, ts timestamp").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="avg_amount"):
        profile.profile_stream(stream, "out", "mark", ("avg_amount",))


def test_alerts_threshold(spark):
    df = spark.createDataFrame([(0.2,), (0.5,), (0.9,), (None,)], "fraud_probability double")
    assert score.stream_alerts(df).count() == 2 and score.stream_alerts(df, 0.8).count() == 1


def test_a_repeated_profile_batch_changes_nothing(spark, tmp_path):
    """The commit of the last batch is lost, as after a crash; the batch runs again."""
    source, sink = str(tmp_path / "rows"), str(tmp_path / "out")
    mark = tmp_path / "mark"
    schema = "row int, customer_id double, ts timestamp_ntz, amount double, event_type string, fraud_label string"

    def go():
        stream = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        profile.profile_stream(stream, sink, str(mark), available_now=True).awaitTermination()
        return sorted(map(str, profile.read_profile(spark, sink).collect()))

    put(spark, source, [(i, 1.0, at(i * 600), float(i), "buy", None) for i in range(6)], schema)
    go()
    put(spark, source, [(i, 1.0, at(i * 600), float(i), "buy", None) for i in range(6, 9)], schema)
    once = go()
    for name in ("1", ".1.crc"):
        (mark / "commits" / name).unlink(missing_ok=True)
    assert go() == once and len(once) == 9


def test_alerts_are_sent_as_messages(spark, tmp_path):
    source, sink, mark = (str(tmp_path / n) for n in ("scores", "sent", "mark"))
    schema = "transaction_id double, fraud_probability double"
    put(spark, source, [(1.0, 0.9), (2.0, 0.1), (None, 0.7)], schema)
    alerts = score.stream_alerts(spark.readStream.schema(schema).parquet(source))
    score.alerts_to_topic(alerts, lambda m: m.write.mode("append").parquet(sink), mark, available_now=True).awaitTermination()
    sent = {r["key"]: json.loads(r["value"]) for r in spark.read.parquet(sink).collect()}
    assert sent == {"1.0": {"transaction_id": 1.0, "fraud_probability": 0.9}, None: {"transaction_id": None, "fraud_probability": 0.7}}
