"""Jobs on files, with stand-ins for the session and the topic."""

import pytest
from pyspark.sql import functions as F

from tallyguard.jobs import maintain, publish
from tallyguard.jobs import profile as profile_job
from tallyguard.operators.behaviour import customer_profile
from tallyguard.sources.schemas import CORRELATED_COLUMNS, RATE_COLUMNS, TRANSACTION_SCHEMA
from tallyguard.streaming.profile import REACH, read_profile
from tallyguard.streaming.summary import read_summary


class Kept:
    """A session that a job may stop without ending the tests."""

    def __init__(self, spark):
        self.spark = spark

    def __getattr__(self, name):
        return getattr(self.spark, name)

    def stop(self):
        pass


@pytest.fixture
def rows(spark):
    base = spark.range(200).select(
        *[
            (F.lit(None) if f.name == "ip_address" else (F.col("id") * (i + 1) % 17).cast(f.dataType)).cast(f.dataType).alias(f.name)
            for i, f in enumerate(TRANSACTION_SCHEMA)
        ]
    )
    label = F.when(F.col("customer_id") > 8, "Fraud").otherwise("Normal")
    return base.withColumns({"fraud_label": label, "transaction_date": F.lit("2025-01-31")})


def test_rows_of_a_table_are_published(spark, rows, monkeypatch, tmp_path):
    rows.write.parquet(str(tmp_path / "table"))
    sent = []
    monkeypatch.setattr(publish, "build_session", lambda name: Kept(spark))
    monkeypatch.setattr(publish, "write_topic", lambda messages, servers, topic: sent.extend(messages.collect()))
    publish.main([str(tmp_path / "table"), "--table"])
    assert len(sent) == 200 and all(m["value"].startswith('{"transaction_id":') for m in sent)


def test_profile_tables_are_written(spark, rows, monkeypatch, tmp_path):
    monkeypatch.setattr(profile_job, "build_session", lambda name: Kept(spark))
    monkeypatch.setattr(profile_job, "read_transactions_csv", lambda session, path: rows)
    profile_job.main(["some.csv", str(tmp_path / "out")])
    tables = {p.name: spark.read.parquet(str(p)) for p in (tmp_path / "out").iterdir()}
    assert len(tables) == 11
    assert tables["correlations"].count() == len(CORRELATED_COLUMNS) ** 2
    assert {r["column"] for r in tables["rates"].select("column").distinct().collect()} == set(RATE_COLUMNS)
    assert tables["labels"].agg(F.sum("n")).first()[0] == 200


def test_kept_tables_follow_the_bronze_table(spark, rows, monkeypatch, tmp_path):
    """Two runs, the second after new messages and copies of old ones: all three tables hold what one pass gives."""
    hour = F.format_string("%02d:00", (F.col("transaction_id") % 24).cast("int"))
    body = rows.withColumns({"transaction_time": hour, "transaction_type": F.lit("error"), "fraud_label": F.lit("Fraud")})
    key = F.monotonically_increasing_id()
    bronze = body.select(
        F.lit("2025-01-31").cast("timestamp").alias("kafka_ts"), F.lit(0).alias("kafka_partition"), key.alias("kafka_offset"),
        key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("raw_json"),
    )
    whole, folder = spark.createDataFrame(bronze.collect(), bronze.schema), str(tmp_path / "kept")
    monkeypatch.setattr(maintain, "build_session", lambda name: Kept(spark))
    monkeypatch.setattr(maintain, "run_until_stopped", lambda spark, *queries: None)
    job = [folder, "--bronze-path", str(tmp_path / "bronze"), "--checkpoint", str(tmp_path / "marks"), "--once"]
    edge = whole.select(F.expr("percentile(kafka_offset, 0.5)")).first()[0]
    for part in (whole.where(F.col("kafka_offset") <= edge), whole):
        part.write.mode("append").parquet(str(tmp_path / "bronze"))
        maintain.main(job)
    written = spark.read.parquet(f"{folder}/messages/batch=*")
    assert sorted(r[0] for r in written.select("key").collect()) == sorted(r["key"] for r in whole.collect())
    every = spark.read.parquet(str(tmp_path / "bronze"))
    timed = maintain.timed(every).where("ts IS NOT NULL")
    counts = read_summary(spark, f"{folder}/summary").first()
    assert (counts["transaction_count"], counts["fraud_count"]) == (timed.count(), timed.count())
    names = ["transaction_id", "customer_id", "ts", *REACH]
    wanted = customer_profile(timed, tuple(REACH), maintain.MESSAGES).select(*names)
    found = read_profile(spark, f"{folder}/profile").select(*names)
    assert found.count() == wanted.count() and found.exceptAll(wanted).isEmpty()
