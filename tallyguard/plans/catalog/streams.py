"""Streams, replayed from files to the end and compared with the batch result."""

from __future__ import annotations

from dataclasses import fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.operators.parse import PERMISSIVE, filter_transactions, parse_transactions
from tallyguard.plans.catalog.io import BRONZE_ROWS_SQL, bronze_rows, stored_bronze
from tallyguard.plans.catalog.learning import MESSAGE_PLANTED_SQL, message_training, one_model
from tallyguard.plans.registry import query, r6, rounded, stamp
from tallyguard.plans.tables import BRONZE_SQL, TXN_HISTORY, TXN_SQL, Tables
from tallyguard.session import stage
from tallyguard.sources.schemas import TRANSACTION_SCHEMA
from tallyguard.sources.topic import to_bronze
from tallyguard.streaming import dedupe, ingest, profile, score, summary
from tallyguard.streaming.history import MessageColumns


def drained(tables: Tables, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there and read what it wrote."""
    path = tables.scratch(name)
    ingest.append_files(stream, path, tables.scratch("checkpoint"), available_now=True).awaitTermination()
    return tables.spark.read.schema(stream.schema).parquet(path)


def message_stream(tables: Tables) -> DataFrame:
    return to_bronze(ingest.replay_topic(tables.spark, tables.messages_folder()))


@query("stream_ingest", BRONZE_ROWS_SQL)
def stream_ingest(tables: Tables) -> DataFrame:
    """The bronze table written by the stream, read again as a stream."""
    path, checkpoint = tables.scratch("bronze"), tables.scratch("checkpoint")
    ingest.write_bronze(message_stream(tables), path, checkpoint, available_now=True).awaitTermination()
    return bronze_rows(drained(tables, ingest.bronze_stream(tables.spark, path), "copy"))


def late_halves(rows: DataFrame, ts: str) -> tuple[DataFrame, DataFrame]:
    """The newer rows and one old row in ten, then the rest of the older rows: late by far, and copies of both."""
    middle = rows.agg(F.avg(F.unix_timestamp(F.col(ts).cast("timestamp")))).first()[0]
    first = (F.unix_timestamp(F.col(ts).cast("timestamp")) >= middle) | (F.unix_timestamp(F.col(ts).cast("timestamp")) % 10 == 0)
    return rows.where(first), rows.where(~first)


DEDUPED_SQL = f"""WITH {BRONZE_SQL}
SELECT DISTINCT key, kafka_partition, kafka_offset, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_ts, fraud_label AS json_label
FROM bronze WHERE is_txn = 1"""


def deduped_rows(bronze: DataFrame) -> DataFrame:
    return bronze.where("key IS NOT NULL").select(
        "key",
        "kafka_partition",
        "kafka_offset",
        stamp("kafka_ts").alias("kafka_ts"),
        F.get_json_object("raw_json", "$.fraud_label").alias("json_label"),
    )


@query("stream_dedupe", DEDUPED_SQL)
def stream_dedupe(tables: Tables) -> DataFrame:
    """Two replays: the second starts with the oldest messages, days late by then."""
    path, checkpoint, topic = tables.scratch("unique"), tables.scratch("checkpoint"), tables.scratch("topic")
    for part in late_halves(tables.messages(), "timestamp"):
        part.write.mode("append").parquet(topic)
        stream = to_bronze(ingest.replay_topic(tables.spark, topic))
        dedupe.dedupe_into(stream, path, checkpoint, available_now=True).awaitTermination()
    return deduped_rows(tables.spark.read.parquet(path))


@query("stream_dedupe_batch", DEDUPED_SQL)
def stream_dedupe_batch(tables: Tables) -> DataFrame:
    return deduped_rows(dedupe.dedupe_messages(stored_bronze(tables)))


def scored_stream(tables: Tables) -> tuple[DataFrame, DataFrame]:
    """The same transactions scored as a stream and as a table."""
    model = one_model(message_training(tables))
    messages = tables.messages_folder()

    def scores(bronze: DataFrame) -> DataFrame:
        rows = parse_transactions(filter_transactions(bronze)).withColumn("planted_sign", F.expr(MESSAGE_PLANTED_SQL))
        return score.stream_score(model, rows).select(
            "transaction_id", "transaction_amount_million", "fraud_probability", "predicted"
        )

    live = scores(to_bronze(ingest.replay_topic(tables.spark, messages)))
    table = scores(to_bronze(tables.spark.read.parquet(messages)))
    return live, table


def agreement(live: DataFrame, table: DataFrame) -> DataFrame:
    """One row: rows of the stream, and rows of the table that the stream lacks."""
    columns = ["transaction_id", "fraud_probability", "predicted"]
    counted = [
        side.groupBy(*columns).agg(F.count("*").alias("n")) for side in (live, table)
    ]
    missing = counted[1].exceptAll(counted[0]).agg(F.count("*")).scalar()
    return live.agg(F.count("*").alias("n_rows")).select("n_rows", missing.alias("n_missing"))


@query(
    "stream_score",
    f"WITH {BRONZE_SQL} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_missing FROM bronze WHERE is_txn = 1",
)
def stream_score(tables: Tables) -> DataFrame:
    live, table = scored_stream(tables)
    return agreement(drained(tables, live, "scores"), table)


HISTORY_WINDOWS = "PARTITION BY customer_id ORDER BY ts RANGE BETWEEN"
TO_DATE = f"{HISTORY_WINDOWS} UNBOUNDED PRECEDING AND CURRENT ROW"


@query(
    "stream_score_history",
    f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id,
       count(*) OVER (PARTITION BY customer_id, CAST(ts AS DATE) ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS daily_transaction_count,
       count(*) OVER ({HISTORY_WINDOWS} INTERVAL 168 HOURS PRECEDING AND CURRENT ROW) AS weekly_transaction_count,
       round(avg(amount) OVER ({TO_DATE}) + 1e-9, 6) + 0.0 AS avg_transaction_amount_million,
       round(max(amount) OVER ({HISTORY_WINDOWS} INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) + 1e-9, 6) + 0.0 AS max_transaction_last_24h_million,
       count(*) FILTER (trim(transaction_type) = 'error') OVER ({HISTORY_WINDOWS} INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS failed_transaction_count,
       count(*) FILTER (lower(trim(fraud_label)) = 'fraud') OVER ({TO_DATE})
         - count(*) FILTER (lower(trim(fraud_label)) = 'fraud') OVER (PARTITION BY customer_id, ts) AS previous_fraud_count,
       CASE WHEN ts = min(ts) OVER (PARTITION BY customer_id, merchant_id) THEN 'Yes' ELSE 'No' END AS is_new_merchant,
       1 AS in_range
FROM txn""",
)
def stream_score_history(tables: Tables) -> DataFrame:
    """Scores of messages that come in the order of time, four batches, with the history that was written before."""
    model = one_model(message_training(tables))
    state, checkpoint, path, source = (tables.scratch(n) for n in ("state", "checkpoint", "scores", "arrived"))
    message = F.from_json("raw_json", TRANSACTION_SCHEMA, PERMISSIVE).alias("t")
    parsed = filter_transactions(to_bronze(tables.messages())).select(F.col("kafka_ts").alias("ts"), message)
    rows = stage(parsed.select("ts", "t.*").withColumn("planted_sign", F.expr(MESSAGE_PLANTED_SQL)), "messages")
    day = F.to_date("ts")
    first, last = rows.agg(F.min(day), F.max(day)).first()
    edges = [first + (last - first) * k / 4 for k in range(1, 4)]
    quarter = sum((F.when(day > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    names = replace(TXN_HISTORY, amount="transaction_amount_million")
    for k in range(4):
        rows.where(quarter == k).write.mode("append").parquet(source)
        stream = tables.spark.readStream.schema(rows.schema).parquet(source)
        score.score_into(model, stream, path, state, checkpoint, names, available_now=True).awaitTermination()
    scored = tables.spark.read.parquet(path)
    history = [f.name for f in fields(MessageColumns)]
    out = rounded(scored, "avg_transaction_amount_million", "max_transaction_last_24h_million")
    in_range = F.coalesce(F.col("fraud_probability").between(0, 1), F.lit(False)).cast("int").alias("in_range")
    return out.select("transaction_id", "customer_id", *[getattr(MessageColumns(), n) for n in history], in_range)


@query(
    "stream_alerts",
    "SELECT CAST(0 AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_extra, CAST(0 AS BIGINT) AS n_below, 1 AS some",
)
def stream_alerts(tables: Tables) -> DataFrame:
    """Alerts of the stream against the rows of the table at or above the threshold, in both directions."""
    live, table = scored_stream(tables)
    threshold = table.agg(F.percentile_approx("fraud_probability", 0.9)).first()[0]
    alerts = stage(drained(tables, score.stream_alerts(live, threshold), "alerts"), "alerts")
    wanted = stage(table.where(F.col("fraud_probability") >= threshold), "wanted")
    columns = ["transaction_id", "fraud_probability", "predicted"]
    counted = [x.groupBy(*columns).agg(F.count("*").alias("n")) for x in (alerts, wanted)]
    return alerts.agg(
        counted[1].exceptAll(counted[0]).agg(F.count("*")).scalar().alias("n_missing"),
        counted[0].exceptAll(counted[1]).agg(F.count("*")).scalar().alias("n_extra"),
        F.count_if(F.col("fraud_probability") < threshold).alias("n_below"),
        (F.count("*") > 0).cast("int").alias("some"),
    )


@query(
    "stream_summary",
    f"""WITH {TXN_SQL},
w AS (SELECT date_trunc('day', ts) AS start, fraud_label, amount FROM txn)
SELECT strftime(start, '%Y-%m-%d') AS day, count(*) AS transaction_count,
       CAST(sum(CASE WHEN fraud_label = 'Fraud' THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
       round(avg(amount) + 1e-9, 6) + 0.0 AS avg_amount_million
FROM w GROUP BY start""",
)
def stream_summary(tables: Tables) -> DataFrame:
    """Daily windows over all rows, half of which come late."""
    path, checkpoint = tables.scratch("summary"), tables.scratch("checkpoint")
    replayed_in_two(
        tables,
        lambda stream: summary.summary_into(stream, path, checkpoint, "ts", amount="amount", available_now=True),
    )
    days = summary.read_summary(tables.spark, path)
    days = days.withColumn("day", F.date_format("window_start", "yyyy-MM-dd")).drop("window_start", "window_end")
    return rounded(days, "avg_amount_million")


def replayed_in_two(tables: Tables, run) -> None:
    """Write the newer part of the transactions, run, write the older part, run again."""
    rows = tables.transactions()
    path = tables.scratch("transactions")
    for part in late_halves(rows, "ts"):
        part.write.mode("append").parquet(path)
        run(tables.spark.readStream.schema(rows.schema).parquet(path)).awaitTermination()


@query(
    "prof_stream",
    f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id,
       count(*) OVER (PARTITION BY customer_id, CAST(ts AS DATE) ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS daily_count,
       round(max(amount) OVER (PARTITION BY customer_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) + 1e-9, 6) + 0.0 AS max_24h
FROM txn""",
)
def prof_stream(tables: Tables) -> DataFrame:
    path, checkpoint = tables.scratch("profile"), tables.scratch("checkpoint")
    replayed_in_two(
        tables,
        lambda stream: profile.profile_stream(
            stream, path, checkpoint, ("daily_count", "max_24h"), TXN_HISTORY, available_now=True
        ),
    )
    written = profile.read_profile(tables.spark, path)
    return written.select("transaction_id", "customer_id", "daily_count", r6("max_24h").alias("max_24h"))


@query(
    "prof_stream_daily",
    f"""WITH {TXN_SQL}
SELECT customer_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM txn GROUP BY 1, 2""",
)
def prof_stream_daily(tables: Tables) -> DataFrame:
    path, checkpoint = tables.scratch("daily"), tables.scratch("checkpoint")
    replayed_in_two(tables, lambda stream: profile.daily_counts_into(stream, path, checkpoint, available_now=True))
    return profile.read_daily_counts(tables.spark, path).withColumn("day", F.col("day").cast("string"))
