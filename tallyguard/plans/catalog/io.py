"""Sources and sinks. The topic is replayed from files, since no broker is at hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.plans.flows import bronze_to_gold
from tallyguard.plans.registry import query, r6, stamp
from tallyguard.plans.tables import BRONZE_SQL, TXN_SQL, Tables
from tallyguard.sources import files, topic
from tallyguard.sources.schemas import BRONZE_SCHEMA, TOPIC_SCHEMA
from tallyguard.streaming.ingest import export_topic_stream, replay_topic, write_bronze

BRONZE_ROWS_SQL = f"""WITH {BRONZE_SQL}
SELECT kafka_partition, kafka_offset, key, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS kafka_ts,
       CAST(transaction_id AS VARCHAR) AS json_id, fraud_label AS json_label, CAST(amount AS VARCHAR) AS json_amount
FROM bronze"""


def bronze_rows(bronze: DataFrame) -> DataFrame:
    return bronze.select(
        "kafka_partition",
        "kafka_offset",
        "key",
        stamp("kafka_ts").alias("kafka_ts"),
        F.get_json_object("raw_json", "$.transaction_id").alias("json_id"),
        F.get_json_object("raw_json", "$.fraud_label").alias("json_label"),
        F.get_json_object("raw_json", "$.transaction_amount_million").alias("json_amount"),
    )


def stored_bronze(tables: Tables) -> DataFrame:
    """The bronze table as the stream writes it."""
    path, checkpoint = tables.scratch("bronze"), tables.scratch("checkpoint")
    messages = tables.messages_folder()
    stream = topic.to_bronze(replay_topic(tables.spark, messages))
    write_bronze(stream, path, checkpoint, available_now=True).awaitTermination()
    return tables.spark.read.schema(BRONZE_SCHEMA).parquet(path)


@query("src_topic_stream", BRONZE_ROWS_SQL)
def src_topic_stream(tables: Tables) -> DataFrame:
    return bronze_rows(stored_bronze(tables))


@query("src_topic_batch", BRONZE_ROWS_SQL)
def src_topic_batch(tables: Tables) -> DataFrame:
    stored = tables.spark.read.schema(TOPIC_SCHEMA).parquet(tables.messages_folder())
    return bronze_rows(topic.to_bronze(stored))


@query("bronze_project", BRONZE_ROWS_SQL)
def bronze_project(tables: Tables) -> DataFrame:
    return bronze_rows(topic.to_bronze(tables.messages()))


@query(
    "sink_bronze_stream",
    f"""WITH {BRONZE_SQL}
SELECT kafka_partition, count(*) AS n, count(key) AS n_keys, CAST(sum(kafka_offset) AS BIGINT) AS offset_sum
FROM bronze GROUP BY kafka_partition""",
)
def sink_bronze_stream(tables: Tables) -> DataFrame:
    """Two runs with the same checkpoint; the second one adds nothing."""
    path, checkpoint = tables.scratch("bronze"), tables.scratch("checkpoint")
    messages = tables.messages_folder()
    for _ in range(2):
        stream = topic.to_bronze(replay_topic(tables.spark, messages))
        write_bronze(stream, path, checkpoint, available_now=True).awaitTermination()
    stored = tables.spark.read.schema(BRONZE_SCHEMA).parquet(path)
    return stored.groupBy("kafka_partition").agg(
        F.count("*").alias("n"), F.count("key").alias("n_keys"), F.sum("kafka_offset").alias("offset_sum")
    )


@query("src_bronze", BRONZE_ROWS_SQL)
def src_bronze(tables: Tables) -> DataFrame:
    """Bronze is absent here, so the topic takes its place."""
    return bronze_rows(
        files.read_bronze(
            tables.spark, tables.scratch("absent"), fallback=lambda: topic.to_bronze(tables.messages())
        )
    )


@query(
    "sink_gold",
    f"""WITH {BRONZE_SQL}
SELECT count(*) AS transaction_count, CAST(sum(CASE WHEN fraud_label = 'Fraud' THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
       round(avg(amount) + 1e-9, 6) + 0.0 AS avg_amount_million
FROM bronze WHERE is_txn = 1""",
)
def sink_gold(tables: Tables) -> DataFrame:
    """Written twice; the second run replaces the first."""
    path = tables.scratch("gold")
    summary = bronze_to_gold(topic.to_bronze(tables.messages()))
    files.write_gold(summary, path)
    return files.write_gold(summary, path).withColumn("avg_amount_million", r6("avg_amount_million"))


CSV_SQL = f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id, round(amount + 1e-9, 6) + 0.0 AS transaction_amount_million, transaction_time,
       CASE WHEN transaction_date <> 'n/a' THEN transaction_date END AS transaction_date,
       transaction_type, merchant_id, is_new_merchant, fraud_label
FROM txn"""


def exported_csv(tables: Tables) -> str:
    path = tables.scratch("csv")
    rows = tables.transactions().select(
        F.col("transaction_id").alias("Transaction_ID"),
        F.col("customer_id").alias("Customer_ID"),
        F.col("amount").alias("Transaction_Amount (in Million)"),
        F.col("transaction_time").alias("Transaction_Time"),
        F.col("transaction_date").alias("Transaction_Date"),
        F.col("transaction_type").alias("Transaction_Type"),
        F.col("merchant_id").alias("Merchant_ID"),
        F.col("is_new_merchant").alias("Is_New_Merchant"),
        F.col("fraud_label").alias("Fraud_Label"),
    )
    files.write_csv(rows, path)
    return path


@query("src_csv", CSV_SQL)
def src_csv(tables: Tables) -> DataFrame:
    rows = files.read_transactions_csv(tables.spark, exported_csv(tables))
    return rows.withColumn("transaction_amount_million", r6("transaction_amount_million"))


@query(
    "sink_csv",
    f"""WITH {TXN_SQL}
SELECT CAST(transaction_id AS VARCHAR) AS id, CAST(amount AS VARCHAR) AS amount, transaction_type AS kind FROM txn""",
)
def sink_csv(tables: Tables) -> DataFrame:
    """The texts in the exported files."""
    raw = tables.spark.read.option("header", True).csv(exported_csv(tables))
    return raw.select(
        F.col("Transaction_ID").alias("id"),
        F.col("`Transaction_Amount (in Million)`").alias("amount"),
        F.col("Transaction_Type").alias("kind"),
    )


NDJSON_SQL = f"""WITH {BRONZE_SQL}
SELECT CAST(transaction_id AS VARCHAR) AS json_id, fraud_label AS json_label, CAST(amount AS VARCHAR) AS json_amount
FROM bronze"""


def ndjson_rows(lines: DataFrame, column: str) -> DataFrame:
    return lines.select(
        F.get_json_object(column, "$.transaction_id").alias("json_id"),
        F.get_json_object(column, "$.fraud_label").alias("json_label"),
        F.get_json_object(column, "$.transaction_amount_million").alias("json_amount"),
    )


@query("export_topic_ndjson", NDJSON_SQL)
def export_topic_ndjson(tables: Tables) -> DataFrame:
    """Exported as a stream, twice with the same position, so that the second run adds nothing."""
    path, checkpoint = tables.scratch("ndjson"), tables.scratch("checkpoint")
    messages = tables.messages_folder()
    for _ in range(2):
        bronze = topic.to_bronze(replay_topic(tables.spark, messages))
        export_topic_stream(bronze, path, checkpoint, available_now=True).awaitTermination()
    return ndjson_rows(tables.spark.read.text(path), "value")


@query(
    "ingest_ndjson",
    f"""WITH {TXN_SQL}
SELECT CAST(transaction_id AS VARCHAR) AS key, CAST(transaction_id AS VARCHAR) AS json_id, fraud_label AS json_label,
       CAST(amount AS VARCHAR) AS json_amount
FROM txn UNION ALL SELECT NULL, NULL, NULL, NULL FROM events WHERE event_type = 'signup'""",
)
def ingest_ndjson(tables: Tables) -> DataFrame:
    path = tables.scratch("ndjson")
    files.export_topic(topic.to_bronze(tables.messages()), path)
    good, _ = files.ingest_ndjson(tables.spark, path)
    return good.select(
        "key",
        F.get_json_object("value", "$.transaction_id").alias("json_id"),
        F.get_json_object("value", "$.fraud_label").alias("json_label"),
        F.get_json_object("value", "$.transaction_amount_million").alias("json_amount"),
    )


@query(
    "publish_topic",
    f"""WITH {TXN_SQL}
SELECT CAST(transaction_id AS VARCHAR) AS key,
       CAST(to_json({{'transaction_id': transaction_id, 'customer_id': customer_id, 'amount': amount,
                      'transaction_type': transaction_type, 'home_city': home_city, 'fraud_label': fraud_label}}) AS VARCHAR)
       AS value
FROM txn""",
)
def publish_topic(tables: Tables) -> DataFrame:
    """What is handed to the topic sink."""
    rows = tables.transactions().select(
        "transaction_id", "customer_id", "amount", "transaction_type", "home_city", "fraud_label"
    )
    return topic.to_messages(rows)
