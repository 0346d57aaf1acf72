"""Reading from and writing to a message topic, and the bronze envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def topic_options(servers: str, topic: str, starting: str = "earliest", **more: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        **more,
    }


def read_topic_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Unbounded read. ``starting`` counts on the first start only; later the checkpoint decides.

    ``minPartitions`` in ``options`` splits a topic partition that holds most of the messages;
    ``maxOffsetsPerTrigger`` bounds a micro-batch.
    """
    return spark.readStream.format("kafka").options(**topic_options(servers, topic, starting, **options)).load()


def read_topic_batch(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Everything the topic holds now."""
    bounds = topic_options(servers, topic, endingOffsets="latest", **options)
    return spark.read.format("kafka").options(**bounds).load()


def to_bronze(messages: DataFrame) -> DataFrame:
    """Topic record to bronze row; the same for batch and stream."""
    return messages.select(
        F.col("timestamp").alias("kafka_ts"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("raw_json"),
    )


def id_text(df: DataFrame, column: str) -> Column:
    """Text of an id; a whole DOUBLE is written ``123456.0``, without an exponent."""
    value = F.col(column)
    if not isinstance(df.schema[column].dataType, T.DoubleType):
        return value.cast("string")
    whole = (value == F.floor(value)) & (F.abs(value) < 1e16)
    return F.when(whole, F.concat(value.try_cast("bigint").cast("string"), F.lit(".0"))).otherwise(
        value.cast("string")
    )


def to_messages(rows: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows to (key, value): the key is the id as text and may be NULL, the value all columns as JSON."""
    return rows.select(
        id_text(rows, key).alias("key"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send (key, value) rows; every replica acknowledges, three retries."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("kafka.acks", "all")
        .option("kafka.retries", "3")
        .save()
    )
