"""Schemas of the topic, the bronze table, the parsed transaction and the labelled CSV."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TOPIC_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
    ]
)

BRONZE_SCHEMA = StructType(
    [
        StructField("kafka_ts", TimestampType()),
        StructField("kafka_partition", IntegerType()),
        StructField("kafka_offset", LongType()),
        StructField("key", StringType()),
        StructField("raw_json", StringType()),
    ]
)

# The fields of a transaction message. The label comes last; a message may lack it.
TRANSACTION_SCHEMA = StructType(
    [
        StructField("transaction_id", DoubleType()),
        StructField("customer_id", DoubleType()),
        StructField("transaction_amount_million", DoubleType()),
        StructField("transaction_time", StringType()),
        StructField("transaction_date", StringType()),
        StructField("transaction_type", StringType()),
        StructField("merchant_id", DoubleType()),
        StructField("merchant_category", StringType()),
        StructField("transaction_location", StringType()),
        StructField("customer_home_location", StringType()),
        StructField("distance_from_home", DoubleType()),
        StructField("device_id", DoubleType()),
        StructField("ip_address", StringType()),
        StructField("card_type", StringType()),
        StructField("account_balance_million", DoubleType()),
        StructField("daily_transaction_count", DoubleType()),
        StructField("weekly_transaction_count", DoubleType()),
        StructField("avg_transaction_amount_million", DoubleType()),
        StructField("max_transaction_last_24h_million", DoubleType()),
        StructField("is_international_transaction", StringType()),
        StructField("is_new_merchant", StringType()),
        StructField("failed_transaction_count", DoubleType()),
        StructField("unusual_time_transaction", StringType()),
        StructField("previous_fraud_count", DoubleType()),
        StructField("fraud_label", StringType()),
    ]
)

# Roles of the columns in the feature and model steps.
LABEL = "fraud_label"
YES_NO_COLUMNS = ("is_international_transaction", "is_new_merchant", "unusual_time_transaction")
RATE_COLUMNS = (
    "transaction_type",
    "merchant_category",
    "card_type",
    "is_international_transaction",
    "is_new_merchant",
    "unusual_time_transaction",
)
CORRELATED_COLUMNS = (
    "transaction_amount_million",
    "distance_from_home",
    "account_balance_million",
    "daily_transaction_count",
    "weekly_transaction_count",
    "avg_transaction_amount_million",
    "max_transaction_last_24h_million",
    "failed_transaction_count",
    "previous_fraud_count",
)
NON_FEATURES = (
    "fraud_label",
    "transaction_id",
    "customer_id",
    "ip_address",
    "transaction_dt",
    "order_date_dt",
    "transaction_date",
    "transaction_time",
)


def snake_name(title: str) -> str:
    """Column name of the labelled CSV to ours: ``Transaction_Amount (in Million)`` to
    ``transaction_amount_million``."""
    return title.strip().replace(" (in Million)", "_million").replace(" ", "_").lower()
