"""Filters, parsing, label rules, projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.operators import parse
from tallyguard.operators.clean import clean_table
from tallyguard.plans.registry import query, r6, stamp
from tallyguard.plans.tables import BRONZE_SQL, CLEAN_SQL, TXN_SQL, Tables
from tallyguard.sources.topic import to_bronze


@query(
    "filter_transactions",
    f"""WITH {BRONZE_SQL} SELECT kafka_partition, kafka_offset, key FROM bronze WHERE is_txn = 1""",
)
def filter_transactions(tables: Tables) -> DataFrame:
    kept = parse.filter_transactions(to_bronze(tables.messages()))
    return kept.select("kafka_partition", "kafka_offset", "key")


@query(
    "parse_transactions",
    f"""WITH {BRONZE_SQL}
SELECT transaction_id, customer_id, round(amount + 1e-9, 6) + 0.0 AS transaction_amount_million, transaction_time, transaction_date,
       transaction_type, merchant_id, 'city-' || txn_city AS transaction_location, 'city-' || home_city AS customer_home_location,
       is_new_merchant, fraud_label, CAST(NULL AS DOUBLE) AS device_id
FROM bronze WHERE is_txn = 1""",
)
def parse_transactions(tables: Tables) -> DataFrame:
    parsed = parse.parse_transactions(parse.filter_transactions(to_bronze(tables.messages())))
    return parsed.select(
        "transaction_id",
        "customer_id",
        r6("transaction_amount_million").alias("transaction_amount_million"),
        "transaction_time",
        "transaction_date",
        "transaction_type",
        "merchant_id",
        "transaction_location",
        "customer_home_location",
        "is_new_merchant",
        "fraud_label",
        "device_id",
    )


@query(
    "fraud_flag_exact",
    f"""WITH {BRONZE_SQL}
SELECT kafka_offset, CAST(CASE WHEN fraud_label = 'Fraud' THEN 1 ELSE 0 END AS BIGINT) AS is_fraud FROM bronze WHERE is_txn = 1""",
)
def fraud_flag_exact(tables: Tables) -> DataFrame:
    kept = parse.filter_transactions(to_bronze(tables.messages()))
    flagged = parse.with_fraud_flag(kept, F.get_json_object("raw_json", "$.fraud_label"))
    return flagged.select("kafka_offset", "is_fraud")


@query(
    "fraud_flag_strip",
    f"""WITH {TXN_SQL}
SELECT transaction_id, fraud_label, CAST(CASE WHEN trim(fraud_label) = 'Fraud' THEN 1 ELSE 0 END AS BIGINT) AS is_fraud FROM txn""",
)
def fraud_flag_strip(tables: Tables) -> DataFrame:
    return parse.with_fraud_flag(tables.transactions(), mode="strip").select(
        "transaction_id", "fraud_label", "is_fraud"
    )


@query(
    "trim_strings",
    f"""WITH {TXN_SQL}
SELECT transaction_id, trim(transaction_type) AS transaction_type, trim(fraud_label) AS fraud_label,
       length(trim(transaction_type)) AS type_length, home_city FROM txn""",
)
def trim_strings(tables: Tables) -> DataFrame:
    trimmed = parse.trim_strings(tables.transactions())
    return trimmed.select(
        "transaction_id",
        "transaction_type",
        "fraud_label",
        F.length("transaction_type").cast("bigint").alias("type_length"),
        "home_city",
    )


@query(
    "binarize_label",
    f"""WITH {TXN_SQL},
counts AS (SELECT count(*) FILTER (fraud_label IS NULL) AS missing,
                  count(*) FILTER (lower(trim(fraud_label)) NOT IN ('fraud', 'normal')) AS invalid,
                  count(*) FILTER (lower(trim(fraud_label)) IN ('fraud', 'normal')) AS kept FROM txn),
classes AS (SELECT count(*) FILTER (lower(trim(fraud_label)) = 'fraud') AS n_fraud,
                   count(*) FILTER (lower(trim(fraud_label)) = 'normal') AS n_normal FROM txn)
SELECT fraud_label, n, missing, invalid, kept FROM counts,
     (SELECT 1 AS fraud_label, n_fraud AS n FROM classes UNION ALL SELECT 0, n_normal FROM classes)""",
)
def binarize_label(tables: Tables) -> DataFrame:
    rows = tables.transactions()
    report = parse.label_exclusions(rows).select(F.struct("*")).scalar()
    return (
        parse.binarize_label(rows)
        .groupBy("fraud_label")
        .agg(F.count("*").alias("n"))
        .select("fraud_label", "n", *[report[c].alias(c) for c in ("missing", "invalid", "kept")])
    )


@query(
    "drop_duplicates",
    f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, amount, transaction_type, fraud_label
FROM (SELECT DISTINCT * FROM txn)""",
)
def drop_duplicates(tables: Tables) -> DataFrame:
    return parse.drop_duplicates(tables.transactions()).select(
        "transaction_id", "customer_id", stamp("ts").alias("ts"), "amount", "transaction_type", "fraud_label"
    )


@query(
    "select_features",
    f"""WITH {CLEAN_SQL}
SELECT round(amount + 1e-9, 6) + 0.0 AS amount, merchant_id, home_city, txn_city, transaction_type, is_new_merchant,
       '["amount","merchant_id","home_city","txn_city"]' AS numeric_names,
       '["transaction_type","is_new_merchant"]' AS categorical_names
FROM clean""",
)
def select_features(tables: Tables) -> DataFrame:
    chosen, numeric, categorical = parse.select_features(clean_table(tables.transactions()).drop("ts"))
    names = [F.to_json(F.array(*[F.lit(c) for c in part])) for part in (numeric, categorical)]
    return chosen.select("*", names[0].alias("numeric_names"), names[1].alias("categorical_names")).withColumn(
        "amount", r6("amount")
    )


@query(
    "head_rows",
    "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 8",
)
def head_rows(tables: Tables) -> DataFrame:
    rows = tables.read("documents").select("doc_id", "lang", "source", "n_chars")
    return parse.head_rows(rows, 8, F.desc("n_chars"), "doc_id")
