"""Imputation and the cleaning sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.operators import clean
from tallyguard.plans.registry import query, r6, stamp
from tallyguard.plans.tables import CLEAN_SQL, TXN_SQL, Tables


@query(
    "impute_median",
    f"""WITH {TXN_SQL}
SELECT transaction_id, round(coalesce(amount, (SELECT median(amount) FROM txn)) + 1e-9, 6) + 0.0 AS amount, merchant_id, transaction_type FROM txn""",
)
def impute_median(tables: Tables) -> DataFrame:
    filled = clean.impute_median(tables.transactions())
    return filled.select("transaction_id", r6("amount").alias("amount"), "merchant_id", "transaction_type")


@query(
    "impute_mode",
    f"""WITH {TXN_SQL},
c AS (SELECT transaction_type FROM txn WHERE transaction_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, transaction_type LIMIT 1),
l AS (SELECT fraud_label FROM txn WHERE fraud_label IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, fraud_label LIMIT 1)
SELECT transaction_id, amount, coalesce(transaction_type, (SELECT transaction_type FROM c)) AS transaction_type,
       coalesce(fraud_label, (SELECT fraud_label FROM l)) AS fraud_label, 'Inconnu' AS nothing FROM txn""",
)
def impute_mode(tables: Tables) -> DataFrame:
    rows = tables.transactions().withColumn("nothing", F.lit(None).cast("string"))
    return clean.impute_mode(rows).select("transaction_id", "amount", "transaction_type", "fraud_label", "nothing")


@query(
    "clean_pipeline",
    f"""WITH {CLEAN_SQL}
SELECT transaction_id, customer_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, round(amount + 1e-9, 6) + 0.0 AS amount, transaction_time,
       transaction_date, transaction_type, merchant_id, home_city, txn_city, is_new_merchant, fraud_label FROM clean""",
)
def clean_pipeline(tables: Tables) -> DataFrame:
    return clean.clean_table(tables.transactions()).withColumns({"ts": stamp("ts"), "amount": r6("amount")})
