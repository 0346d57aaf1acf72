"""Customer-history features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.operators import behaviour
from tallyguard.plans.registry import query, r6
from tallyguard.plans.tables import TXN_HISTORY, TXN_SQL, Tables

TO_DATE = "PARTITION BY customer_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
LAST_DAY = "PARTITION BY customer_id ORDER BY ts RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW"


def profiled(tables: Tables, feature: str, hot_rows: int = behaviour.HOT_ROWS) -> DataFrame:
    rows = behaviour.customer_profile(tables.transactions(), (feature,), TXN_HISTORY, hot_rows)
    value = r6(feature) if feature in ("avg_amount", "max_24h") else F.col(feature)
    return rows.select("transaction_id", "customer_id", value.alias(feature))


@query(
    "prof_daily_count",
    f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id, count(*) OVER (PARTITION BY customer_id, CAST(ts AS DATE) ORDER BY ts
       RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS daily_count FROM txn""",
)
def prof_daily_count(tables: Tables) -> DataFrame:
    return profiled(tables, "daily_count")


@query(
    "prof_weekly_count",
    f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id, count(*) OVER (PARTITION BY customer_id ORDER BY ts
       RANGE BETWEEN INTERVAL 168 HOURS PRECEDING AND CURRENT ROW) AS weekly_count FROM txn""",
)
def prof_weekly_count(tables: Tables) -> DataFrame:
    return profiled(tables, "weekly_count")


@query(
    "prof_avg_amount",
    f"WITH {TXN_SQL} SELECT transaction_id, customer_id, round(avg(amount) OVER ({TO_DATE}) + 1e-9, 6) + 0.0 AS avg_amount FROM txn",
)
def prof_avg_amount(tables: Tables) -> DataFrame:
    return profiled(tables, "avg_amount")


ODD_AMOUNT = """CASE WHEN CAST(transaction_id AS BIGINT) % 997 = 0 THEN CAST('NaN' AS DOUBLE)
            WHEN CAST(transaction_id AS BIGINT) % 1009 = 0 THEN CAST('Infinity' AS DOUBLE)
            WHEN CAST(transaction_id AS BIGINT) % 89 = 0 THEN 1.0e15 + 0.5 ELSE amount END"""


@query(
    "prof_avg_amount_odd",
    f"""WITH {TXN_SQL}, odd AS (SELECT * REPLACE ({ODD_AMOUNT} AS amount) FROM txn),
s AS (SELECT transaction_id, customer_id, count(amount) OVER ({TO_DATE}) AS n,
             count(*) FILTER (isnan(amount)) OVER ({TO_DATE}) AS n_nan, count(*) FILTER (isinf(amount)) OVER ({TO_DATE}) AS n_inf,
             CAST(sum(CAST(CASE WHEN isfinite(amount) THEN amount END AS DECIMAL(38, 12))) OVER ({TO_DATE}) AS DOUBLE) AS total
      FROM odd),
m AS (SELECT *, CASE WHEN n > 0 THEN coalesce(total, 0) / n END AS mean FROM s)
SELECT transaction_id, customer_id,
       CASE WHEN n_nan > 0 THEN 'nan' WHEN n_inf > 0 THEN 'infinite' WHEN mean >= 1e9 THEN 'large' ELSE 'ordinary' END AS kind,
       CASE WHEN n_nan + n_inf > 0 THEN NULL WHEN mean >= 1e9 THEN round(mean / 1e6) ELSE round(mean + 1e-9, 6) + 0.0 END AS avg_amount
FROM m""",
)
def prof_avg_amount_odd(tables: Tables) -> DataFrame:
    """Means to date where some amounts are NaN, infinite or huge."""
    rows = tables.transactions().withColumn("amount", F.expr(ODD_AMOUNT))
    mean = F.col("avg_amount")
    kind = F.when(F.isnan(mean), "nan").when(F.abs(mean) == float("inf"), "infinite").when(mean >= 1e9, "large")
    value = F.when(F.col("kind").isin("nan", "infinite"), F.lit(None))
    value = value.when(mean >= 1e9, F.round(mean / 1e6)).otherwise(r6(mean))
    out = behaviour.customer_profile(rows, ("avg_amount",), TXN_HISTORY)
    out = out.withColumn("kind", F.coalesce(kind, F.lit("ordinary")))
    return out.select("transaction_id", "customer_id", "kind", value.alias("avg_amount"))


@query(
    "prof_max_24h",
    f"WITH {TXN_SQL} SELECT transaction_id, customer_id, round(max(amount) OVER ({LAST_DAY}) + 1e-9, 6) + 0.0 AS max_24h FROM txn",
)
def prof_max_24h(tables: Tables) -> DataFrame:
    return profiled(tables, "max_24h")


@query(
    "prof_new_merchant",
    f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id, merchant_id,
       CASE WHEN ts = min(ts) OVER (PARTITION BY customer_id, merchant_id) THEN 'Yes' ELSE 'No' END AS is_new_merchant FROM txn""",
)
def prof_new_merchant(tables: Tables) -> DataFrame:
    return behaviour.new_merchant(tables.transactions(), TXN_HISTORY).select(
        "transaction_id", "customer_id", "merchant_id", "is_new_merchant"
    )


@query(
    "prof_failed_count",
    f"""WITH {TXN_SQL}
SELECT transaction_id, customer_id,
       CAST(sum(CASE WHEN trim(transaction_type) = 'error' THEN 1 ELSE 0 END) OVER ({LAST_DAY}) AS BIGINT) AS failed_count FROM txn""",
)
def prof_failed_count(tables: Tables) -> DataFrame:
    return profiled(tables, "failed_count")


@query(
    "prof_prev_fraud",
    f"""WITH {TXN_SQL}, f AS (SELECT *, CASE WHEN lower(trim(fraud_label)) = 'fraud' THEN 1 ELSE 0 END AS flag FROM txn)
SELECT transaction_id, customer_id,
       CAST(sum(flag) OVER ({TO_DATE}) - sum(flag) OVER (PARTITION BY customer_id, ts) AS BIGINT) AS prev_fraud FROM f""",
)
def prof_prev_fraud(tables: Tables) -> DataFrame:
    return profiled(tables, "prev_fraud")


@query(
    "prof_international",
    """WITH lines AS (SELECT l_orderkey, l_linenumber, l_partkey, s_nationkey,
         CASE WHEN l_orderkey % 50 = 0 THEN 99 ELSE c_nationkey END AS c_nationkey
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
            JOIN supplier ON s_suppkey = l_suppkey)
SELECT l_orderkey, l_linenumber, l_partkey, c_nationkey, s_nationkey,
       CASE WHEN h.n_regionkey <> a.n_regionkey THEN 'Yes' WHEN h.n_regionkey = a.n_regionkey THEN 'No' END
       AS is_international_transaction
FROM lines LEFT JOIN nation h ON h.n_nationkey = c_nationkey LEFT JOIN nation a ON a.n_nationkey = s_nationkey""",
)
def prof_international(tables: Tables) -> DataFrame:
    """A line is international where customer and supplier live in different regions; some lines hold a
    nation that the place table doesn't know."""
    lines = (
        tables.read("lineitem")
        .join(tables.read("orders"), F.col("o_orderkey") == F.col("l_orderkey"))
        .join(tables.read("customer"), F.col("c_custkey") == F.col("o_custkey"))
        .join(tables.read("supplier"), F.col("s_suppkey") == F.col("l_suppkey"))
        .withColumn("c_nationkey", F.expr("CASE WHEN l_orderkey % 50 = 0 THEN 99 ELSE c_nationkey END"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "c_nationkey", "s_nationkey")
    )
    places = tables.read("nation").selectExpr("n_nationkey AS place", "n_regionkey AS country")
    return behaviour.international(lines, places, "c_nationkey", "s_nationkey")


@query(
    "prof_unusual_time",
    f"""WITH {TXN_SQL}
SELECT transaction_id, transaction_time,
       CASE WHEN hour(try_strptime(transaction_time, '%H:%M')) < 6 OR hour(try_strptime(transaction_time, '%H:%M')) >= 22
            THEN 'Yes' ELSE 'No' END AS unusual_time_transaction FROM txn""",
)
def prof_unusual_time(tables: Tables) -> DataFrame:
    return behaviour.unusual_time(tables.transactions()).select(
        "transaction_id", "transaction_time", "unusual_time_transaction"
    )
