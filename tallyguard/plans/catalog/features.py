"""Scalar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.functions import dates
from tallyguard.functions.numeric import guarded_ratio
from tallyguard.functions.numeric import log1p_amount as log1p
from tallyguard.functions.text import yes_no_flag as flag_of
from tallyguard.operators import features
from tallyguard.plans.registry import query, r6, rounded, stamp
from tallyguard.plans.tables import ENRICHED_SQL, TXN_SQL, Tables

TIME_SQL = f"""WITH {TXN_SQL},
p AS (SELECT *, try_strptime(transaction_time, '%H:%M') AS tt, CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS d FROM txn),
h AS (SELECT *, CAST(coalesce(hour(tt), (SELECT median(hour(tt)) FROM p)) AS DOUBLE) AS hour,
             CAST(coalesce(minute(tt), 0) AS DOUBLE) AS minute FROM p)"""


def dated(tables: Tables) -> DataFrame:
    return tables.transactions().withColumn("d", dates.parse_date(F.col("transaction_date")))


@query(
    "parse_hhmm",
    f"""{TIME_SQL}
SELECT transaction_id, transaction_time, CAST(hour(tt) AS DOUBLE) AS hour, CAST(minute(tt) AS DOUBLE) AS minute FROM p""",
)
def parse_hhmm(tables: Tables) -> DataFrame:
    time = F.col("transaction_time")
    return tables.transactions().select(
        "transaction_id",
        "transaction_time",
        dates.hour_of(time).cast("double").alias("hour"),
        dates.minute_of(time).cast("double").alias("minute"),
    )


@query(
    "parse_date",
    f"{TIME_SQL} SELECT transaction_id, transaction_date, strftime(d, '%Y/%m/%d') AS day FROM p",
)
def parse_date(tables: Tables) -> DataFrame:
    return dated(tables).select(
        "transaction_id", "transaction_date", F.date_format("d", "yyyy/MM/dd").alias("day")
    )


@query("fill_time", f"{TIME_SQL} SELECT transaction_id, transaction_time, hour, minute FROM h")
def fill_time(tables: Tables) -> DataFrame:
    return features.fill_time(tables.transactions()).select("transaction_id", "transaction_time", "hour", "minute")


@query(
    "combine_datetime",
    f"""{TIME_SQL}
SELECT transaction_id, strftime(d + to_seconds(CAST(hour * 3600 + minute * 60 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS transaction_dt FROM h""",
)
def combine_datetime(tables: Tables) -> DataFrame:
    filled = features.fill_time(dated(tables))
    moment = dates.combine_datetime(F.col("d"), F.col("hour"), F.col("minute"))
    return filled.select(
        "transaction_id", F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("transaction_dt")
    )


@query(
    "calendar_features",
    f"""{TIME_SQL}
SELECT transaction_id, CAST(isodow(d) - 1 AS DOUBLE) AS day_of_week, CAST(day(d) AS DOUBLE) AS day_of_month,
       CAST(month(d) AS DOUBLE) AS month, CAST(quarter(d) AS DOUBLE) AS quarter,
       CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM p""",
)
def calendar_features(tables: Tables) -> DataFrame:
    return features.calendar_features(dated(tables), "d").select(
        "transaction_id",
        *[F.col(c).cast("double").alias(c) for c in ("day_of_week", "day_of_month", "month", "quarter")],
        "is_weekend",
    )


@query(
    "month_bucket",
    """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month FROM orders""",
)
def month_bucket(tables: Tables) -> DataFrame:
    orders = tables.read("orders")
    return orders.select("o_orderkey", dates.month_bucket(F.col("o_orderdate")).cast("string").alias("month"))


@query(
    "is_night",
    f"""{TIME_SQL}
SELECT transaction_id, transaction_time, CASE WHEN hour(tt) < 6 OR hour(tt) >= 22 THEN 1 ELSE 0 END AS is_night FROM p""",
)
def is_night(tables: Tables) -> DataFrame:
    hour = dates.hour_of(F.col("transaction_time"))
    return tables.transactions().select("transaction_id", "transaction_time", dates.is_night(hour).alias("is_night"))


@query(
    "cyclic_encode",
    f"""{TIME_SQL}
SELECT transaction_id, round(sin(2 * pi() * hour / 24) + 1e-9, 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour / 24) + 1e-9, 6) + 0.0 AS hour_cos,
       round(sin(2 * pi() * (isodow(d) - 1) / 7) + 1e-9, 6) + 0.0 AS dow_sin, round(cos(2 * pi() * (isodow(d) - 1) / 7) + 1e-9, 6) + 0.0 AS dow_cos
FROM h""",
)
def cyclic_encode(tables: Tables) -> DataFrame:
    timed = features.calendar_features(features.fill_time(dated(tables)), "d")
    columns = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
    return rounded(features.cyclic_encode(timed).select("transaction_id", *columns), *columns)


FLAG_SQL = """CASE WHEN lower(trim({c})) IN ('yes', 'y', 'true', '1') THEN 1.0::DOUBLE
       WHEN lower(trim({c})) IN ('no', 'n', 'false', '0') THEN 0.0::DOUBLE END"""


@query(
    "yes_no_flag",
    f"""WITH {TXN_SQL}
SELECT transaction_id, is_new_merchant, {FLAG_SQL.format(c="is_new_merchant")} AS is_new_merchant_num,
       {FLAG_SQL.format(c="CAST(home_city AS VARCHAR)")} AS home_city_num FROM txn""",
)
def yes_no_flag(tables: Tables) -> DataFrame:
    return tables.transactions().select(
        "transaction_id",
        "is_new_merchant",
        flag_of(F.col("is_new_merchant")).alias("is_new_merchant_num"),
        flag_of(F.col("home_city")).alias("home_city_num"),
    )


@query(
    "log1p_amount",
    f"""WITH {TXN_SQL}
SELECT transaction_id, round(ln(1 + CASE WHEN amount - 10 < 0 THEN 0 ELSE amount - 10 END) + 1e-9, 6) + 0.0 AS log_amount FROM txn""",
)
def log1p_amount(tables: Tables) -> DataFrame:
    """Amounts are lowered by 10 so that some are negative."""
    return tables.transactions().select("transaction_id", r6(log1p(F.col("amount") - 10)).alias("log_amount"))


@query(
    "amount_ratios",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / (abs(l_quantity) + 1e-6), 4) + 0.0 AS versus_quantity,
       round(l_tax / (abs(l_discount) + 1e-6), 4) + 0.0 AS versus_discount FROM lineitem""",
)
def amount_ratios(tables: Tables) -> DataFrame:
    """Discounts of zero are among the bases."""
    ratios = {
        "versus_quantity": guarded_ratio(F.col("l_extendedprice"), F.col("l_quantity")),
        "versus_discount": guarded_ratio(F.col("l_tax"), F.col("l_discount")),
    }
    return tables.read("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[(F.round(c, 4) + 0.0).alias(name) for name, c in ratios.items()],
    )


FEATURE_SQL = f"""WITH {ENRICHED_SQL}
SELECT transaction_id, fraud_label, strftime(d + to_seconds(CAST(hour * 3600 + minute * 60 AS BIGINT)), '%Y-%m-%d %H:%M:%S.%f') AS transaction_dt,
       strftime(d, '%Y-%m-%d') AS order_date_dt, hour, CAST(minute AS DOUBLE) AS minute, CAST(isodow(d) - 1 AS DOUBLE) AS day_of_week,
       CAST(day(d) AS DOUBLE) AS day_of_month, CAST(month(d) AS DOUBLE) AS month, CAST(quarter(d) AS DOUBLE) AS quarter,
       CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, CASE WHEN hour < 6 OR hour >= 22 THEN 1 ELSE 0 END AS is_night,
       round(sin(2 * pi() * hour / 24) + 1e-9, 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour / 24) + 1e-9, 6) + 0.0 AS hour_cos,
       round(sin(2 * pi() * (isodow(d) - 1) / 7) + 1e-9, 6) + 0.0 AS dow_sin, round(cos(2 * pi() * (isodow(d) - 1) / 7) + 1e-9, 6) + 0.0 AS dow_cos,
       {FLAG_SQL.format(c="is_international_transaction")} AS is_international_transaction_num,
       {FLAG_SQL.format(c="is_new_merchant")} AS is_new_merchant_num,
       {FLAG_SQL.format(c="unusual_time_transaction")} AS unusual_time_transaction_num,
       round(ln(1 + greatest(amount, 0)) + 1e-9, 6) + 0.0 AS log_transaction_amount,
       round(amount / (abs(average) + 1e-6) + 1e-9, 6) + 0.0 AS amount_vs_avg_ratio,
       round(amount / (abs(maximum) + 1e-6) + 1e-9, 6) + 0.0 AS amount_vs_max24_ratio
FROM featured"""


@query("feature_table", FEATURE_SQL)
def feature_table(tables: Tables) -> DataFrame:
    table = features.feature_table(tables.enriched())
    doubles = ("minute", "day_of_week", "day_of_month", "month", "quarter")
    table = table.withColumns(
        {
            "transaction_dt": stamp("transaction_dt"),
            "order_date_dt": F.col("order_date_dt").cast("string"),
            **{c: F.col(c).cast("double") for c in doubles},
        }
    )
    measures = [c for c in features.NEW_COLUMNS if c.endswith(("_sin", "_cos", "_ratio")) or c.startswith("log_")]
    return rounded(table.select("transaction_id", "fraud_label", *features.NEW_COLUMNS), *measures)
