"""Aggregations and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.operators import profile
from tallyguard.operators.features import cyclic_encode
from tallyguard.operators.prepare import stratified_split
from tallyguard.operators.value_counts import ValueCounts
from tallyguard.plans.flows import bronze_to_gold
from tallyguard.plans.registry import query, r6, rounded
from tallyguard.plans.tables import BRONZE_SQL, DOCS_SQL, TXN_SQL, Tables
from tallyguard.sources.topic import to_bronze

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "gold_summary",
    f"""WITH {BRONZE_SQL}
SELECT count(*) AS transaction_count, CAST(sum(CASE WHEN fraud_label = 'Fraud' THEN 1 ELSE 0 END) AS BIGINT) AS fraud_count,
       round(avg(amount) + 1e-9, 6) + 0.0 AS avg_amount_million
FROM bronze WHERE is_txn = 1""",
)
def gold_summary(tables: Tables) -> DataFrame:
    return rounded(bronze_to_gold(to_bronze(tables.messages())), "avg_amount_million")


TXN_TYPES = {
    "transaction_id": "double",
    "customer_id": "double",
    "ts": "timestamp_ntz",
    "amount": "double",
    "transaction_time": "string",
    "transaction_date": "string",
    "transaction_type": "string",
    "merchant_id": "double",
    "home_city": "int",
    "txn_city": "int",
    "is_new_merchant": "string",
    "fraud_label": "string",
}


@query(
    "profile_shape",
    f"WITH {TXN_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, count(*) AS n_rows, "
        f"CAST({len(TXN_TYPES)} AS BIGINT) AS n_columns FROM txn"
        for c, t in TXN_TYPES.items()
    ),
)
def profile_shape(tables: Tables) -> DataFrame:
    return profile.profile_shape(tables.transactions())


@query(
    "missing_counts",
    f"WITH {TXN_SQL} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_missing FROM txn" for c in TXN_TYPES
    )
    + ") WHERE n_missing > 0",
)
def missing_counts(tables: Tables) -> DataFrame:
    return profile.missing_counts(tables.transactions())


def described(column: str, table: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}) + 1e-9, 6) + 0.0 AS mean,
       round(stddev_samp({column}) + 1e-9, 6) + 0.0 AS std, round(min({column}) + 1e-9, 6) + 0.0 AS min, round(quantile_cont({column}, 0.25) + 1e-9, 6) + 0.0 AS q25,
       round(quantile_cont({column}, 0.5) + 1e-9, 6) + 0.0 AS q50, round(quantile_cont({column}, 0.75) + 1e-9, 6) + 0.0 AS q75,
       round(max({column}) + 1e-9, 6) + 0.0 AS max FROM {table}"""


DESCRIBED = ("mean", "std", "min", "q25", "q50", "q75", "max")


@query("describe_numeric", " UNION ALL ".join(described(c, "lineitem") for c in MEASURES))
def describe_numeric(tables: Tables) -> DataFrame:
    return rounded(profile.describe_numeric(tables.read("lineitem"), MEASURES), *DESCRIBED)


@query(
    "describe_stacked",
    described("measure", "(" + " UNION ALL ".join(f"SELECT {c} AS measure FROM lineitem" for c in MEASURES) + ")"),
)
def describe_stacked(tables: Tables) -> DataFrame:
    """All measures as one column: from sf0.01 on, enough rows for quantiles by brackets."""
    measures = F.explode(F.array(*[F.col(c).cast("double") for c in MEASURES])).alias("measure")
    return rounded(profile.describe_numeric(tables.read("lineitem").select(measures)), *DESCRIBED)


@query("describe_counted", " UNION ALL ".join(described(c, "lineitem") for c in MEASURES))
def describe_counted(tables: Tables) -> DataFrame:
    """As describe_numeric, from counts of values."""
    return rounded(ValueCounts(tables.read("lineitem").select(*MEASURES)).numbers(), *DESCRIBED)


@query(
    "label_distribution",
    f"""WITH {TXN_SQL}
SELECT trim(fraud_label) AS label, count(*) AS n,
       round(count(*) * 100 / (SELECT count(fraud_label) FROM txn)::DOUBLE, 2) AS pct
FROM txn WHERE fraud_label IS NOT NULL GROUP BY 1""",
)
def label_distribution(tables: Tables) -> DataFrame:
    return profile.label_distribution(tables.transactions())


@query(
    "imbalance_ratio",
    f"""WITH {TXN_SQL}, c AS (SELECT trim(fraud_label) AS label, count(*) AS n FROM txn WHERE fraud_label IS NOT NULL GROUP BY 1)
SELECT count(*) AS n_classes, round(min(n) / max(n)::DOUBLE + 1e-9, 6) + 0.0 AS ratio FROM c""",
)
def imbalance_ratio(tables: Tables) -> DataFrame:
    return rounded(profile.imbalance_ratio(tables.transactions()), "ratio")


@query(
    "cardinality",
    f"WITH {TXN_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique FROM txn"
        for c in TXN_TYPES
    ),
)
def cardinality(tables: Tables) -> DataFrame:
    return profile.cardinality(tables.transactions())


@query(
    "topk_values",
    f"""WITH {TXN_SQL}
SELECT merchant_id AS value, count(*) AS n FROM txn WHERE merchant_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10""",
)
def topk_values(tables: Tables) -> DataFrame:
    return profile.topk_values(tables.transactions(), "merchant_id", 10)


@query(
    "histogram_by",
    f"""WITH {TXN_SQL}, r AS (SELECT min(amount) AS lo, max(amount) AS hi FROM txn),
b AS (SELECT fraud_label, lo, (hi - lo) / 40 AS width,
             CAST(least(floor(40.0::DOUBLE * (amount - lo) / (hi - lo)) + 1, 40) AS INT) AS bin FROM txn, r WHERE amount IS NOT NULL)
SELECT fraud_label, bin, round(lo + (bin - 1) * width + 1e-9, 6) + 0.0 AS low, round(lo + bin * width + 1e-9, 6) + 0.0 AS high, count(*) AS n
FROM b GROUP BY fraud_label, bin, lo, width""",
)
def histogram_by(tables: Tables) -> DataFrame:
    return rounded(profile.histogram_by(tables.transactions(), "amount", "fraud_label"), "low", "high")


@query(
    "box_stats_by",
    f"""WITH {TXN_SQL}, g AS (
  SELECT 'group' AS scope, fraud_label, amount AS v FROM txn WHERE amount IS NOT NULL
  UNION ALL SELECT 'overall', NULL, amount FROM txn WHERE amount IS NOT NULL),
q AS (SELECT scope, fraud_label, count(*) AS n, quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.5) AS m,
             quantile_cont(v, 0.75) AS b FROM g GROUP BY 1, 2)
SELECT q.scope, q.fraud_label, q.n, round(a + 1e-9, 6) + 0.0 AS q25, round(m + 1e-9, 6) + 0.0 AS q50, round(b + 1e-9, 6) + 0.0 AS q75,
       round(min(v) FILTER (v BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) + 1e-9, 6) + 0.0 AS whisker_low,
       round(max(v) FILTER (v BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) + 1e-9, 6) + 0.0 AS whisker_high,
       count(*) FILTER (v NOT BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)) AS n_outliers
FROM g JOIN q ON g.scope = q.scope AND g.fraud_label IS NOT DISTINCT FROM q.fraud_label
GROUP BY q.scope, q.fraud_label, q.n, a, m, b""",
)
def box_stats_by(tables: Tables) -> DataFrame:
    table = profile.box_stats_by(tables.transactions(), "amount", "fraud_label")
    return rounded(table, "q25", "q50", "q75", "whisker_low", "whisker_high")


CORR_COLUMNS = ("quantity", "price", "discount", "tax", "line_no", "constant")
CORR_BASE = """m AS (SELECT CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity,
                            CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS price,
                            l_discount AS discount, l_tax AS tax, l_linenumber AS line_no, 7 AS constant FROM lineitem)"""


@query(
    "corr_matrix",
    f"WITH {CORR_BASE} "
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, (SELECT CASE WHEN isnan(r) THEN NULL ELSE round(r + 1e-9, 6) + 0.0 END "
        f"FROM (SELECT corr({x}, {y}) AS r FROM m)) AS r"
        for x in CORR_COLUMNS
        for y in CORR_COLUMNS
    ),
)
def corr_matrix(tables: Tables) -> DataFrame:
    rows = tables.read("lineitem").selectExpr(
        "CASE WHEN l_linenumber <> 3 THEN l_quantity END AS quantity",
        "CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS price",
        "l_discount AS discount",
        "l_tax AS tax",
        "l_linenumber AS line_no",
        "7 AS constant",
    )
    return rounded(profile.corr_matrix(rows, CORR_COLUMNS), "r")


RATE_COLUMNS = ("transaction_type", "is_new_merchant", "txn_city")


RATES_SQL = (
    f"WITH {TXN_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value,
       round(avg(CASE WHEN trim(fraud_label) = 'Fraud' THEN 1.0::DOUBLE ELSE 0 END) + 1e-9, 6) + 0.0 AS rate, count(*) AS n,
       round(avg(CASE WHEN trim(fraud_label) = 'Fraud' THEN 1.0::DOUBLE ELSE 0 END) * 100, 2) AS rate_pct
FROM txn WHERE {c} IS NOT NULL AND fraud_label IS NOT NULL GROUP BY 2"""
        for c in RATE_COLUMNS
    )
)


@query("fraud_rate_by", RATES_SQL)
def fraud_rate_by(tables: Tables) -> DataFrame:
    return rounded(profile.fraud_rate_by(tables.transactions(), RATE_COLUMNS), "rate")


@query("fraud_rate_counted", RATES_SQL)
def fraud_rate_counted(tables: Tables) -> DataFrame:
    """As fraud_rate_by, from counts of values."""
    return rounded(ValueCounts(tables.transactions()).rates(RATE_COLUMNS), "rate")


BOUNDS_SQL = """SELECT a - 1.5 * (b - a) AS low, b + 1.5 * (b - a) AS high FROM
  (SELECT quantile_cont({v}, 0.25) AS a, quantile_cont({v}, 0.75) AS b FROM {t})"""


@query(
    "iqr_outliers",
    f"""WITH o AS ({BOUNDS_SQL.format(v="o_totalprice", t="orders")})
SELECT round(low + 1e-9, 6) + 0.0 AS low, round(high + 1e-9, 6) + 0.0 AS high, count(o_totalprice) AS n,
       count(*) FILTER (o_totalprice < low OR o_totalprice > high) AS n_outliers,
       round(count(*) FILTER (o_totalprice < low OR o_totalprice > high) * 100 / count(o_totalprice)::DOUBLE + 1e-9, 6) + 0.0 AS pct_outliers
FROM orders, o GROUP BY low, high""",
)
def iqr_outliers(tables: Tables) -> DataFrame:
    return rounded(profile.iqr_outliers(tables.read("orders"), "o_totalprice"), "low", "high", "pct_outliers")


@query(
    "flag_outliers",
    f"""WITH {TXN_SQL}, o AS ({BOUNDS_SQL.format(v="amount", t="txn")})
SELECT transaction_id, round(amount + 1e-9, 6) + 0.0 AS amount, CASE WHEN amount < low OR amount > high THEN 1 ELSE 0 END AS is_outlier FROM txn, o""",
)
def flag_outliers(tables: Tables) -> DataFrame:
    flagged = profile.flag_outliers(tables.transactions(), "amount")
    return flagged.select("transaction_id", r6("amount").alias("amount"), "is_outlier")


@query(
    "monthly_trend",
    """WITH o AS (SELECT CASE WHEN o_orderkey % 41 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day,
                     CASE o_orderstatus WHEN 'F' THEN ' Fraud ' WHEN 'P' THEN NULL ELSE 'Normal' END AS label FROM orders)
SELECT strftime(date_trunc('month', CAST(day AS DATE)), '%Y-%m-%d') AS month, count(*) AS n,
       round(avg(CASE WHEN trim(label) = 'Fraud' THEN 100.0::DOUBLE ELSE 0 END) + 1e-9, 6) + 0.0 AS rate_pct
FROM o WHERE day <> 'n/a' GROUP BY 1""",
)
def monthly_trend(tables: Tables) -> DataFrame:
    orders = tables.read("orders").selectExpr(
        "CASE WHEN o_orderkey % 41 = 0 THEN 'n/a' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS day",
        "CASE o_orderstatus WHEN 'F' THEN ' Fraud ' WHEN 'P' THEN NULL ELSE 'Normal' END AS label",
    )
    trend = profile.monthly_trend(orders, "day", "label")
    return rounded(trend.withColumn("month", F.col("month").cast("string")), "rate_pct")


LABELLED_SQL = f"""WITH {TXN_SQL},
f AS (SELECT txn_city AS value, CASE WHEN trim(fraud_label) = 'Fraud' THEN 1.0::DOUBLE ELSE 0 END AS flag
      FROM txn WHERE txn_city IS NOT NULL AND fraud_label IS NOT NULL)"""


@query(
    "crosstab_pct",
    f"""{LABELLED_SQL} SELECT value, round(100 - avg(flag) * 100, 2) AS pct_normal, round(avg(flag) * 100, 2) AS pct_fraud
FROM f GROUP BY value""",
)
def crosstab_pct(tables: Tables) -> DataFrame:
    return profile.crosstab_pct(tables.transactions(), "txn_city")


@query(
    "rate_by_value",
    f"{LABELLED_SQL} SELECT value, round(avg(flag) * 100 + 1e-9, 6) + 0.0 AS rate_pct FROM f GROUP BY value",
)
def rate_by_value(tables: Tables) -> DataFrame:
    return rounded(profile.rate_by_value(tables.transactions(), "txn_city"), "rate_pct")


TARGET_FEATURES = ("n_chars", "toxic", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "constant")


@query(
    "feature_target_corr",
    f"""WITH {DOCS_SQL}, f AS (
  SELECT quality, n_chars, toxic, sin(2 * pi() * (n_chars % 24) / 24) AS hour_sin, cos(2 * pi() * (n_chars % 24) / 24) AS hour_cos,
         sin(2 * pi() * (n_chars % 7) / 7) AS dow_sin, cos(2 * pi() * (n_chars % 7) / 7) AS dow_cos, 1 AS constant FROM docs) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, (SELECT CASE WHEN isnan(r) THEN NULL ELSE round(r + 1e-9, 6) + 0.0 END FROM "
        f"(SELECT corr({c}, quality) AS r FROM f)) AS r"
        for c in TARGET_FEATURES
    ),
)
def feature_target_corr(tables: Tables) -> DataFrame:
    rows = tables.labelled_documents().selectExpr(
        "quality", "n_chars", "toxic", "n_chars % 24 AS hour", "n_chars % 7 AS day_of_week", "1 AS constant"
    )
    return rounded(profile.feature_target_corr(cyclic_encode(rows), TARGET_FEATURES, "quality"), "r")


@query(
    "split_summary",
    f"""WITH {DOCS_SQL}
SELECT split, count(*) AS n, round(avg(quality) * 100 + 1e-9, 6) + 0.0 AS rate_pct FROM split GROUP BY split""",
)
def split_summary(tables: Tables) -> DataFrame:
    split = stratified_split(tables.labelled_documents(), ["doc_id"], "quality")
    return rounded(profile.split_summary(split, "quality"), "rate_pct")
