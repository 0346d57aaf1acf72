"""The given tables, and the transaction tables that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.operators.behaviour import HistoryColumns, customer_profile, international, unusual_time
from tallyguard.operators.clean import clean_table
from tallyguard.session import scratch_path, stage

TXN_HISTORY = HistoryColumns(failed="trim(transaction_type) = 'error'", fraud="lower(trim(fraud_label)) = 'fraud'")


class Tables:
    """Tables of one folder, read lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    def transactions(self) -> DataFrame:
        """Transactions made of events, with gaps, unreadable texts, stray labels and planted copies.

        The explode keeps Spark from repeating the JSON access in every condition on ``k``.
        """
        events = self.read("events").selectExpr(
            "event_id",
            "user_id",
            "ts",
            "event_type",
            "value",
            "explode(array(CAST(get_json_object(props, '$.k') AS INT))) AS k",
            "date_format(ts, 'HH:mm') AS hm",
            "date_format(ts, 'yyyy-MM-dd') AS ymd",
        )
        rows = events.selectExpr(
            "CAST(event_id AS DOUBLE) AS transaction_id",
            "CAST(user_id AS DOUBLE) AS customer_id",
            "ts",
            "CASE WHEN event_id % 31 = 0 THEN NULL ELSE value END AS amount",
            "CASE WHEN event_id % 43 = 0 THEN '25:99' ELSE hm END AS transaction_time",
            "CASE WHEN event_id % 41 = 0 THEN 'n/a' ELSE ymd END AS transaction_date",
            """CASE WHEN event_id % 37 = 0 THEN NULL
                    WHEN event_id % 5 = 0 THEN concat('  ', event_type, ' ')
                    ELSE event_type END AS transaction_type""",
            "CAST(event_id % 97 AS DOUBLE) AS merchant_id",
            "CAST(user_id % 8 AS INT) AS home_city",
            "CAST((event_id * 7) % 8 AS INT) AS txn_city",
            """CASE WHEN k % 3 = 0 THEN 'Yes' WHEN k % 3 = 1 THEN 'No' ELSE 'maybe' END
               AS is_new_merchant""",
            """CASE WHEN k < 8 THEN 'Fraud' WHEN k = 50 THEN NULL WHEN k = 51 THEN ' fraud '
                    WHEN k = 52 THEN 'FRAUD' WHEN k = 53 THEN 'Chargeback' ELSE 'Normal' END
               AS fraud_label""",
        )
        return rows.unionAll(rows.where("CAST(transaction_id AS BIGINT) % 50 = 0"))

    def messages(self) -> DataFrame:
        """Topic records: every transaction as JSON, its planted copies included, and between them
        records that are no transactions (the plain JSON of signups)."""
        body = F.to_json(
            F.struct(
                "transaction_id",
                "customer_id",
                F.col("amount").alias("transaction_amount_million"),
                "transaction_time",
                "transaction_date",
                "transaction_type",
                "merchant_id",
                F.concat(F.lit("city-"), F.col("txn_city").cast("string")).alias("transaction_location"),
                F.concat(F.lit("city-"), F.col("home_city").cast("string")).alias("customer_home_location"),
                "is_new_merchant",
                "fraud_label",
            ),
            {"ignoreNullFields": "false"},
        )
        number = F.col("transaction_id").cast("bigint")
        sent = self.transactions().select(
            F.col("transaction_id").cast("string").alias("key"),
            body.alias("value"),
            (number % 4).cast("int").alias("partition"),
            (number * 2).alias("offset"),
            "ts",
        )
        noise = (
            self.read("events")
            .where("event_type = 'signup'")
            .select(
                F.lit(None).cast("string").alias("key"),
                F.col("props").alias("value"),
                (F.col("event_id") % 4).cast("int").alias("partition"),
                (F.col("event_id") * 2 + 1).alias("offset"),
                "ts",
            )
        )
        return sent.unionAll(noise).select(
            F.col("key").cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            "partition",
            "offset",
            F.col("ts").cast("timestamp").alias("timestamp"),
        )

    def messages_folder(self) -> str:
        """The topic records as Parquet files, in place of a broker."""
        path = self.scratch("topic")
        self.messages().write.parquet(path)
        return path

    def enriched(self) -> DataFrame:
        """Clean transactions with amounts under their usual names and the customer history added."""
        cleaned = stage(clean_table(self.transactions()), "clean_table")
        history = customer_profile(cleaned, ("avg_amount", "max_24h"), TXN_HISTORY)
        places = self.read("nation").selectExpr("n_nationkey AS place", "n_regionkey AS country")
        return unusual_time(international(history, places, "home_city", "txn_city")).withColumnsRenamed(
            {
                "amount": "transaction_amount_million",
                "avg_amount": "avg_transaction_amount_million",
                "max_24h": "max_transaction_last_24h_million",
            }
        )

    def labelled_documents(self) -> DataFrame:
        """Documents with their quality label, a source missing here and there, and rare sources."""
        return (
            self.read("labels")
            .join(self.read("documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
            .withColumn(
                "source",
                F.expr(
                    """CASE WHEN doc_id % 17 = 0 THEN NULL
                            WHEN doc_id % 101 = 0 THEN concat('rare-', CAST(doc_id AS STRING))
                            ELSE source END"""
                ),
            )
        )


TXN_SQL = """
e AS (SELECT event_id, user_id, ts, event_type, value,
             CAST(json_extract_string(props, '$.k') AS INT) AS k,
             strftime(ts, '%H:%M') AS hm, strftime(ts, '%Y-%m-%d') AS ymd
      FROM events),
t AS (SELECT CAST(event_id AS DOUBLE) AS transaction_id, CAST(user_id AS DOUBLE) AS customer_id, ts,
             CASE WHEN event_id % 31 = 0 THEN NULL ELSE value END AS amount,
             CASE WHEN event_id % 43 = 0 THEN '25:99' ELSE hm END AS transaction_time,
             CASE WHEN event_id % 41 = 0 THEN 'n/a' ELSE ymd END AS transaction_date,
             CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 5 = 0 THEN concat('  ', event_type, ' ')
                  ELSE event_type END AS transaction_type,
             CAST(event_id % 97 AS DOUBLE) AS merchant_id,
             CAST(user_id % 8 AS INT) AS home_city, CAST((event_id * 7) % 8 AS INT) AS txn_city,
             CASE WHEN k % 3 = 0 THEN 'Yes' WHEN k % 3 = 1 THEN 'No' ELSE 'maybe' END AS is_new_merchant,
             CASE WHEN k < 8 THEN 'Fraud' WHEN k = 50 THEN NULL WHEN k = 51 THEN ' fraud '
                  WHEN k = 52 THEN 'FRAUD' WHEN k = 53 THEN 'Chargeback' ELSE 'Normal' END AS fraud_label
      FROM e),
txn AS (SELECT * FROM t UNION ALL SELECT * FROM t WHERE CAST(transaction_id AS BIGINT) % 50 = 0)
"""

# The bronze rows of the message table, with the parsed columns beside them.
BRONZE_SQL = (
    TXN_SQL
    + """,
bronze AS (
  SELECT CAST(transaction_id AS BIGINT) * 2 AS kafka_offset, CAST(CAST(transaction_id AS BIGINT) % 4 AS INT) AS kafka_partition,
         CAST(transaction_id AS VARCHAR) AS key, ts, 1 AS is_txn, transaction_id, customer_id, amount,
         transaction_time, transaction_date, transaction_type, merchant_id, txn_city, home_city,
         is_new_merchant, fraud_label
  FROM txn
  UNION ALL
  SELECT event_id * 2 + 1, CAST(event_id % 4 AS INT), NULL, ts, 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, NULL, NULL
  FROM events WHERE event_type = 'signup')
"""
)

# The clean table, step by step.
CLEAN_SQL = (
    TXN_SQL
    + """,
trimmed AS (
  SELECT DISTINCT transaction_id, customer_id, ts, amount, trim(transaction_time) AS transaction_time,
         trim(transaction_date) AS transaction_date, trim(transaction_type) AS transaction_type, merchant_id,
         home_city, txn_city, trim(is_new_merchant) AS is_new_merchant,
         CASE WHEN lower(trim(fraud_label)) = 'fraud' THEN 1 ELSE 0 END AS fraud_label
  FROM txn WHERE lower(trim(fraud_label)) IN ('fraud', 'normal')),
commonest AS (
  SELECT transaction_type FROM trimmed WHERE transaction_type IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, transaction_type LIMIT 1),
clean AS (
  SELECT transaction_id, customer_id, ts,
         coalesce(amount, (SELECT median(amount) FROM trimmed)) AS amount,
         transaction_time, transaction_date,
         coalesce(transaction_type, (SELECT transaction_type FROM commonest)) AS transaction_type,
         merchant_id, home_city, txn_city, is_new_merchant, fraud_label
  FROM trimmed)
"""
)

ENRICHED_SQL = (
    CLEAN_SQL
    + """,
enriched AS (
  SELECT c.*,
         avg(amount) OVER (PARTITION BY customer_id ORDER BY ts
                           RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS average,
         max(amount) OVER (PARTITION BY customer_id ORDER BY ts
                           RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS maximum,
         CASE WHEN h.n_regionkey <> a.n_regionkey THEN 'Yes'
              WHEN h.n_regionkey = a.n_regionkey THEN 'No' END AS is_international_transaction,
         TRY_CAST(nullif(regexp_extract(transaction_time, '^(2[0-3]|[01]?[0-9]):([0-5]?[0-9])$', 1), '') AS DOUBLE) AS hh,
         TRY_CAST(nullif(regexp_extract(transaction_time, '^(2[0-3]|[01]?[0-9]):([0-5]?[0-9])$', 2), '') AS DOUBLE) AS mm
  FROM clean c LEFT JOIN nation h ON h.n_nationkey = c.home_city
               LEFT JOIN nation a ON a.n_nationkey = c.txn_city),
featured AS (
  SELECT *, coalesce(hh, (SELECT median(hh) FROM enriched)) AS hour, coalesce(mm, 0) AS minute,
         CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS d,
         CASE WHEN hh < 6 OR hh >= 22 THEN 'Yes' ELSE 'No' END AS unusual_time_transaction
  FROM enriched)
"""
)

DOCS_SQL = """
docs AS (
  SELECT l.doc_id, l.quality, l.toxic, d.lang, d.n_chars,
         CASE WHEN l.doc_id % 17 = 0 THEN NULL
              WHEN l.doc_id % 101 = 0 THEN concat('rare-', CAST(l.doc_id AS VARCHAR))
              ELSE d.source END AS source
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(concat('42|', CAST(doc_id AS VARCHAR)))) AS place,
         count(*) OVER (PARTITION BY quality) AS n
  FROM docs),
split AS (
  SELECT *, CASE WHEN place <= ceil(n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM placed)
"""
