"""The history of customers ahead of scoring: arriving rows meet the state that earlier batches have written.

The state of a path is three tables. ``rows`` keeps instants, amounts and flags by day and batch; ``days`` keeps
sums by customer and day; ``firsts`` the first instant of every customer and merchant. The last two are merged into
generations. A batch reads, for its own customers, the rows of the days that the trailing frames of its rows reach,
and of everything older only the sums, so its work follows the customers it holds and not the length of their past.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tallyguard.functions.dates import DAY_US, WEEK_US
from tallyguard.operators.behaviour import (
    FEATURES,
    HOT_ROWS,
    PARTS,
    RUNNING,
    HistoryColumns,
    amount_parts,
    customer_profile,
    mean_of_parts,
)
from tallyguard.streaming.generations import read_generations, write_generation
from tallyguard.streaming.ingest import TRIGGER_SECONDS, triggered

REACH_DAYS = WEEK_US // DAY_US


@dataclass(frozen=True)
class MessageColumns:
    """Columns of a message that the history fills."""

    daily_count: str = "daily_transaction_count"
    weekly_count: str = "weekly_transaction_count"
    avg_amount: str = "avg_transaction_amount_million"
    max_24h: str = "max_transaction_last_24h_million"
    failed_count: str = "failed_transaction_count"
    prev_fraud: str = "previous_fraud_count"
    new_merchant: str = "is_new_merchant"


def _same(left: str, right: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`"))
    return out


class CustomerState:
    """The tables of a path and the names of the columns they're made of."""

    def __init__(self, path: str, columns: T.StructType, names: HistoryColumns = HistoryColumns()):
        self.path, self.names = path, names
        kinds = {f.name: f.dataType for f in columns}
        who, shop = (T.StructField(c, kinds[c]) for c in (names.customer, names.merchant))
        when = T.StructField(names.ts, kinds[names.ts])
        self.row_schema = T.StructType(
            [who, when, T.StructField(names.amount, T.DoubleType()), *[T.StructField(f, T.BooleanType()) for f in ("failed", "fraud")]]
        )
        sums = [T.StructField(c, T.DataType.fromDDL(kind)) for c, kind in PARTS.items()]
        counts = [T.StructField(c, T.LongType()) for c in ("amount_n", "fraud")]
        self.day_schema = T.StructType([who, T.StructField("day", T.DateType()), *sums, *counts])
        self.first_schema = T.StructType([who, shop, when])
        self.inner = replace(names, failed="failed", fraud="fraud")

    def bare(self, rows: DataFrame, *more: str) -> DataFrame:
        """What the state keeps of rows, and more columns."""
        n = self.names
        flags = [F.coalesce(F.expr(c), F.lit(False)).alias(a) for c, a in ((n.failed, "failed"), (n.fraud, "fraud"))]
        return rows.select(n.customer, n.ts, F.col(n.amount).cast("double").alias(n.amount), *flags, *more)

    def add_days(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(c).cast(kind).alias(c) for c, kind in PARTS.items()]
        return rows.groupBy(self.names.customer, "day").agg(*sums, *[F.sum(c).alias(c) for c in ("amount_n", "fraud")])

    def add_firsts(self, rows: DataFrame) -> DataFrame:
        n = self.names
        return rows.groupBy(n.customer, n.merchant).agg(F.min(n.ts).alias(n.ts))

    def recent(self, spark: SparkSession, days: list[dt.date], before: int) -> DataFrame:
        schema = T.StructType(
            [*self.row_schema.fields, T.StructField("day", T.DateType()), T.StructField("batch", T.LongType())]
        )
        folder = f"{self.path}/rows"
        try:
            found = spark.read.schema(schema).option("basePath", folder).parquet(f"{folder}/day={{{','.join(map(str, days))}}}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            found = spark.createDataFrame([], schema)
        return found.where(F.col("batch") < before).select(*self.row_schema.names)

    def enriched(self, fresh: DataFrame, batch: int, out: MessageColumns, hot_rows: int) -> DataFrame:
        """The batch's rows, numbered in ``_row``, with their features by all rows written before and the batch."""
        n, spark = self.names, fresh.sparkSession
        who = n.customer
        dates = [r[0] for r in fresh.select(F.to_date(n.ts)).distinct().collect() if r[0]]
        days = sorted({d - dt.timedelta(days=k) for d in dates for k in range(REACH_DAYS + 1)})
        own = fresh.select(who).distinct()

        def of_own(df: DataFrame) -> DataFrame:
            return df.alias("s").join(own.alias("o"), _same("s", "o", [who]), "left_semi")

        recent = of_own(self.recent(spark, days, batch)).withColumn("_row", F.lit(None).cast("bigint"))
        timed = self.bare(fresh, "_row").where(F.col(n.ts).isNotNull())
        wanted = ("daily_count", "weekly_count", "max_24h", "failed_count", "prev_fraud", *RUNNING)
        features = customer_profile(recent.unionByName(timed), wanted, self.inner, hot_rows).where("_row IS NOT NULL")

        # Days that no recent row is read of lie before: of those, the sums up to each row's own day.
        totals = of_own(read_generations(spark, f"{self.path}/days", self.day_schema, batch))
        totals = self.add_days(totals.where(~F.col("day").isin(days)) if days else totals)
        ask = features.select(F.col(who), F.to_date(n.ts).alias("asked")).distinct()
        earlier = ask.alias("a").join(totals.alias("t"), _same("a", "t", [who]) & (F.col("t.day") < F.col("a.asked")))
        sums = [F.sum(c).alias(f"_{c}") for c in (*PARTS, "amount_n", "fraud")]
        earlier = earlier.groupBy(F.col(f"a.`{who}`").alias("_who"), "asked").agg(*sums)
        joined = features.join(
            earlier, F.col(who).eqNullSafe(F.col("_who")) & (F.to_date(n.ts) == F.col("asked")), "left"
        )

        def with_past(name: str) -> Column:
            return F.coalesce(F.col(name), F.lit(0)) + F.coalesce(F.col(f"_{name}"), F.lit(0))

        mean = mean_of_parts({c: with_past(c) for c in PARTS}, with_past("amount_n"))
        past_fraud = F.col("prev_fraud") + F.coalesce(F.col("_fraud"), F.lit(0))
        found = joined.select(
            "_row",
            *[F.col(c).alias(f"_f_{c}") for c in ("daily_count", "weekly_count", "max_24h", "failed_count")],
            mean.alias("_f_avg_amount"),
            past_fraud.alias("_f_prev_fraud"),
        )

        firsts = of_own(read_generations(spark, f"{self.path}/firsts", self.first_schema, batch))
        firsts = self.add_firsts(firsts.unionByName(fresh.select(*self.first_schema.names)))
        firsts = firsts.withColumnRenamed(n.ts, "_first")
        keys = [who, n.merchant]
        shops = fresh.alias("r").join(firsts.alias("f"), _same("r", "f", keys), "left")
        new = F.when(F.col(f"r.`{n.ts}`") == F.col("_first"), "Yes").when(F.col(f"r.`{n.ts}`").isNotNull(), "No")
        rows = shops.select("r.*", new.alias("_f_new_merchant")).join(found, "_row", "left")
        filled = {getattr(out, f): F.col(f"_f_{f}") for f in (*FEATURES, "new_merchant")}
        kept = [c for c in fresh.columns if c not in filled and c != "_row"]
        return rows.select(*[F.col(f"`{c}`") for c in kept], *[value.alias(c) for c, value in filled.items()])

    def add(self, fresh: DataFrame, batch: int) -> None:
        """Write what the batch adds to the state; a batch that runs again replaces what it wrote."""
        n = self.names
        rows = self.bare(fresh.where(F.col(n.ts).isNotNull())).withColumn("day", F.to_date(n.ts))
        write_generation(
            self.add_days(
                rows.select(
                    n.customer,
                    "day",
                    *[part.alias(name) for name, part in amount_parts(n.amount).items()],
                    F.col(n.amount).isNotNull().cast("bigint").alias("amount_n"),
                    F.col("fraud").cast("bigint").alias("fraud"),
                )
            ).select(*self.day_schema.names),
            f"{self.path}/days",
            batch,
            self.add_days,
        )
        write_generation(
            self.add_firsts(fresh.where(F.col(n.ts).isNotNull())), f"{self.path}/firsts", batch, self.add_firsts
        )
        writer = rows.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(f"{self.path}/rows")


def enrich_into(
    transactions: DataFrame,
    use: Callable[[DataFrame, int], None],
    path: str,
    checkpoint: str,
    names: HistoryColumns = HistoryColumns(),
    out: MessageColumns = MessageColumns(),
    hot_rows: int = HOT_ROWS,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Fill the history features of every batch by the state of ``path``, hand it to ``use``, then add it to the state.

    A row's features are those of ``customer_profile`` and ``new_merchant`` over all rows that have arrived with its
    batch or before; rows of later batches never change them, rows that come late are seen by all that follow. A
    row without a time gets NULL features and is not kept. ``use`` gets the rows and the number of the batch and
    should replace what a repeated batch wrote before.
    """
    state = CustomerState(path, transactions.schema, names)

    def step(batch: DataFrame, number: int) -> None:
        fresh = batch.withColumn("_row", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            use(state.enriched(fresh, number, out, hot_rows), number)
            state.add(fresh, number)
        finally:
            fresh.unpersist()

    writer = transactions.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger_seconds, available_now).start()
