"""Customer profile on the stream."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tallyguard.functions.dates import DAY_US, WEEK_US
from tallyguard.operators.behaviour import HOT_ROWS, HistoryColumns, customer_profile
from tallyguard.streaming.generations import PART, read_generations, write_generation
from tallyguard.streaming.ingest import TRIGGER_SECONDS, triggered

# How far back each feature looks, in microseconds.
REACH = {"daily_count": DAY_US, "max_24h": DAY_US, "failed_count": DAY_US, "weekly_count": WEEK_US}


def daily_counts_into(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    customer: str = "customer_id",
    ts: str = "ts",
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Count transactions by customer and day; each batch writes its own counts, late rows are counted too.

    Folders of batches are merged into larger ones, so that few are left to read.
    """

    def added(counts: DataFrame) -> DataFrame:
        return counts.groupBy(customer, "day").agg(F.sum("n").alias("n"))

    def step(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(customer, F.to_date(ts).alias("day")).agg(F.count("*").alias("n"))
        write_generation(counts, path, batch_id, added)

    writer = transactions.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger_seconds, available_now).start()


def read_daily_counts(spark: SparkSession, path: str, customer: str = "customer_id", kind: str = "double") -> DataFrame:
    """(customer, day, n) over all batches so far."""
    written = read_generations(spark, path, f"`{customer}` {kind}, day date, n bigint")
    return written.groupBy(customer, "day").agg(F.sum("n").alias("n"))


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


# Columns that the table keeps beside a row and its features: its day, how many such rows there are, the batch.
DAY, COPIES, BATCH = "_day", "_copies", "_batch"


def stored_schema(spark: SparkSession, columns: T.StructType, wanted: Sequence[str], names: HistoryColumns) -> T.StructType:
    """The rows' own columns, their features, and the three columns of the table."""
    profiled = customer_profile(spark.createDataFrame([], columns), wanted, names).schema
    kept = [T.StructField(DAY, T.DateType()), T.StructField(COPIES, T.LongType()), T.StructField(BATCH, T.LongType())]
    return T.StructType([*columns.fields, *[profiled[f] for f in wanted], *kept])


def newest_records(written: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Equal rows share one record; of the records of a row, that of the newest batch."""
    others = [c for c in written.columns if c not in columns]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), BATCH).alias("newest")
    return written.groupBy(*[f"`{c}`" for c in columns]).agg(newest).select(*[f"`{c}`" for c in columns], "newest.*")


def _repeated(records: DataFrame) -> DataFrame:
    """Each record as often as there are such rows."""
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(COPIES)))
    return records.withColumn("_time", times).drop("_time")


def profile_stream(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    wanted: Sequence[str] = ("daily_count", "max_24h"),
    names: HistoryColumns = HistoryColumns(),
    hot_rows: int = HOT_ROWS,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Rows with trailing features, kept right as rows come in, late ones too.

    The output is the history, a generation table with a folder per day. A batch reads, for its own customers
    only, the days that its rows' frames reach and the days whose frames reach its rows, and writes its rows and
    those older rows whose features a late row has changed, nothing else; ``read_profile`` takes the newest record
    of each row. Equal rows are one record with a count, −0.0 being equal to 0.0. A repeated batch replaces what it
    wrote. Rows without a time have no day and are left out.
    """
    if unknown := set(wanted) - set(REACH):
        raise ValueError(f"features {sorted(unknown)} look back without a bound and can't be kept on a stream")
    wanted = list(wanted)
    reach = max(REACH[f] for f in wanted) // DAY_US
    columns, who = transactions.columns, names.customer
    stored = stored_schema(transactions.sparkSession, transactions.schema, wanted, names)
    own_columns = [F.col(f"`{c}`") for c in columns]

    def newest(written: DataFrame) -> DataFrame:
        return newest_records(written, columns).select(*[f"`{c}`" for c in stored.names])

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.where(F.col(names.ts).isNotNull()).withColumn(DAY, F.to_date(names.ts))
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            dates = [r[DAY] for r in fresh.select(DAY).distinct().collect()]
            days = {str(d + dt.timedelta(days=k)) for d in dates for k in range(-reach, reach + 1)}
            if not days:
                return
            later = F.explode(F.sequence(F.lit(0), F.lit(reach))).alias("later")
            touched = fresh.select(who, DAY, later).select(who, F.date_add(DAY, F.col("later")).alias(DAY)).distinct()
            history = read_generations(spark, path, stored, before=batch_id, partitioned=True, parts=days)
            own = fresh.select(who).distinct()
            history = newest(history.alias("h").join(own.alias("o"), _same("h", "o", [who]), "left_semi"))
            before = F.struct(*[F.col(f) for f in wanted], F.col(COPIES)).alias("_before")
            known = _repeated(history.select(*own_columns, COPIES, before)).select(*own_columns, "_before")
            arrived = fresh.select(*own_columns, F.lit(None).cast(known.schema["_before"].dataType).alias("_before"))
            rows = customer_profile(known.unionByName(arrived), wanted, names, hot_rows)
            rows = rows.withColumn(DAY, F.to_date(names.ts))
            near = rows.alias("r").join(touched.alias("t"), _same("r", "t", [who, DAY]), "left_semi")
            now = near.groupBy(*own_columns, DAY).agg(
                *[F.first(f).alias(f) for f in wanted], F.count("*").alias(COPIES), F.max("_before").alias("_before")
            )
            same = F.struct(*wanted, COPIES).eqNullSafe(F.col("_before"))
            changed = now.where(~same).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            write_generation(changed.select(*[f"`{c}`" for c in stored.names]), path, batch_id, newest, partition=DAY)
        finally:
            fresh.unpersist()

    writer = transactions.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger_seconds, available_now).start()


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """All rows with their features as they are now; none but an error before the first batch with rows."""
    schema = spark.read.parquet(f"{path}/g*/{PART}=*").schema
    columns = [c for c in schema.names if c not in (*REACH, DAY, COPIES, BATCH)]
    written = read_generations(spark, path, schema, partitioned=True)
    return _repeated(newest_records(written, columns)).drop(DAY, COPIES, BATCH)
