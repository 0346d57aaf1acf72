"""The gold summary kept up to date, by windows of event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard.functions.labels import fraud_flag
from tallyguard.operators.behaviour import PARTS, amount_parts, mean_of_parts
from tallyguard.sources.schemas import LABEL
from tallyguard.streaming.generations import read_generations, write_generation
from tallyguard.streaming.ingest import TRIGGER_SECONDS, triggered

COUNTS = ("transaction_count", "fraud_count", "amount_count")


def event_time(date: Column, time: Column) -> Column:
    """TIMESTAMP from a date text and an ``HH:MM`` text; NULL where unreadable."""
    return F.try_to_timestamp(F.concat_ws(" ", date, time), F.lit("yyyy-MM-dd H:m"))


def summary_into(
    transactions: DataFrame,
    path: str,
    checkpoint: str,
    ts: str,
    size: str = "1 day",
    slide: str | None = None,
    label: str = LABEL,
    amount: str = "transaction_amount_million",
    mode: str = "exact",
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the summary of every window up to date; late rows revise theirs, however late they are.

    Each batch writes its own counts and exact sums by window into its own folder, which a repeated batch
    replaces; folders are merged now and then, so that few are left, and ``read_summary`` adds those up.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        moment = F.col(ts).cast("timestamp")
        window = F.window(moment, size, slide) if slide else F.window(moment, size)
        partial = batch.where(moment.isNotNull()).groupBy(window.alias("w")).agg(
            F.count("*").alias("transaction_count"),
            F.sum(fraud_flag(F.col(label), mode)).alias("fraud_count"),
            F.count(amount).alias("amount_count"),
            *[F.sum(part).cast(PARTS[name]).alias(name) for name, part in amount_parts(amount).items()],
        )
        write_generation(partial.select("w.start", "w.end", *COUNTS, *PARTS), path, batch_id, merged)

    writer = transactions.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger_seconds, available_now).start()


def merged(rows: DataFrame) -> DataFrame:
    """One row per window from those of several batches."""
    sums = [F.sum(c).alias(c) for c in COUNTS] + [F.sum(c).cast(kind).alias(c) for c, kind in PARTS.items()]
    return rows.groupBy("start", "end").agg(*sums)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, window_end, transaction_count, fraud_count, avg_amount_million) of all windows so far."""
    schema = "start timestamp, end timestamp, " + ", ".join(f"{c} bigint" for c in COUNTS)
    schema += "".join(f", {c} {kind}" for c, kind in PARTS.items())
    return merged(read_generations(spark, path, schema)).select(
        F.col("start").alias("window_start"),
        F.col("end").alias("window_end"),
        "transaction_count",
        "fraud_count",
        mean_of_parts({c: F.col(c) for c in PARTS}, F.col("amount_count")).alias("avg_amount_million"),
    )
