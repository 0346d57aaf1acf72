"""Bronze stream to tables that are kept up to date: messages without copies, the gold summary, customer profiles."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyguard.jobs import settings
from tallyguard.jobs.score import MESSAGES
from tallyguard.operators.parse import filter_transactions, parse_transactions
from tallyguard.session import build_session, run_until_stopped
from tallyguard.streaming.dedupe import dedupe_into
from tallyguard.streaming.ingest import TRIGGER_SECONDS, bronze_stream
from tallyguard.streaming.profile import REACH, profile_stream
from tallyguard.streaming.summary import event_time, summary_into

TABLES = ("messages", "summary", "profile")


def timed(bronze: DataFrame) -> DataFrame:
    """Transactions of a bronze stream with the time at which they took place, ``ts``."""
    rows = parse_transactions(filter_transactions(bronze))
    return rows.withColumn("ts", event_time(F.col("transaction_date"), F.col("transaction_time")))


def start(
    spark: SparkSession,
    table: str,
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep one table up to date; each has its own checkpoint, so that one can be built anew without the others."""
    pace = {"trigger_seconds": trigger_seconds, "available_now": available_now}
    if table == "messages":
        return dedupe_into(bronze, path, checkpoint, **pace)
    if table == "summary":
        return summary_into(timed(bronze), path, checkpoint, "ts", **pace)
    if table == "profile":
        return profile_stream(timed(bronze), path, checkpoint, tuple(REACH), MESSAGES, **pace)
    raise ValueError(f"no such table: {table}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("folder", help="where the tables are kept, one folder each")
    parser.add_argument("--tables", nargs="+", choices=TABLES, default=list(TABLES))
    parser.add_argument("--bronze-path", default=settings.BRONZE)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--trigger-seconds", type=int, default=TRIGGER_SECONDS)
    parser.add_argument("--once", action="store_true", help="stop when all that is there is worked in")
    args = parser.parse_args(argv)
    spark = build_session("tallyguard-maintain")
    queries = []
    for table in args.tables:
        source = bronze_stream(spark, args.bronze_path)
        where = f"{args.folder}/{table}", f"{args.checkpoint}/{table}"
        queries.append(start(spark, table, source, *where, args.trigger_seconds, args.once))
        if args.once:
            queries[-1].awaitTermination()
    run_until_stopped(spark, *queries)


if __name__ == "__main__":
    main()
