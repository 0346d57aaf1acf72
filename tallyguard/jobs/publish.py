"""NDJSON files, or the rows of a Parquet table, to the topic; lines that are no JSON go to a folder of rejects."""

from __future__ import annotations

import argparse

from tallyguard.jobs import settings
from tallyguard.session import build_session
from tallyguard.sources.files import ingest_ndjson
from tallyguard.sources.topic import to_messages, write_topic


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("path")
    parser.add_argument("--topic", default=settings.TOPIC)
    parser.add_argument("--table", action="store_true", help="the path is a Parquet table; publish its rows")
    parser.add_argument("--key", default="transaction_id", help="key column of the table")
    parser.add_argument("--max", type=int, help="publish at most this many lines")
    parser.add_argument("--rejects", help="folder for the lines that are no JSON")
    args = parser.parse_args(argv)
    spark = build_session("tallyguard-publish")
    if args.table:
        rows = spark.read.parquet(args.path)
        good, bad = to_messages(rows if args.max is None else rows.limit(args.max), args.key), None
    else:
        good, bad = ingest_ndjson(spark, args.path, args.max)
    write_topic(good, settings.SERVERS, args.topic)
    if args.rejects and bad is not None:
        bad.write.mode("overwrite").json(args.rejects)
    spark.stop()


if __name__ == "__main__":
    main()
