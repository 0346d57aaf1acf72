"""Topic to NDJSON files: once from the earliest message, or followed with a kept position."""

from __future__ import annotations

import argparse

from tallyguard.jobs import settings
from tallyguard.session import build_session
from tallyguard.sources.files import export_topic
from tallyguard.sources.topic import read_topic_batch, read_topic_stream, to_bronze
from tallyguard.streaming.ingest import export_topic_stream


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("path", help="folder of NDJSON files, appended to")
    parser.add_argument("--topic", default=settings.TOPIC)
    parser.add_argument("--max", type=int, help="read at most this many messages, once")
    parser.add_argument("--checkpoint", help="position of this reader; the job then reads as a stream")
    parser.add_argument("--only-new", action="store_true", help="first start at the end of the topic")
    parser.add_argument("--follow", action="store_true", help="go on waiting for messages")
    args = parser.parse_args(argv)
    if (args.only_new or args.follow) and not args.checkpoint:
        parser.error("--only-new and --follow need --checkpoint")
    if args.max is not None and args.checkpoint:
        parser.error("--max goes without --checkpoint")
    spark = build_session("tallyguard-export")
    if args.checkpoint:
        starting = "latest" if args.only_new else "earliest"
        messages = read_topic_stream(spark, settings.SERVERS, args.topic, starting)
        query = export_topic_stream(
            to_bronze(messages), args.path, args.checkpoint, available_now=not args.follow
        )
        query.awaitTermination()
    else:
        messages = read_topic_batch(spark, settings.SERVERS, args.topic)
        export_topic(to_bronze(messages), args.path, args.max)
    spark.stop()


if __name__ == "__main__":
    main()
