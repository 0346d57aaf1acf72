"""Bronze, or the topic where bronze is absent or empty, to the gold summary."""

from __future__ import annotations

import argparse

from tallyguard.jobs import settings
from tallyguard.plans.flows import bronze_to_gold
from tallyguard.session import build_session
from tallyguard.sources.files import read_bronze, write_gold
from tallyguard.sources.topic import read_topic_batch, to_bronze


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--from-kafka", action="store_true", help="read the topic even where bronze exists")
    parser.add_argument("--bronze-path", default=settings.BRONZE)
    parser.add_argument("--gold-path", default=settings.GOLD)
    args = parser.parse_args(argv)
    spark = build_session("tallyguard-batch")
    bronze = read_bronze(
        spark,
        args.bronze_path,
        fallback=lambda: to_bronze(read_topic_batch(spark, settings.SERVERS, settings.TOPIC)),
        force=args.from_kafka,
    )
    write_gold(bronze_to_gold(bronze), args.gold_path).show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
