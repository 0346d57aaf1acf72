"""Topic to bronze, until stopped."""

from __future__ import annotations

import argparse

from tallyguard.jobs import settings
from tallyguard.session import build_session, run_until_stopped
from tallyguard.streaming.ingest import TRIGGER_SECONDS, stream_ingest


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--trigger-seconds", type=int, default=TRIGGER_SECONDS)
    args = parser.parse_args(argv)
    spark = build_session("tallyguard-speed")
    query = stream_ingest(
        spark, settings.SERVERS, settings.TOPIC, settings.BRONZE, settings.CHECKPOINT, args.trigger_seconds
    )
    run_until_stopped(spark, query)


if __name__ == "__main__":
    main()
