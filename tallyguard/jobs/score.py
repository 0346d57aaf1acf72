"""Bronze stream to scores and alerts, with a model saved by the train job."""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import functions as F

from tallyguard.jobs import settings
from tallyguard.operators.behaviour import HistoryColumns
from tallyguard.operators.models import FraudModel
from tallyguard.operators.parse import filter_transactions, parse_transactions
from tallyguard.session import build_session, run_until_stopped
from tallyguard.sources.topic import write_topic
from tallyguard.streaming.ingest import TRIGGER_SECONDS, append_files, bronze_stream
from tallyguard.streaming.score import THRESHOLD, alerts_to_topic, score_into, stream_alerts, stream_score
from tallyguard.streaming.summary import event_time

#: Which columns and values of a message make the history.
MESSAGES = HistoryColumns(
    amount="transaction_amount_million", failed="trim(transaction_type) = 'error'", fraud="lower(trim(fraud_label)) = 'fraud'"
)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--model-path", required=True)
    parser.add_argument("--bronze-path", default=settings.BRONZE)
    target = parser.add_mutually_exclusive_group(required=True)
    target.add_argument("--alerts-path")
    target.add_argument("--alerts-topic")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--state-path", help="keep the history of customers here and fill it in before scoring")
    parser.add_argument("--threshold", type=float, default=THRESHOLD)
    parser.add_argument("--trigger-seconds", type=int, default=TRIGGER_SECONDS)
    parser.add_argument("--once", action="store_true", help="stop when all that is there is scored")
    args = parser.parse_args(argv)
    spark = build_session("tallyguard-score")
    transactions = parse_transactions(filter_transactions(bronze_stream(spark, args.bronze_path)))
    model = FraudModel.load(args.model_path)
    pace = {"trigger_seconds": args.trigger_seconds, "available_now": args.once}
    send = partial(write_topic, servers=settings.SERVERS, topic=args.alerts_topic) if args.alerts_topic else None
    if args.state_path:
        timed = transactions.withColumn("ts", event_time(F.col("transaction_date"), F.col("transaction_time")))
        query = score_into(
            model, timed, args.alerts_path, args.state_path, args.checkpoint, MESSAGES, threshold=args.threshold, send=send, **pace
        )
        return run_until_stopped(spark, query)
    alerts = stream_alerts(stream_score(model, transactions), args.threshold)
    if send:
        query = alerts_to_topic(alerts, send, args.checkpoint, **pace)
    else:
        query = append_files(alerts, args.alerts_path, args.checkpoint, **pace)
    run_until_stopped(spark, query)


if __name__ == "__main__":
    main()
