"""Labelled CSV to clean and feature tables, leaderboard and saved model."""

from __future__ import annotations

import argparse

from tallyguard.operators.models import score_batch
from tallyguard.operators.metrics import classification_report
from tallyguard.plans.flows import clean_and_train
from tallyguard.session import build_session
from tallyguard.sources.files import read_transactions_csv, write_csv
from tallyguard.sources.schemas import LABEL


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("csv")
    parser.add_argument("--model-path", required=True)
    parser.add_argument("--clean-path", help="write the clean table here as CSV")
    parser.add_argument("--features-path", help="write the feature table here as CSV")
    args = parser.parse_args(argv)
    spark = build_session("tallyguard-train")
    cleaned, data, board, model = clean_and_train(read_transactions_csv(spark, args.csv))
    if args.clean_path:
        write_csv(cleaned, args.clean_path)
    if args.features_path:
        write_csv(data.train.unionByName(data.test).drop("split"), args.features_path)
    model.save(args.model_path)
    board.show(truncate=False)
    classification_report(score_batch(model, data.test), LABEL, "predicted").show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
