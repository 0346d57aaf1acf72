"""Labelled CSV to profile tables, a Parquet folder each."""

from __future__ import annotations

import argparse

from tallyguard.plans.flows import profile_tables
from tallyguard.session import build_session
from tallyguard.sources.files import read_transactions_csv


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("csv")
    parser.add_argument("out", help="folder for the tables")
    args = parser.parse_args(argv)
    spark = build_session("tallyguard-profile")
    for name, table in profile_tables(read_transactions_csv(spark, args.csv)).items():
        table.write.mode("overwrite").parquet(f"{args.out}/{name}")
    spark.stop()


if __name__ == "__main__":
    main()
