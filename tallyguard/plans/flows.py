"""Flows made of operators: bronze to gold, labelled table to model, topic to scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.numeric import numeric_columns
from tallyguard.operators import models, profile
from tallyguard.operators.clean import clean_table
from tallyguard.operators.features import FeatureColumns, feature_table, median_hour
from tallyguard.operators.parse import parse_for_summary, select_features
from tallyguard.operators.prepare import stratified_split
from tallyguard.operators.profile import gold_summary
from tallyguard.operators.value_counts import ValueCounts
from tallyguard.session import stage
from tallyguard.sources.schemas import CORRELATED_COLUMNS, LABEL, RATE_COLUMNS


def bronze_to_gold(bronze: DataFrame) -> DataFrame:
    """Parse once and summarise the messages that are transactions."""
    return gold_summary(parse_for_summary(bronze), present="transaction_id")


def profile_tables(
    df: DataFrame,
    amount: str = "transaction_amount_million",
    date: str = "transaction_date",
    earlier: str = "previous_fraud_count",
) -> dict[str, DataFrame]:
    """The profile of a labelled table by name: shape, gaps, distributions, correlations, rates, outliers, trend.

    The table is scanned twice: once for the counts of all values, once for the correlations.
    """
    counts = ValueCounts(df)
    quartiles = counts.quantiles(numeric_columns(df))
    return {
        "shape": counts.shape(),
        "missing": counts.missing(),
        "numbers": counts.numbers(quartiles),
        "labels": counts.labels(),
        "imbalance": counts.imbalance(),
        "cardinality": counts.cardinality(),
        "correlations": profile.corr_matrix(df, CORRELATED_COLUMNS),
        "rates": counts.rates(RATE_COLUMNS),
        "outliers": counts.outliers(amount, quartiles),
        "trend": counts.trend(date),
        "earlier_frauds": counts.crosstab(earlier),
    }


@dataclass
class TrainingSet:
    """The feature table split in two, with what scoring needs later."""

    train: DataFrame
    test: DataFrame
    numeric: list[str]
    categorical: list[str]
    hour_fill: float | None

    def matrices(self) -> models.Matrices:
        return models.prepare_matrices(self.train, self.test, self.numeric, self.categorical)


def training_set(
    cleaned: DataFrame,
    key: Sequence[str] = ("transaction_id",),
    names: FeatureColumns = FeatureColumns(),
    exclude: Sequence[str] = (),
) -> TrainingSet:
    """Features and split, written once, since fits and scores read them many times."""
    fill = median_hour(cleaned, names.time)
    split = stratified_split(feature_table(cleaned, names, hour_fill=fill), key)
    _, numeric, categorical = select_features(split.drop("split", *exclude))
    held = stage(split, "feature_table")
    train, test = (held.where(F.col("split") == part) for part in ("train", "test"))
    return TrainingSet(train, test, numeric, categorical, fill)


def train_best(data: TrainingSet) -> tuple[DataFrame, models.FraudModel]:
    """Leaderboard of all candidates and the winner fitted anew."""
    ready = data.matrices()
    try:
        shortlist = models.candidates(ready.rows)
        board = models.leaderboard(ready, shortlist)
        return board, models.fit_final(board, ready, shortlist, data.hour_fill)
    finally:
        ready.release()


def clean_and_train(raw: DataFrame, key: Sequence[str] = ("transaction_id",)):
    """Raw labelled table to (clean table, feature split, leaderboard, model)."""
    cleaned = stage(clean_table(raw, LABEL), "clean_table")
    data = training_set(cleaned, key)
    board, model = train_best(data)
    return cleaned, data, board, model
