"""Message filter, typed parse, label rules and column selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.functions.labels import fraud_flag, known_label
from tallyguard.functions.numeric import numeric_columns, text_columns
from tallyguard.functions.text import fold, strip
from tallyguard.sources.schemas import LABEL, NON_FEATURES, TRANSACTION_SCHEMA

PERMISSIVE = {"mode": "PERMISSIVE"}


def filter_transactions(bronze: DataFrame, payload: str = "raw_json") -> DataFrame:
    """Keep the messages whose JSON holds a transaction id, of whatever type, that is not null."""
    return bronze.where(F.get_json_object(payload, "$.transaction_id").isNotNull())


def parse_transactions(
    bronze: DataFrame, payload: str = "raw_json", schema: T.StructType = TRANSACTION_SCHEMA
) -> DataFrame:
    """Typed columns next to the raw text; a value of the wrong type gives NULL."""
    parsed = F.from_json(payload, schema, PERMISSIVE).alias("t")
    return bronze.select(F.col(payload).alias("raw_json"), parsed).select("raw_json", "t.*")


def parse_for_summary(
    bronze: DataFrame, payload: str = "raw_json", amount: str = "transaction_amount_million"
) -> DataFrame:
    """The id as text, the label and the amount of every message.

    The id follows the rule of ``filter_transactions``, its path in the JSON; it is NULL where there is no
    transaction. Label and amount come from one typed parse.
    """
    schema = T.StructType(
        [
            T.StructField(LABEL, T.StringType()),
            T.StructField(amount, T.DoubleType()),
        ]
    )
    parsed = F.from_json(payload, schema, PERMISSIVE).alias("t")
    found = F.get_json_object(payload, "$.transaction_id").alias("transaction_id")
    return bronze.select(found, parsed).select("transaction_id", "t.*")


def with_fraud_flag(df: DataFrame, label: str | Column = LABEL, mode: str = "exact") -> DataFrame:
    column = F.col(label) if isinstance(label, str) else label
    return df.withColumn("is_fraud", fraud_flag(column, mode))


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip every text column; other columns stay as they are."""
    return df.withColumns({c: strip(F.col(f"`{c}`")) for c in text_columns(df)})


def binarize_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Keep the rows labelled fraud or normal and put 1 or 0 in place of the label."""
    kept = df.where(known_label(F.col(label)))
    return kept.withColumn(label, F.when(fold(F.col(label)) == "fraud", 1).otherwise(0))


def label_exclusions(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: rows without a label, rows with an invalid one, rows kept."""
    known = known_label(F.col(label))
    return df.agg(
        F.count_if(F.col(label).isNull()).alias("missing"),
        F.count_if(~known).alias("invalid"),
        F.count_if(known).alias("kept"),
    )


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Remove full-row copies. Copies within a task merge before the shuffle."""
    return df.dropDuplicates()


def select_features(
    df: DataFrame, drop: tuple[str, ...] = NON_FEATURES, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, list[str], list[str]]:
    """The feature columns, and their names split into numeric and categorical.

    ``keep`` carries columns such as the label along without counting them as features.
    """
    candidates = [c for c in df.columns if c not in drop]
    numbers = set(numeric_columns(df))
    texts = set(text_columns(df))
    numeric = [c for c in candidates if c in numbers]
    categorical = [c for c in candidates if c in texts]
    return df.select(*keep, *numeric, *categorical), numeric, categorical


def head_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first n rows in a stated order."""
    return df.orderBy(*order).limit(n)
