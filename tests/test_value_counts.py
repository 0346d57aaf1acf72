"""Profiles from counted values equal the profiles of the rows, with two scans of the file."""

import math

import pytest
from pyspark.sql import functions as F

from tallyguard.operators import profile
from tallyguard.operators.value_counts import ValueCounts
from tallyguard.plans.flows import profile_tables
from tallyguard.sources.files import read_transactions_csv
from tallyguard.sources.schemas import RATE_COLUMNS, TRANSACTION_SCHEMA

AMOUNT = "transaction_amount_million"


@pytest.fixture(scope="module")
def csv(spark, tmp_path_factory):
    """Transactions with gaps, ties, odd dates, missing and padded labels and a hot category."""
    k = F.col("id")
    numbers = {f.name: F.when(k % 7 != 3, (k * 37 % 101) / 8) for f in TRANSACTION_SCHEMA.fields if f.dataType.typeName() == "double"}
    texts = {f.name: F.when(k % 11 != 0, F.concat(F.lit("v"), k % 5)) for f in TRANSACTION_SCHEMA.fields if f.dataType.typeName() == "string"}
    dates = F.when(k % 13 == 0, F.lit("bad")).otherwise(F.date_format(F.date_add(F.lit("2025-01-01").cast("date"), (k % 90).cast("int")), "yyyy-MM-dd"))
    label = F.when(k % 17 == 0, F.lit(None)).when(k % 4 == 0, F.lit(" Fraud ")).otherwise(F.lit("Normal"))
    others = {"transaction_date": dates, "fraud_label": label, "card_type": F.when(k % 3 == 0, F.lit("hot")).otherwise(k.cast("string"))}
    path = str(tmp_path_factory.mktemp("profile") / "csv")
    spark.range(600).select(*[c.alias(n) for n, c in (numbers | texts | others).items()]).write.option("header", True).csv(path)
    return path


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_tables_equal_those_over_the_rows(spark, csv):
    df = read_transactions_csv(spark, csv).cache()
    counts = ValueCounts(df)
    assert rows_of(counts.shape()) == rows_of(profile.profile_shape(df))
    assert rows_of(counts.missing()) == rows_of(profile.missing_counts(df))
    assert rows_of(counts.cardinality()) == rows_of(profile.cardinality(df))
    assert rows_of(counts.labels()) == rows_of(profile.label_distribution(df))
    assert rows_of(counts.imbalance()) == rows_of(profile.imbalance_ratio(df))
    assert rows_of(counts.rates(RATE_COLUMNS)) == rows_of(profile.fraud_rate_by(df, RATE_COLUMNS))
    assert rows_of(counts.trend("transaction_date")) == rows_of(profile.monthly_trend(df, "transaction_date"))
    assert rows_of(counts.crosstab("previous_fraud_count")) == rows_of(profile.crosstab_pct(df, "previous_fraud_count"))
    assert rows_of(counts.outliers(AMOUNT)) == rows_of(profile.iqr_outliers(df, AMOUNT))
    mine = {r["column"]: r for r in counts.numbers().collect()}
    for r in profile.describe_numeric(df).collect():
        for name, value in r.asDict().items():
            got = mine[r["column"]][name]
            assert got == (pytest.approx(value, rel=1e-12) if isinstance(value, float) else value), (r["column"], name)
    df.unpersist()


def test_the_file_is_scanned_twice(spark, csv):
    df = read_transactions_csv(spark, csv)

    def scans(table):
        return table._jdf.queryExecution().executedPlan().toString().count("FileScan csv")

    assert scans(ValueCounts(df).made_from) == 1
    per_table = {name: scans(t) for name, t in profile_tables(df).items()}
    assert per_table.pop("correlations") == 1 and set(per_table.values()) == {0}


def test_odd_numbers_and_types(spark):
    rows = [(0.1, 0.1, 0.0, None, "Fraud"), (0.1, 2.5, -0.0, None, None), (3.5, math.nan, 1e300, None, "Normal"), (None, 1.0, 5e-324, None, "x")]
    df = spark.createDataFrame(rows, "f float, d double, z double, `no ne` int, fraud_label string")
    counts = ValueCounts(df)
    mine = {r["column"]: r for r in counts.numbers().collect()}
    for r in profile.describe_numeric(df).collect():
        got = mine[r["column"]]
        for name in ("count", "min", "q25", "q50", "q75", "max"):
            same = got[name] == r[name] or (isinstance(r[name], float) and math.isnan(r[name]) and math.isnan(got[name]))
            assert same, (r["column"], name, got[name], r[name])
    assert rows_of(counts.cardinality()) == rows_of(profile.cardinality(df))


def test_empty_table(spark):
    df = spark.createDataFrame([], TRANSACTION_SCHEMA)
    counts = ValueCounts(df)
    assert {tuple(r)[2:4] for r in counts.shape().collect()} == {(0, 0)}
    assert rows_of(counts.missing()) == rows_of(counts.cardinality()) == rows_of(counts.labels()) == []
    assert rows_of(counts.imbalance()) == [(0, None)]
    assert rows_of(counts.outliers(AMOUNT)) == rows_of(profile.iqr_outliers(df, AMOUNT))
    assert {tuple(r)[1:] for r in counts.numbers().collect()} == {(0, *[None] * 7)}
