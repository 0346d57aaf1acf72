from pyspark.sql import functions as F

from tallyguard.operators import clean, features
from tallyguard.operators.profile import missing_counts
from tallyguard.plans.tables import Tables


def test_medians_make_doubles_and_keep_the_rest(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (4, 3.0), (None, None)], "a int, b double")
    got = [tuple(r) for r in clean.impute_median(df).orderBy("b", "a").collect()]
    assert sorted(got) == [(1.0, 1.0), (2.0, 2.0), (2.0, 2.0), (4.0, 3.0)]
    assert dict(clean.impute_median(df).dtypes)["a"] == "double"
    assert clean.fit_medians(df, exclude=["a"]) == {"b": 2.0}


def test_mode_tie_and_empty_column(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", None), ("b", None), (None, None)], "x string, y string")
    assert clean.fit_modes(df) == {"x": "a", "y": "Inconnu"}
    got = clean.impute_mode(df).collect()
    assert {r["y"] for r in got} == {"Inconnu"} and sorted(r["x"] for r in got) == ["a", "a", "a", "b", "b"]


def test_clean_table_is_complete_and_stable(spark, tables: Tables):
    once = clean.clean_table(tables.transactions().drop("ts")).cache()
    assert missing_counts(once).count() == 0
    assert once.count() == once.dropDuplicates().count()
    again = clean.clean_table(
        once.withColumn("fraud_label", F.when(F.col("fraud_label") == 1, "Fraud").otherwise("Normal"))
    )
    assert once.exceptAll(again).count() == 0 and again.exceptAll(once).count() == 0


def test_fill_time_with_half_hour_median(spark):
    df = spark.createDataFrame([("9:00",), ("10:30",), ("25:99",), (None,)], "transaction_time string")
    got = sorted(tuple(r) for r in features.fill_time(df).select("hour", "minute").collect())
    assert got == [(9.0, 0.0), (9.5, 0.0), (9.5, 0.0), (10.0, 30.0)]


def test_feature_table_has_all_new_columns(tables: Tables):
    enriched = tables.enriched()
    table = features.feature_table(enriched)
    assert table.columns == [*enriched.columns, *features.NEW_COLUMNS]
    assert len(features.NEW_COLUMNS) == 20
    row = table.agg(F.min("hour_sin"), F.max("hour_cos"), F.max("amount_vs_max24_ratio")).first()
    assert row[0] >= -1 and row[1] <= 1 and row[2] <= 1.0
