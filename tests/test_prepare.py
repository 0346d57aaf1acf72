import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyguard.operators import metrics, prepare


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(5000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 9 == 0, 1).when(F.col("id") % 500 == 7, None).otherwise(0).alias("fraud_label"),
    )


def test_split_is_complete_and_stratified(labelled):
    split = prepare.stratified_split(labelled, ["key"]).cache()
    assert split.count() == 5000 and split.select("key").distinct().count() == 5000
    sizes = split.groupBy("fraud_label").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t"))
    for r in sizes.collect():
        assert r["t"] == math.ceil(0.2 * r["n"])


def test_split_does_not_depend_on_the_layout(labelled):
    a = prepare.stratified_split(labelled, ["key"])
    b = prepare.stratified_split(labelled.repartition(13, "fraud_label"), ["key"])
    assert a.exceptAll(b).count() == 0
    assert a.exceptAll(prepare.stratified_split(labelled, ["key"], seed=7)).count() > 0


def test_equal_keys_stay_together(spark):
    df = spark.range(300).select((F.col("id") % 60).alias("key"), F.lit(1).alias("fraud_label"))
    split = prepare.stratified_split(df, ["key"]).groupBy("key").agg(F.countDistinct("split").alias("n"))
    assert split.where("n > 1").count() == 0


def test_scale(spark):
    train = spark.createDataFrame([(1.0, 0.1), (3.0, 0.1), (None, 0.1)], "a double, b double").repartition(3)
    df = spark.createDataFrame([(5.0, 0.7), (None, None)], "a double, b double")
    assert [tuple(r) for r in prepare.standard_scale(train, df, ["a", "b"]).collect()] == [(3.0, 0.0), (None, None)]


@pytest.mark.parametrize("max_rows", [1000, 3])
def test_ordinal_codes_small_and_distributed(spark, max_rows):
    values = [f"v{i:03d}" for i in range(200)]
    rng = np.random.default_rng(1)
    rows = [(v, str(rng.choice(["é", "z", "a", "Z"]))) for v in values * 3] + [(None, None)]
    train = spark.createDataFrame(rows, "a string, b string").repartition(6)
    df = spark.createDataFrame([("v007", "z"), ("v199", "é"), ("new", None), ("v000", "Z")], "a string, b string")
    got = [tuple(r) for r in prepare.ordinal_encode(train, df, ["a", "b"], max_rows).collect()]
    assert sorted(got) == sorted([(7, 2), (199, 3), (-1, -1), (0, 0)])


def test_class_weights_balance(labelled):
    rows = prepare.with_class_weights(labelled.where("fraud_label IS NOT NULL"))
    sums = [r[1] for r in rows.groupBy("fraud_label").agg(F.sum("weight")).collect()]
    assert sums[0] == pytest.approx(sums[1])
    assert sum(sums) == pytest.approx(rows.count())


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 2, 400)
    score = np.round(rng.normal(size=400) + label, 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(label, score)], "label int, score double")
    pos, neg = score[label == 1][:, None], score[label == 0][None, :]
    expected = ((pos > neg).sum() + 0.5 * (pos == neg).sum()) / (pos.size * neg.size)
    assert metrics.roc_auc_value(df) == pytest.approx(expected)
    assert metrics.roc_auc_value(df.where("label = 1")) is None
    assert metrics.roc_auc(df.where("label = 1")).first()[0] is None


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    assert tuple(metrics.binary_metrics(df).first()) == (1.0, 0.0, 0.0, 0.0)


def test_report(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 1 + [(1, 1)] * 2 + [(1, 0)] * 2
    df = spark.createDataFrame(pairs, "label int, prediction int")
    got = {r["name"]: r for r in metrics.classification_report(df).collect()}
    assert got["1"]["precision"] == pytest.approx(2 / 3) and got["1"]["recall"] == 0.5
    assert got["0"]["support"] == 6 and got["accuracy"]["f1"] == pytest.approx(0.7)
    assert got["macro avg"]["recall"] == pytest.approx((5 / 6 + 0.5) / 2)
    assert got["weighted avg"]["recall"] == pytest.approx((5 / 6 * 6 + 0.5 * 4) / 10)


@pytest.mark.parametrize("edge_rows", [100_000, 5, 0])
def test_the_share_holds_when_a_key_repeats(spark, edge_rows):
    rows = [(7 if i % 10 < 3 else i, i, i % 2) for i in range(1000)] + [(None, 2000 + i, None) for i in range(50)]
    df = spark.createDataFrame(rows, "transaction_id int, other int, fraud_label int")
    split = prepare.stratified_split(df, ["transaction_id"], edge_rows=edge_rows)
    shares = {r["fraud_label"]: r["n"] for r in split.where("split = 'test'").groupBy("fraud_label").agg(F.count("*").alias("n")).collect()}
    assert shares == {0: 100, 1: 100, None: 10}


def test_rows_equal_in_every_column_go_together(spark):
    rows = [(1, 0)] * 40 + [(i, 0) for i in range(2, 62)]
    df = spark.createDataFrame(rows, "transaction_id int, fraud_label int")
    split = prepare.stratified_split(df, ["transaction_id"], edge_rows=3)
    assert split.where("transaction_id = 1").select("split").distinct().count() == 1
