import pytest
from pyspark.sql import functions as F

from tallyguard.operators import parse
from tallyguard.operators.profile import gold_summary
from tallyguard.plans.flows import bronze_to_gold

PAYLOADS = [
    '{"transaction_id":12.0,"fraud_label":"Fraud","transaction_amount_million":2.0}',
    '{"seq":1,"source":"x"}',
    '{"transaction_id":null}',
    "not json",
    None,
    '{"transaction_id":"abc","transaction_amount_million":"7"}',
    '{"transaction_id":""}',
    '{"transaction_id":1,"fraud_label":"fraud","transaction_amount_million":4.0}',
]


def bronze(spark, payloads=PAYLOADS):
    return spark.createDataFrame([(p,) for p in payloads], "raw_json string")


def test_presence_of_the_id_is_textual(spark):
    kept = parse.parse_transactions(parse.filter_transactions(bronze(spark)))
    assert [r["transaction_id"] for r in kept.collect()] == [12.0, None, None, 1.0]
    assert len(kept.columns) == 26


def test_wrong_type_gives_null(spark):
    kept = parse.parse_transactions(bronze(spark)).where(F.col("raw_json").contains("abc"))
    assert kept.first()["transaction_amount_million"] is None


def test_gold_in_one_parse_equals_the_steps(spark):
    rows = bronze(spark)
    steps = parse.parse_transactions(parse.filter_transactions(rows))
    assert tuple(bronze_to_gold(rows).first()) == tuple(gold_summary(steps).first()) == (4, 1, 3.0)


def test_gold_of_nothing(spark):
    assert tuple(bronze_to_gold(bronze(spark).limit(0)).first()) == (0, None, None)


def test_trim_keeps_blank_as_empty_text_and_numbers(spark):
    df = spark.createDataFrame([(" a\t", "  ", 1), (None, "\xa0b", 2)], "x string, y string, z int")
    once = parse.trim_strings(df)
    assert [tuple(r) for r in once.collect()] == [("a", "", 1), (None, "b", 2)]
    assert once.collect() == parse.trim_strings(once).collect()


def test_binarize_and_report(spark):
    df = spark.createDataFrame(
        [(" FRAUD ",), ("normal",), ("Chargeback",), (None,), ("Fraud",)], "fraud_label string"
    )
    assert sorted(r[0] for r in parse.binarize_label(df).collect()) == [0, 1, 1]
    assert tuple(parse.label_exclusions(df).first()) == (1, 1, 3)


def test_duplicates_with_missing_values(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "a int, b string")
    once = parse.drop_duplicates(df)
    assert once.count() == 2 and parse.drop_duplicates(once).count() == 2


def test_select_features_by_type(spark):
    df = spark.createDataFrame(
        [(1.0, "x", 2, "Yes", 1.0, 1)],
        "transaction_id double, card_type string, month int, is_new_merchant string, is_new_merchant_num double, fraud_label int",
    )
    chosen, numeric, categorical = parse.select_features(df, keep=("fraud_label",))
    assert numeric == ["month", "is_new_merchant_num"]
    assert categorical == ["card_type", "is_new_merchant"]
    assert chosen.columns == ["fraud_label", *numeric, *categorical]


def test_head_rows_is_ordered(spark):
    assert [r[0] for r in parse.head_rows(spark.range(100), 3, F.desc("id")).collect()] == [99, 98, 97]


@pytest.mark.parametrize(
    "text", ['{"transaction_id": 1, "transaction_id": null}', '{"transaction_id": NaN}', '{"transaction_id": "x"}', "{", "[1]", None]
)
def test_gold_counts_the_rows_that_the_filter_keeps(spark, text):
    from tallyguard.plans.flows import bronze_to_gold

    df = spark.createDataFrame([(text,), ('{"transaction_id": 5}',)], "raw_json string")
    assert bronze_to_gold(df).first()["transaction_count"] == parse.filter_transactions(df).count()
