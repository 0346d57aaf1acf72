import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyguard.sources import files, topic
from tallyguard.sources.schemas import BRONZE_SCHEMA, TRANSACTION_SCHEMA


def bronze(spark, *texts):
    rows = [(None, 0, i, str(i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def test_schema_has_all_fields():
    assert len(TRANSACTION_SCHEMA) == 25 and TRANSACTION_SCHEMA.fieldNames()[-1] == "fraud_label"
    kinds = [f.dataType.typeName() for f in TRANSACTION_SCHEMA]
    assert kinds.count("double") == 13 and kinds.count("string") == 12


def test_topic_options():
    options = topic.topic_options("h:9092", "t", minPartitions="64")
    assert options["subscribe"] == "t" and options["startingOffsets"] == "earliest"
    assert options["minPartitions"] == "64" and options["kafka.bootstrap.servers"] == "h:9092"


def test_bronze_absent_empty_filled_forced(spark, tmp_path):
    other = bronze(spark, "other")
    path = str(tmp_path / "bronze")
    assert files.read_bronze(spark, path, lambda: other).first()["raw_json"] == "other"
    with pytest.raises(AnalysisException):
        files.read_bronze(spark, path)
    (tmp_path / "bronze" / "_spark_metadata").mkdir(parents=True)
    assert files.read_bronze(spark, path, lambda: other).first()["raw_json"] == "other"
    full = str(tmp_path / "full")
    bronze(spark, "mine").write.parquet(full)
    assert files.read_bronze(spark, full, lambda: other).first()["raw_json"] == "mine"
    assert files.read_bronze(spark, full, lambda: other, force=True).first()["raw_json"] == "other"
    with pytest.raises(ValueError):
        files.read_bronze(spark, full, force=True)


def test_gold_is_replaced(spark, tmp_path):
    path = str(tmp_path / "gold")
    for n in (1, 2):
        got = files.write_gold(spark.createDataFrame([(n,)], "transaction_count long"), path)
    assert [tuple(r) for r in got.collect()] == [(2,)]


def test_csv_types_missing_words_and_order(spark, tmp_path):
    text = (
        "Fraud_Label,Transaction_ID,Transaction_Amount (in Million),Card_Type,Extra Column\n"
        'Fraud,1,2.5,"a ""quoted"", text",x\n'
        " Normal ,NA,oops,NaN,null\n"
        ",3,nan,  ,y\n"
    )
    (tmp_path / "t.csv").write_text(text)
    df = files.read_transactions_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["fraud_label", "transaction_id", "transaction_amount_million", "card_type", "extra_column"]
    assert [tuple(r) for r in df.collect()] == [
        ("Fraud", 1.0, 2.5, 'a "quoted", text', "x"),
        (" Normal ", None, None, None, None),
        (None, 3.0, None, "  ", "y"),
    ]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", you', 1.5, " a "), (None, None, "b\\n")], "x string, y double, z string")
    files.write_csv(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert sorted(map(str, back.collect())) == sorted(
        map(str, df.withColumn("y", F.col("y").cast("string")).collect())
    )


def test_message_keys_and_nulls(spark):
    df = spark.createDataFrame(
        [(123456.0, None), (12345678.0, "a"), (None, "b"), (1.5, "c")], "transaction_id double, note string"
    )
    got = topic.to_messages(df).collect()
    assert [r["key"] for r in got] == ["123456.0", "12345678.0", None, "1.5"]
    assert json.loads(got[0]["value"]) == {"transaction_id": 123456.0, "note": None}


def test_ndjson_export_skips_nulls_and_appends(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = bronze(spark, '{"a":1}', None, '{"a":2}')
    files.export_topic(rows, path)
    files.export_topic(rows, path, max_rows=2)
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert lines == ['{"a":1}', '{"a":1}', '{"a":2}']


def test_ndjson_ingest_blank_and_bad_lines(spark, tmp_path):
    (tmp_path / "in.ndjson").write_text('{"transaction_id":7.0}\n\n   \nnot json\n{"x":1}\n')
    good, bad = files.ingest_ndjson(spark, str(tmp_path))
    assert sorted(((r["key"] or "", r["value"]) for r in good.collect())) == [
        ("", '{"x":1}'),
        ("7.0", '{"transaction_id":7.0}'),
    ]
    assert [tuple(r) for r in bad.collect()] == [("in.ndjson", "not json")]
    assert files.read_ndjson(spark, str(tmp_path), max_rows=1).count() == 1
