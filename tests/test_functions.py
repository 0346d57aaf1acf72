import datetime as dt
import math

from pyspark.sql import functions as F

from tallyguard.functions import dates, labels, numeric, text
from tallyguard.sources.schemas import snake_name


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_strip_takes_all_white_space_and_leaves_the_inside(spark):
    texts = ["\t a b \n", "\xa0x ", "   ", "", None, "　y\x1c"]
    got = [r[0] for r in one(spark, [(t,) for t in texts], "t string", text.strip(F.col("t")))]
    assert got == [t.strip() if t is not None else None for t in texts]


def test_yes_no_flag(spark):
    words = ["Yes", " y ", "TRUE", "1", "no", "N", "false\n", "0", "maybe", "", None]
    got = [r[0] for r in one(spark, [(w,) for w in words], "w string", text.yes_no_flag(F.col("w")))]
    assert got == [1.0] * 4 + [0.0] * 4 + [None] * 3


def test_label_modes(spark):
    rows = [("Fraud",), (" Fraud ",), (" FRAUD",), ("Normal",), (None,)]
    flags = [labels.fraud_flag(F.col("l"), m) for m in ("exact", "strip", "fold")]
    assert one(spark, rows, "l string", *flags) == [(1, 1, 1), (0, 1, 1), (0, 0, 1), (0, 0, 0), (0, 0, 0)]


def test_time_of_day(spark):
    rows = [("09:05",), ("9:05",), ("25:99",), (None,), ("23:59",), ("7:60",), ("12:5",), ("12:30 ",), ("x",)]
    got = one(spark, rows, "t string", dates.hour_of(F.col("t")), dates.minute_of(F.col("t")))
    assert got == [(9, 5), (9, 5), (None, None), (None, None), (23, 59), (None, None), (12, 5)] + [(None, None)] * 2


def test_dates_and_half_hours(spark):
    rows = [("2025-03-01", 12.5, 15.0), ("n/a", 1.0, 0.0), (None, 1.0, 0.0)]
    day = dates.parse_date(F.col("d"))
    moment = dates.combine_datetime(day, F.col("h"), F.col("m"))
    got = one(spark, rows, "d string, h double, m double", moment, dates.is_weekend(day), dates.is_night(F.col("h")))
    assert got[0] == (dt.datetime(2025, 3, 1, 12, 45), 1, 0)
    assert got[1] == (None, 0, 1) and got[2] == (None, 0, 1)


def test_missing_hour_is_no_night(spark):
    assert one(spark, [(None,), (22.0,), (5.5,), (6.0,)], "h double", dates.is_night(F.col("h"))) == [
        (0,),
        (1,),
        (1,),
        (0,),
    ]


def test_start_of_interval_before_1970(spark):
    got = one(spark, [(-1,), (0,), (dates.DAY_US,)], "u long", dates.start_of(F.col("u"), dates.DAY_US))
    assert got == [(-dates.DAY_US,), (0,), (dates.DAY_US,)]


def test_amounts(spark):
    rows = [(3.0, 0.0), (-1.0, 2.0), (None, 2.0)]
    got = one(
        spark,
        rows,
        "a double, b double",
        numeric.log1p_amount(F.col("a")),
        numeric.guarded_ratio(F.col("a"), F.col("b")),
    )
    assert math.isclose(got[0][0], math.log(4)) and math.isclose(got[0][1], 3e6)
    assert got[1][0] == 0.0 and got[2] == (None, None)


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (1.0, None)], "a double, b string")
    assert [tuple(r) for r in numeric.nan_to_null(df).collect()] == [(None, "x"), (1.0, None)]


def test_column_names():
    assert snake_name("Transaction_Amount (in Million)") == "transaction_amount_million"
    assert snake_name("Max_Transaction_Last_24h (in Million)") == "max_transaction_last_24h_million"
    assert snake_name("Fraud_Label") == "fraud_label"
