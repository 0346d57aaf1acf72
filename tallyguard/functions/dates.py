"""Dates and times of day; unreadable text gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hour 0 to 23 and minute 0 to 59, each with one or two digits.
HOUR_MINUTE = r"\A(2[0-3]|[01]?[0-9]):([0-5]?[0-9])\z"

SECOND_US = 1_000_000
DAY_US = 86_400 * SECOND_US
WEEK_US = 7 * DAY_US


def hour_of(text: Column) -> Column:
    """Hour of an ``HH:MM`` text as INT."""
    return F.regexp_extract(text, HOUR_MINUTE, 1).try_cast("int")


def minute_of(text: Column) -> Column:
    """Minute of an ``HH:MM`` text as INT."""
    return F.regexp_extract(text, HOUR_MINUTE, 2).try_cast("int")


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(text, fmt)


def month_bucket(date: Column) -> Column:
    """First day of the calendar month."""
    return F.trunc(date, "month")


def combine_datetime(date: Column, hour: Column, minute: Column) -> Column:
    """Date plus hour and minute as TIMESTAMP_NTZ; the hour may hold a fraction."""
    seconds = F.round(hour * 3600 + minute * 60).cast("bigint")
    return F.timestamp_add("SECOND", seconds, date.cast("timestamp_ntz"))


def is_weekend(date: Column) -> Column:
    return F.when(F.weekday(date) >= 5, 1).otherwise(0)


def is_night(hour: Column) -> Column:
    """1 before 6 and from 22 on, else 0; a missing hour gives 0."""
    return F.when((hour < 6) | (hour >= 22), 1).otherwise(0)


def cycle(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a value's place in its period."""
    angle = value * 2 * F.pi() / period
    return F.sin(angle), F.cos(angle)


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP or TIMESTAMP_NTZ column, for exact range frames."""
    if isinstance(df.schema[ts].dataType, T.TimestampType):
        return F.unix_micros(F.col(ts))
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))


def start_of(moment: Column, width: int) -> Column:
    """Start of the interval of ``width`` microseconds that holds a moment."""
    return moment - F.pmod(moment, F.lit(width))
