"""Calendar, cyclic, flag and ratio features."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.functions import dates
from tallyguard.functions.numeric import guarded_ratio, log1p_amount
from tallyguard.functions.text import yes_no_flag
from tallyguard.sources.schemas import YES_NO_COLUMNS

# The names of the feature columns.
NEW_COLUMNS = (
    "transaction_dt",
    "order_date_dt",
    "hour",
    "minute",
    "day_of_week",
    "day_of_month",
    "month",
    "quarter",
    "is_weekend",
    "is_night",
    "hour_sin",
    "hour_cos",
    "dow_sin",
    "dow_cos",
    *[f"{c}_num" for c in YES_NO_COLUMNS],
    "log_transaction_amount",
    "amount_vs_avg_ratio",
    "amount_vs_max24_ratio",
)


@dataclass(frozen=True)
class FeatureColumns:
    """Names of the input columns and the date format."""

    date: str = "transaction_date"
    time: str = "transaction_time"
    amount: str = "transaction_amount_million"
    average: str = "avg_transaction_amount_million"
    maximum: str = "max_transaction_last_24h_million"
    date_format: str = "yyyy-MM-dd"

    def as_dict(self) -> dict[str, str]:
        return asdict(self)


def median_hour(df: DataFrame, time: str = "transaction_time") -> float | None:
    """Median of the readable hours, the fill for unreadable ones. Only 24 values are possible, so the
    built-in exact median has a small state."""
    return df.agg(F.median(dates.hour_of(F.col(time)))).first()[0]


def filled_time(time: Column, hour_fill: float | None) -> tuple[Column, Column]:
    """Hour and minute as DOUBLE; an unreadable time gives the median hour and minute 0."""
    hour = F.coalesce(dates.hour_of(time).cast("double"), F.lit(hour_fill).cast("double"))
    minute = F.coalesce(dates.minute_of(time).cast("double"), F.lit(0.0))
    return hour, minute


def fill_time(df: DataFrame, time: str = "transaction_time", hour_fill: float | None = None) -> DataFrame:
    fill = median_hour(df, time) if hour_fill is None else hour_fill
    hour, minute = filled_time(F.col(time), fill)
    return df.withColumns({"hour": hour, "minute": minute})


def calendar_features(df: DataFrame, date: str) -> DataFrame:
    """Day of week (Monday 0), day of month, month, quarter and weekend flag of a DATE column."""
    d = F.col(date)
    return df.withColumns(
        {
            "day_of_week": F.weekday(d),
            "day_of_month": F.day(d),
            "month": F.month(d),
            "quarter": F.quarter(d),
            "is_weekend": dates.is_weekend(d),
        }
    )


def cyclic_encode(df: DataFrame, hour: str = "hour", day_of_week: str = "day_of_week") -> DataFrame:
    hour_sin, hour_cos = dates.cycle(F.col(hour), 24.0)
    dow_sin, dow_cos = dates.cycle(F.col(day_of_week), 7.0)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "dow_sin": dow_sin, "dow_cos": dow_cos})


def feature_table(
    df: DataFrame,
    names: FeatureColumns = FeatureColumns(),
    hour_fill: float | None = None,
    flags: tuple[str, ...] = YES_NO_COLUMNS,
) -> DataFrame:
    """The table with the derived columns added.

    Everything but the median hour is a projection. With a given ``hour_fill``, kept from training, it
    also serves a stream.
    """
    fill = median_hour(df, names.time) if hour_fill is None else hour_fill
    hour, minute = filled_time(F.col(names.time), fill)
    dated = df.withColumns(
        {
            "order_date_dt": dates.parse_date(F.col(names.date), names.date_format),
            "hour": hour,
            "minute": minute,
        }
    )
    amount = F.col(names.amount)
    timed = dated.withColumns(
        {
            "transaction_dt": dates.combine_datetime(F.col("order_date_dt"), F.col("hour"), F.col("minute")),
            "is_night": dates.is_night(F.col("hour")),
            **{f"{c}_num": yes_no_flag(F.col(c)) for c in flags},
            "log_transaction_amount": log1p_amount(amount),
            "amount_vs_avg_ratio": guarded_ratio(amount, F.col(names.average)),
            "amount_vs_max24_ratio": guarded_ratio(amount, F.col(names.maximum)),
        }
    )
    full = cyclic_encode(calendar_features(timed, "order_date_dt"))
    added = [c for c in NEW_COLUMNS if c in full.columns]
    return full.select(*df.columns, *added)
