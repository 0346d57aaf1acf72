"""Customer-history features: what a customer did up to each transaction.

Every feature is a function of (customer, instant): frames are ranges of time, so transactions at the
same instant see the same history, the current instant included.

Two plans give the same result, bit for bit: means are of exact decimal sums. Customers with a moderate history use plain range windows, one shuffle
by customer. A customer with more rows than ``hot_rows`` would put them all in one task, with sliding
frames whose cost grows with the square of the frame. Such customers take another way: rows merge by
instant before the shuffle, trailing counts become running totals (+n when it happens, -n when it
leaves the frame), and the trailing maximum is the larger of the head of its own day and the tail of
the day before. Running totals are taken within one-minute chunks, on top of totals over chunks, so
that no task sees more than the minutes of a customer or the instants of a minute.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.functions.dates import DAY_US, SECOND_US, WEEK_US, hour_of, is_night, micros, start_of
from tallyguard.operators.bounded import collect_small

HOT_ROWS = 100_000
CHUNK_US = 60 * SECOND_US
# An amount is the sum of three parts, each of which adds up without regard to the order: below 10^14 a decimal with
# twelve places; from there on its whole part, and the rest as before; NaN, infinite and from 10^28 on, NaN or ±∞.
SMALL, LARGE = 1e14, 1e28
PARTS = {"amount_sum": "decimal(38,12)", "amount_large": "decimal(38,0)", "amount_odd": "double"}

FEATURES = ("daily_count", "weekly_count", "avg_amount", "max_24h", "failed_count", "prev_fraud")
# What avg_amount is made of, for those who add what lies before the rows at hand.
RUNNING = (*PARTS, "amount_n")


@dataclass(frozen=True)
class HistoryColumns:
    """Input columns; ``failed`` and ``fraud`` are SQL conditions, a NULL one counts as false."""

    customer: str = "customer_id"
    ts: str = "ts"
    amount: str = "amount"
    merchant: str = "merchant_id"
    failed: str = "event_type = 'error'"
    fraud: str = "fraud_label = 'Fraud'"

    def flag(self, condition: str) -> Column:
        return F.when(F.expr(condition), 1).otherwise(0).cast("bigint")


def amount_parts(amount: str) -> dict[str, Column]:
    """The parts of an amount, to be summed one by one; NULL where an amount has none."""
    x = F.col(amount).cast("double")
    odd, small = F.isnan(x) | (F.abs(x) >= LARGE), F.abs(x) < SMALL
    return {
        "amount_sum": F.when(~odd, F.when(small, x).otherwise(x % 1.0)).cast("decimal(26,12)"),
        "amount_large": F.when(~odd & ~small, x - x % 1.0).cast("decimal(28,0)"),
        "amount_odd": F.when(odd, F.when(F.isnan(x), x).otherwise(F.signum(x) * F.lit(float("inf")))),
    }


def mean_of_parts(sums: dict[str, Column], count: Column) -> Column:
    """The mean from the sums of the parts; the same, bit for bit, in whatever order they were added up."""
    total = F.lit(0.0)
    for name in PARTS:
        total = total + F.coalesce(sums[name].cast("double"), F.lit(0.0))
    return F.try_divide(total, count)


def _plain_windows(df: DataFrame, names: HistoryColumns, wanted: Sequence[str]) -> DataFrame:
    """``df`` holds ``_us``; range windows by customer."""
    history = Window.partitionBy(names.customer).orderBy("_us")
    to_date = history.rangeBetween(Window.unboundedPreceding, 0)
    last_day = history.rangeBetween(-DAY_US, 0)
    same_day = (
        Window.partitionBy(names.customer, start_of(F.col("_us"), DAY_US))
        .orderBy("_us")
        .rangeBetween(Window.unboundedPreceding, 0)
    )
    makers = {
        "weekly_count": lambda: F.count("*").over(history.rangeBetween(-WEEK_US, 0)),
        "avg_amount": lambda: mean_of_parts(
            {name: F.sum(part).over(to_date) for name, part in amount_parts(names.amount).items()},
            F.count(names.amount).over(to_date),
        ),
        "max_24h": lambda: F.max(names.amount).over(last_day),
        "failed_count": lambda: F.sum(names.flag(names.failed)).over(last_day),
        "prev_fraud": lambda: F.coalesce(
            F.sum(names.flag(names.fraud)).over(history.rangeBetween(Window.unboundedPreceding, -1)),
            F.lit(0).cast("bigint"),
        ),
        "daily_count": lambda: F.count("*").over(same_day),
        "amount_n": lambda: F.count(names.amount).over(to_date),
        **{name: lambda part=part: F.sum(part).over(to_date) for name, part in amount_parts(names.amount).items()},
    }
    return df.withColumns({name: makers[name]() for name in makers if name in wanted})


def _chunked_history(df: DataFrame, names: HistoryColumns) -> DataFrame:
    """(customer, _us, all features), one row per instant of a customer."""
    who = names.customer
    instants = df.groupBy(who, "_us").agg(
        F.count("*").alias("n"),
        *[F.sum(part).alias(name) for name, part in amount_parts(names.amount).items()],
        F.count(names.amount).alias("amount_n"),
        F.max(names.amount).alias("amount_max"),
        F.sum(names.flag(names.failed)).alias("failed"),
        F.sum(names.flag(names.fraud)).alias("fraud"),
    )

    def moment(shift: int, current: bool, **values: Column) -> Column:
        """One entry on the time line; fields that are not named stay empty."""
        kinds = {
            "n": "bigint",
            "week": "bigint",
            "failed": "bigint",
            "fraud": "bigint",
            **PARTS,
            "amount_n": "bigint",
            "head_max": "double",
            "tail_max": "double",
        }
        fields = [values.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]
        return F.struct((F.col("_us") + shift).alias("_us"), F.lit(current).alias("current"), *fields)

    line = instants.select(
        who,
        F.inline(
            F.array(
                moment(
                    0,
                    True,
                    n=F.col("n"),
                    week=F.col("n"),
                    failed=F.col("failed"),
                    fraud=F.col("fraud"),
                    **{name: F.col(name) for name in PARTS},
                    amount_n=F.col("amount_n"),
                    head_max=F.col("amount_max"),
                ),
                moment(WEEK_US + 1, False, week=-F.col("n")),
                moment(DAY_US + 1, False, failed=-F.col("failed")),
                moment(DAY_US, False, tail_max=F.col("amount_max")),
            )
        ),
    )
    line = line.withColumn("chunk", start_of(F.col("_us"), CHUNK_US))
    day = start_of(F.col("chunk"), DAY_US)

    sums = ("week", "failed", "fraud", *PARTS, "amount_n")

    def kind(name: str) -> str:
        return PARTS.get(name, "bigint")

    chunks = line.groupBy(who, "chunk").agg(
        *[F.sum(c).cast(kind(c)).alias(c) for c in ("n", *sums)], F.max("head_max").alias("head_max"), F.max("tail_max").alias("tail_max")
    )
    earlier = Window.partitionBy(who).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    earlier_today = Window.partitionBy(who, day).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    later_today = Window.partitionBy(who, day).orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    before = chunks.select(
        F.col(who).alias("_who"),
        F.col("chunk").alias("_chunk"),
        *[F.sum(c).over(earlier).cast(kind(c)).alias(f"before_{c}") for c in sums],
        F.sum("n").over(earlier_today).alias("before_n"),
        F.max("head_max").over(earlier_today).alias("before_head_max"),
        F.max("tail_max").over(later_today).alias("after_tail_max"),
    )

    within = Window.partitionBy(who, "chunk").orderBy("_us")
    upto = within.rangeBetween(Window.unboundedPreceding, 0)
    strictly = within.rangeBetween(Window.unboundedPreceding, -1)
    onward = Window.partitionBy(who, "chunk").orderBy(F.desc("_us")).rangeBetween(Window.unboundedPreceding, 0)

    def total(name: str, frame=upto) -> Column:
        here, past = F.sum(name).over(frame), F.col(f"before_{name}")
        return F.coalesce(past, F.lit(0)) + F.coalesce(here, F.lit(0))

    same_chunk = F.col(who).eqNullSafe(F.col("_who")) & (F.col("chunk") == F.col("_chunk"))
    solved = line.join(before, same_chunk).select(
        who,
        "_us",
        "current",
        total("n").alias("daily_count"),
        total("week").alias("weekly_count"),
        mean_of_parts({name: total(name) for name in PARTS}, total("amount_n")).alias("avg_amount"),
        F.greatest(
            F.max("head_max").over(upto),
            "before_head_max",
            F.max("tail_max").over(onward),
            "after_tail_max",
        ).alias("max_24h"),
        total("failed").alias("failed_count"),
        total("fraud", strictly).alias("prev_fraud"),
        *[total(name).alias(name) for name in RUNNING],
    )
    return solved.where("current").drop("current")


def hot_customers(df: DataFrame, customer: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Customers with more rows than ``hot_rows``; counts merge before the shuffle."""
    return df.groupBy(customer).agg(F.count("*").alias("n")).where(F.col("n") > hot_rows).select(customer)


def customer_profile(
    df: DataFrame,
    wanted: Sequence[str] = FEATURES,
    names: HistoryColumns = HistoryColumns(),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The rows with the wanted history features added.

    daily_count: transactions of the same day so far. weekly_count: of the last 7 × 24 hours.
    avg_amount: mean amount so far, NaN or infinite from an amount on that is (one of 10^28 or more counts as
    infinite); ``RUNNING`` are its sums and its count. max_24h: largest amount and failed_count: failures of the last 24
    hours. prev_fraud: frauds strictly earlier. Days are those of UTC or, without a zone, of the column.
    """
    every = (*FEATURES, *RUNNING)
    unknown = set(wanted) - set(every)
    if unknown:
        raise ValueError(f"unknown features {sorted(unknown)}")
    who = names.customer
    timed = df.withColumn("_us", micros(df, names.ts))
    out = [*df.columns, *[f for f in every if f in wanted]]

    hot = hot_customers(timed, who, hot_rows)
    known = collect_small(hot)
    if known == []:
        return _plain_windows(timed, names, wanted).select(*out)
    if known is not None:
        hot = F.broadcast(df.sparkSession.createDataFrame(known, hot.schema))

    same = F.col(f"t.{who}").eqNullSafe(F.col(f"h.{who}"))
    cold_rows = timed.alias("t").join(hot.alias("h"), same, "left_anti")
    hot_rows_df = timed.alias("t").join(hot.alias("h"), same, "left_semi")
    cold = _plain_windows(cold_rows, names, wanted).select(*out)
    history = _chunked_history(hot_rows_df, names).select(
        F.col(who).alias("_who"), F.col("_us").alias("_at"), *[f for f in every if f in wanted]
    )
    warm = hot_rows_df.join(
        history, F.col(who).eqNullSafe(F.col("_who")) & (F.col("_us") == F.col("_at")), "left"
    ).select(*out)
    return cold.unionByName(warm)


def new_merchant(df: DataFrame, names: HistoryColumns = HistoryColumns()) -> DataFrame:
    """``is_new_merchant``: Yes where the customer never bought there earlier, else No.

    The first instant of a pair is an aggregate that merges before the shuffle; the join back lets
    adaptive execution split a pair that holds many rows.
    """
    keys = [names.customer, names.merchant]
    first = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(names.ts).alias("_first"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    is_first = F.col(names.ts) == F.col("_first")
    return (
        df.join(first, same)
        .withColumn("is_new_merchant", F.when(is_first, "Yes").otherwise("No"))
        .select(*[c for c in df.columns if c != "is_new_merchant"], "is_new_merchant")
    )


def international(
    df: DataFrame, places: DataFrame, home: str, away: str, place: str = "place", country: str = "country"
) -> DataFrame:
    """``is_international_transaction``: Yes where the two places lie in different countries.

    ``places`` holds one row per place and is broadcast where it is small; an unknown place gives NULL.
    """
    rows = collect_small(places.select(F.col(place).alias("place"), F.col(country).alias("country")))
    if rows is not None:
        places = df.sparkSession.createDataFrame(rows, places.select(place, country).schema)
    joined = df
    for column, name in ((home, "_home"), (away, "_away")):
        side = places.select(F.col(place).alias(f"{name}_place"), F.col(country).alias(name))
        if rows is not None:
            side = F.broadcast(side)
        joined = joined.join(side, F.col(column) == F.col(f"{name}_place"), "left")
    abroad = F.when(F.col("_home") != F.col("_away"), "Yes").when(F.col("_home") == F.col("_away"), "No")
    return joined.select(*df.columns, abroad.alias("is_international_transaction"))


def unusual_time(df: DataFrame, time: str = "transaction_time") -> DataFrame:
    """``unusual_time_transaction``: Yes at night (22 to 6), No by day, and No for an unreadable time."""
    return df.withColumn(
        "unusual_time_transaction",
        F.when(is_night(hour_of(F.col(time))) == 1, "Yes").otherwise("No"),
    )
