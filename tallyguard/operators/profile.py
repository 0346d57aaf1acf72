"""Profiling: shape, gaps, distributions, correlations, outliers, rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.dates import month_bucket, parse_date
from tallyguard.functions.labels import fraud_flag
from tallyguard.functions.numeric import numeric_columns
from tallyguard.functions.text import strip
from tallyguard.operators.bounded import broadcast_if_small, collect_small
from tallyguard.operators.moments import pearson
from tallyguard.operators.quantiles import (
    ACCURACY,
    approximate_quantiles,
    column_quantiles,
    grouped_quantiles,
)
from tallyguard.session import stage
from tallyguard.sources.schemas import LABEL

IQR_REACH = 1.5


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def _long_from_one_row(one_row: DataFrame, fields: dict[str, list[str]]) -> DataFrame:
    """A single aggregate row to one row per column: ``fields`` maps a column to its aggregates."""
    structs = [
        F.struct(F.lit(c).alias("column"), *[_quoted(f"{name}:{c}").alias(name) for name in names])
        for c, names in fields.items()
    ]
    return one_row.select(F.inline(F.array(*structs)))


def gold_summary(
    df: DataFrame,
    label: str = LABEL,
    amount: str = "transaction_amount_million",
    mode: str = "exact",
    present: str | None = None,
) -> DataFrame:
    """One row: transactions, frauds, mean amount. No input gives (0, NULL, NULL).

    With ``present`` only rows where that column has a value count. A condition inside the aggregates,
    unlike a filter, does not make Spark evaluate a parsed column twice.
    """
    counted = F.col(present).isNotNull() if present else F.lit(True)
    return df.agg(
        F.count_if(counted).alias("transaction_count"),
        F.sum(F.when(counted, fraud_flag(F.col(label), mode))).alias("fraud_count"),
        F.avg(F.when(counted, F.col(amount))).alias("avg_amount_million"),
    )


def profile_shape(df: DataFrame) -> DataFrame:
    """(column, dtype, non_null, n_rows, n_columns), one row per column."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count(_quoted(c)).alias(f"non_null:{c}") for c in df.columns]
    )
    structs = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("dtype"),
            _quoted(f"non_null:{c}").alias("non_null"),
            F.col("rows").alias("n_rows"),
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        )
        for c in df.columns
    ]
    return counts.select(F.inline(F.array(*structs)))


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, n_missing) for the columns with gaps, most first. One pass for all columns."""
    counts = df.agg(*[F.count_if(_quoted(c).isNull()).alias(f"n_missing:{c}") for c in df.columns])
    long = _long_from_one_row(counts, {c: ["n_missing"] for c in df.columns})
    return long.where("n_missing > 0").orderBy(F.desc("n_missing"), "column")


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max) per numeric column; std of the sample."""
    columns = list(columns or numeric_columns(df))
    probs = [0.25, 0.5, 0.75]
    solve = approximate_quantiles if approx else column_quantiles
    quantiles = solve(df, columns, probs, accuracy)
    basics = df.agg(
        *[
            agg(_quoted(c).cast("double")).alias(f"{name}:{c}")
            for c in columns
            for name, agg in (
                ("count", F.count),
                ("mean", F.avg),
                ("std", F.stddev_samp),
                ("min", F.min),
                ("max", F.max),
            )
        ]
    )
    structs = []
    for c in columns:
        q = quantiles.get(c, (None,) * 3)
        structs.append(
            F.struct(
                F.lit(c).alias("column"),
                _quoted(f"count:{c}").alias("count"),
                _quoted(f"mean:{c}").alias("mean"),
                _quoted(f"std:{c}").alias("std"),
                _quoted(f"min:{c}").alias("min"),
                *[F.lit(v).cast("double").alias(n) for n, v in zip(("q25", "q50", "q75"), q)],
                _quoted(f"max:{c}").alias("max"),
            )
        )
    return basics.select(F.inline(F.array(*structs)))


def label_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, pct) per stripped label present, most first."""
    labels = df.where(F.col(label).isNotNull()).select(strip(F.col(label).cast("string")).alias("label"))
    counts = labels.groupBy("label").agg(F.count("*").alias("n"))
    few = collect_small(counts)
    if few is None:
        counts = stage(counts, "label_counts")
        total = counts.agg(F.sum("n")).scalar()
    else:
        counts = df.sparkSession.createDataFrame(few, counts.schema)
        total = F.lit(sum(r["n"] for r in few))
    return counts.withColumn("pct", F.round(F.col("n") * 100 / total, 2)).orderBy(F.desc("n"), "label")


def imbalance_ratio(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: number of classes, and smallest ÷ largest class (NULL with fewer than two)."""
    counts = (
        df.where(F.col(label).isNotNull())
        .groupBy(strip(F.col(label).cast("string")).alias("label"))
        .agg(F.count("*").alias("n"))
    )
    return counts.agg(
        F.count("*").alias("n_classes"),
        F.when(F.count("*") >= 2, F.min("n") / F.max("n")).alias("ratio"),
    )


def value_text(df: DataFrame, name: str) -> Column:
    """A value as text, the two zeros of a floating-point column alike."""
    fraction = df.schema[name].dataType.typeName() in ("float", "double")
    return (_quoted(name) + F.lit(0.0) if fraction else _quoted(name)).cast("string")


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """(column, n_unique), a missing value counted as one value and −0.0 as 0.0, most first.

    Exact: one pass makes (column, value) pairs, merges them before the shuffle, and counts. With
    ``approx`` a sketch per column does without the shuffle.
    """
    columns = list(columns or df.columns)
    if approx:
        sketches = df.agg(
            *[
                (
                    F.approx_count_distinct(_quoted(c))
                    + F.coalesce(F.max(_quoted(c).isNull().cast("bigint")), F.lit(0))
                ).alias(f"n_unique:{c}")
                for c in columns
            ]
        )
        long = _long_from_one_row(sketches, {c: ["n_unique"] for c in columns})
    else:
        pairs = F.array(
            *[
                F.struct(F.lit(i).alias("i"), value_text(df, c).alias("value"))
                for i, c in enumerate(columns)
            ]
        )
        names = F.array(*[F.lit(c) for c in columns])
        long = (
            df.select(F.inline(pairs))
            .distinct()
            .groupBy("i")
            .agg(F.count("*").alias("n_unique"))
            .select(F.element_at(names, F.col("i") + 1).alias("column"), "n_unique")
        )
    return long.orderBy(F.desc("n_unique"), "column")


def topk_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """(value, n): the k most frequent values, missing ones left out, ties in value order."""
    return (
        df.where(_quoted(column).isNotNull())
        .groupBy(_quoted(column).alias("value"))
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(k)
    )


def histogram_by(df: DataFrame, value: str, by: str, bins: int = 40) -> DataFrame:
    """(by, bin, low, high, n): equal bins over the range of the whole column, counts per group.

    Bins run from 1; the maximum falls in the last one. A missing group value is a group. Empty bins
    have no row.
    """
    v = _quoted(value).cast("double")
    low, high = df.agg(F.min(v), F.max(v)).first()
    rows = df.where(v.isNotNull()).select(_quoted(by).alias(by), v.alias("v"))
    if low is None:
        low = high = 0.0
    width = (high - low) / bins
    if width > 0:
        bin_no = F.least(F.width_bucket("v", F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins)).cast("int")
    else:
        bin_no = F.lit(1)
    return (
        rows.groupBy(by, bin_no.alias("bin"))
        .agg(F.count("*").alias("n"))
        .select(
            by,
            "bin",
            (F.lit(low) + (F.col("bin") - 1) * width).alias("low"),
            (F.lit(low) + F.col("bin") * width).alias("high"),
            "n",
        )
    )


def box_stats_by(df: DataFrame, value: str, by: str) -> DataFrame:
    """(scope, by, n, q25, q50, q75, whisker_low, whisker_high, n_outliers), per group and overall.

    Whiskers end at the furthest value within 1.5 IQR of the box.
    """
    group, every = F.struct(F.lit("group").alias("scope"), _quoted(by).alias(by)), F.struct(
        F.lit("overall").alias("scope"), F.lit(None).cast(df.schema[by].dataType).alias(by)
    )
    rows = df.where(_quoted(value).isNotNull()).select(
        _quoted(value).cast("double").alias("v"), F.inline(F.array(group, every))
    )
    boxes = grouped_quantiles(rows, ["scope", by], "v", [0.25, 0.5, 0.75])
    reach = (F.col("q2") - F.col("q0")) * IQR_REACH
    boxes = boxes.select("*", (F.col("q0") - reach).alias("lower"), (F.col("q2") + reach).alias("upper"))
    boxes = broadcast_if_small(boxes)
    inside = F.col("v").between(F.col("lower"), F.col("upper"))
    return (
        rows.alias("r")
        .join(
            boxes.alias("b"),
            (F.col("r.scope") == F.col("b.scope")) & F.col(f"r.{by}").eqNullSafe(F.col(f"b.{by}")),
        )
        .groupBy(F.col("r.scope").alias("scope"), F.col(f"r.{by}").alias(by), "n", "q0", "q1", "q2")
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
        )
        .withColumnsRenamed({"q0": "q25", "q1": "q50", "q2": "q75"})
    )


def _named_pairs(found: DataFrame, left: Sequence[str], right: Sequence[str], *out: str) -> DataFrame:
    """The names of each pair next to its correlation, also for a pair without rows."""
    pairs = [(i, j, a, b) for i, a in enumerate(left) for j, b in enumerate(right)]
    listed = found.sparkSession.createDataFrame(pairs, ["i", "j", *out])
    return F.broadcast(listed).join(found, ["i", "j"], "left").drop("i", "j")


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r): Pearson for every ordered pair, NULL for a constant column, on the diagonal too."""
    return _named_pairs(pearson(df, columns, columns), columns, columns, "x", "y")


def fraud_rate_by(df: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """(column, value, rate, n, rate_pct) per category, highest rate first within a column.

    Rows without the category or the label are left out. One pass for all columns.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), _quoted(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.where(F.col(label).isNotNull())
        .select(fraud_flag(F.col(label), "strip").alias("flag"), F.inline(pairs))
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.avg("flag").alias("rate"), F.count("*").alias("n"))
        .withColumn("rate_pct", F.round(F.col("rate") * 100, 2))
        .orderBy("column", F.desc("rate"), "value")
    )


def iqr_bounds(df: DataFrame, value: str) -> tuple[float | None, float | None]:
    """q1 − 1.5 IQR and q3 + 1.5 IQR of a column; None without values."""
    found = column_quantiles(df, [value], [0.25, 0.75])
    if value not in found:
        return None, None
    q1, q3 = found[value]
    reach = (q3 - q1) * IQR_REACH
    return q1 - reach, q3 + reach


def _outside(v: Column, low: float | None, high: float | None) -> Column:
    return (v < F.lit(low).cast("double")) | (v > F.lit(high).cast("double"))


def iqr_outliers(df: DataFrame, value: str) -> DataFrame:
    """One row: the bounds, the values strictly outside them, and their percentage."""
    low, high = iqr_bounds(df, value)
    v = _quoted(value)
    outside = F.count_if(_outside(v, low, high))
    return df.agg(
        F.lit(low).cast("double").alias("low"),
        F.lit(high).cast("double").alias("high"),
        F.count(v).alias("n"),
        outside.alias("n_outliers"),
        F.try_divide(outside * 100, F.count(v)).alias("pct_outliers"),
    )


def flag_outliers(df: DataFrame, value: str) -> DataFrame:
    """The rows with ``is_outlier`` 0 or 1; a missing value is no outlier."""
    low, high = iqr_bounds(df, value)
    v = _quoted(value)
    return df.withColumn("is_outlier", F.when(_outside(v, low, high), 1).otherwise(0))


def monthly_trend(
    df: DataFrame, date: str, label: str = LABEL, fmt: str = "yyyy-MM-dd", missing_label: str = "normal"
) -> DataFrame:
    """(month, n, rate_pct) per calendar month; unreadable dates are left out.

    A missing label counts as not fraud; with ``missing_label="drop"`` its row is left out.
    """
    rows = df if missing_label == "normal" else df.where(F.col(label).isNotNull())
    return (
        rows.select(
            month_bucket(parse_date(_quoted(date), fmt)).alias("month"),
            fraud_flag(F.col(label), "strip").alias("flag"),
        )
        .where("month IS NOT NULL")
        .groupBy("month")
        .agg(F.count("*").alias("n"), (F.avg("flag") * 100).alias("rate_pct"))
        .orderBy("month")
    )


def _labelled(df: DataFrame, value: str, label: str) -> DataFrame:
    return df.where(_quoted(value).isNotNull() & F.col(label).isNotNull()).select(
        _quoted(value).alias("value"), fraud_flag(F.col(label), "strip").alias("flag")
    )


def crosstab_pct(df: DataFrame, value: str, label: str = LABEL) -> DataFrame:
    """(value, pct_normal, pct_fraud): shares of a row; both columns always exist."""
    share = F.avg("flag") * 100
    return (
        _labelled(df, value, label)
        .groupBy("value")
        .agg(F.round(100 - share, 2).alias("pct_normal"), F.round(share, 2).alias("pct_fraud"))
        .orderBy("value")
    )


def rate_by_value(df: DataFrame, value: str, label: str = LABEL) -> DataFrame:
    """(value, rate_pct)."""
    return (
        _labelled(df, value, label)
        .groupBy("value")
        .agg((F.avg("flag") * 100).alias("rate_pct"))
        .orderBy("value")
    )


def feature_target_corr(df: DataFrame, features: Sequence[str], target: str = LABEL) -> DataFrame:
    """(feature, r): Pearson with the target, strongest first, constant features last."""
    table = _named_pairs(pearson(df, features, [target]), features, [target], "feature", "target").drop("target")
    return table.orderBy(F.abs("r").desc_nulls_last(), "feature")


def split_summary(df: DataFrame, label: str = LABEL, split: str = "split") -> DataFrame:
    """(split, n, rate_pct) with a label of 0 and 1."""
    return df.groupBy(split).agg(F.count("*").alias("n"), (F.avg(label) * 100).alias("rate_pct")).orderBy(split)


