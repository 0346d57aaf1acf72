"""Exact quantiles without gathering a column in one task.

The built-in ``percentile`` merges every distinct value of a group in one task. Here a sketch first
brackets each wanted rank between two values that are close together. A second pass counts what lies
below a bracket and keeps single values only within it, so that the sorted part is a small, known
share of the group (about six in ``accuracy``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.operators.bounded import broadcast_if_small
from tallyguard.session import stage

ACCURACY = 10_000
# Rank error allowed around a bracket end, in units of 1 / accuracy; the sketch promises one.
SLACK = 3
# Below this many rows per unit of accuracy a group is sorted as a whole.
SMALL_GROUP = 20
# Values of a bracket that one task ranks.
EDGE_ROWS = 200_000


def unpivot_numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by…, column, value DOUBLE), one row for each value present."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in columns
        ]
    )
    return df.select(*by, F.inline(pairs)).where("value IS NOT NULL")


def _same_group(left: str, right: str, by: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in by:
        condition = condition & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return condition


def running_counts(counted: DataFrame, group: Sequence[str], spread_out: bool) -> DataFrame:
    """``upto``: the rows of a group up to each value x, the values below its bracket (x NULL) first.

    Spread out, the values are sorted by range; sums by partition give what lies before each, and a running
    sum goes over the values of a group within a partition only.
    """
    running = Window.orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    if not spread_out:
        return counted.withColumn("upto", F.sum("c").over(running.partitionBy(*group)))
    order = [*group, F.col("x").asc_nulls_first()]
    sorted_ = counted.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = stage(sorted_.withColumn("part", F.spark_partition_id()), "ranks")
    parts = sorted_.groupBy(*group, "part").agg(F.sum("c").alias("size"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*group, "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = sorted_.withColumn("inside", F.sum("c").over(running.partitionBy(*group, "part")))
    both = inside.alias("r").join(parts.alias("b"), _same_group("r", "b", [*group, "part"]))
    return both.select("r.*", (F.col("b.before") + F.col("r.inside")).alias("upto")).drop("part", "inside")


def grouped_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    accuracy: int = ACCURACY,
    edge_rows: int = EDGE_ROWS,
) -> DataFrame:
    """(by…, n, q0, q1, …): exact quantiles per group, linear between neighbours, NULLs skipped.

    Where a bracket may hold more than ``edge_rows`` values, they are ranked across the cluster.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("v")).where("v IS NOT NULL")

    margin = SLACK / accuracy
    ends = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = F.percentile_approx("v", [float(e) for e in ends], accuracy)
    brackets = rows.groupBy(*by).agg(F.count("*").alias("n"), sketch.alias("ends"))
    whole = F.col("n") <= SMALL_GROUP * accuracy
    brackets = brackets.withColumn("ends", F.when(~whole, F.col("ends")))
    brackets = broadcast_if_small(stage(brackets, "brackets"))
    largest = brackets.agg(F.max("n")).first()[0] or 0

    joined = (
        rows.alias("r")
        .join(brackets.alias("b"), _same_group("r", "b", by))
        .select(*[F.col(f"r.{c}").alias(c) for c in by], "n", "v", "ends")
    )
    marks = []
    for i in range(len(probs)):
        low, high = F.col("ends")[2 * i], F.col("ends")[2 * i + 1]
        below = F.coalesce(F.col("v") < low, F.lit(False))
        above = F.coalesce(F.col("v") > high, F.lit(False))
        mark = F.struct(F.lit(i).alias("i"), F.when(~below, F.col("v")).alias("x"))
        marks.append(F.when(~above, mark))
    counted = (
        joined.select(*by, "n", F.explode(F.array(*marks)).alias("m"))
        .where("m IS NOT NULL")
        .groupBy(*by, "n", F.col("m.i").alias("i"), F.col("m.x").alias("x"))
        .agg(F.count("*").alias("c"))
    )

    counted = running_counts(counted, [*by, "i"], largest * 2 * SLACK / accuracy > edge_rows)
    wanted = F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1) * (F.col("n") - 1)
    ranked = counted.select("*", wanted.alias("rank"))

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("upto") - F.col("c")) & (rank < F.col("upto")), F.col("x")))

    missed = F.raise_error(F.lit("a quantile lies outside its bracket; raise the accuracy"))
    picked = ranked.groupBy(*by, "n", "i", "rank").agg(
        at(F.floor("rank")).alias("a"), at(F.ceil("rank")).alias("b")
    )
    between = F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))
    solved = picked.withColumn("q", F.coalesce(between, missed))
    return solved.groupBy(*by, "n").agg(
        *[F.max(F.when(F.col("i") == i, F.col("q"))).alias(f"q{i}") for i in range(len(probs))]
    )


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY
) -> dict[str, tuple[float, ...]]:
    """Exact quantiles of whole columns as plain numbers; a column without values is left out."""
    if not columns:
        return {}
    table = grouped_quantiles(unpivot_numbers(df, columns), ["column"], "value", probs, accuracy)
    return {r["column"]: tuple(r[f"q{i}"] for i in range(len(probs))) for r in table.collect()}


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY
) -> dict[str, tuple[float, ...]]:
    """One pass, rank error up to 1 / accuracy."""
    if not columns:
        return {}
    wanted = [float(p) for p in probs]
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), wanted, accuracy) for c in columns]).first()
    return {c: tuple(q) for c, q in zip(columns, row) if q is not None}
