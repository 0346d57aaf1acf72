"""Numbers: ratios, logarithm, safe correlation, NaN handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPSILON = 1e-6
NUMERIC_TYPES = (T.NumericType,)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every FLOAT and DOUBLE column."""
    fields = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in fields})


def log1p_amount(amount: Column) -> Column:
    """ln(1 + amount), a negative amount taken as 0, a missing one kept missing."""
    return F.log1p(F.when(amount < 0, 0.0).otherwise(amount))


def guarded_ratio(amount: Column, base: Column) -> Column:
    """amount / (|base| + 1e-6), so that a zero base is no error."""
    return amount / (F.abs(base) + EPSILON)


def spread(x: Column) -> Column:
    """Population standard deviation, exactly 0 for a constant column.

    Merging partial results may leave a trace of rounding, so a constant is told by its extremes.
    """
    return F.when(F.min(x) == F.max(x), 0.0).otherwise(F.stddev_pop(x))
