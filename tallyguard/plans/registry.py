"""The catalogue: each query next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.plans.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can state it."""

    def register(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = make
        if sql is not None:
            ORACLE[name] = sql
        return make

    return register


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    make = QUERIES[name]
    return lambda spark, folder: make(Tables(spark, folder))


def r6(column: str | Column) -> Column:
    """Rounded to six decimals, exact ties always up, without a negative zero."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c + F.lit(1e-9), 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def stamp(column: str) -> Column:
    """Timestamp as text with microseconds."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
