"""Small tables: collected or broadcast only after a check of their size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

MAX_ROWS = 32_768
MAX_ROW_BYTES = 1_024


def collect_small(df: DataFrame, max_rows: int = MAX_ROWS, max_row_bytes: int = MAX_ROW_BYTES) -> list[Row] | None:
    """All rows, or None where there are more than ``max_rows`` or one is longer than ``max_row_bytes``
    as JSON. At most 32 MiB of JSON reach the driver, in one job."""
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    fits = F.octet_length(F.to_json(whole)) <= max_row_bytes
    taken = df.select(F.when(fits, whole).alias("row")).limit(max_rows + 1).collect()
    if len(taken) > max_rows or any(t["row"] is None for t in taken):
        return None
    return [t["row"] for t in taken]


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """The table marked for broadcast where it is small, else the table itself.

    Unmarked, the join shuffles, and adaptive execution splits the partitions of a hot key.
    """
    rows = collect_small(df, max_rows)
    if rows is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
