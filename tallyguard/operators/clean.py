"""Imputation and the whole cleaning sequence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.functions.numeric import numeric_columns, text_columns
from tallyguard.operators.parse import binarize_label, drop_duplicates, trim_strings
from tallyguard.operators.quantiles import ACCURACY, approximate_quantiles, column_quantiles
from tallyguard.session import stage
from tallyguard.sources.schemas import LABEL

# Fixed value: the text that fills a text column without any value.
UNKNOWN = "Inconnu"


def columns_with_gaps(df: DataFrame, columns: Sequence[str]) -> list[str]:
    if not columns:
        return []
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()) for c in columns]).first()
    return [c for c, n in zip(columns, row) if n > 0]


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The most frequent text of each column, the smallest on a tie; none for an empty column.

    Counts merge before the shuffle and the winner is picked by an aggregate, so no task holds all
    values of a column.
    """
    if not columns:
        return {}
    pairs = F.array(
        *[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(columns)]
    )
    best = (
        df.select(F.inline(pairs))
        .where("value IS NOT NULL")
        .groupBy("i", "value")
        .agg(F.count("*").alias("n"))
        .groupBy("i")
        .agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("mode"))
    )
    return {columns[r["i"]]: r["mode"] for r in best.collect()}


def fit_medians(
    df: DataFrame,
    exclude: Sequence[str] = (),
    approx: bool = False,
    accuracy: int = ACCURACY,
    gaps: Sequence[str] | None = None,
) -> dict[str, float]:
    """Median of every numeric column that has a gap and a value; ``gaps`` if they are known already."""
    columns = [c for c in numeric_columns(df) if c not in exclude]
    gaps = columns_with_gaps(df, columns) if gaps is None else [c for c in columns if c in gaps]
    solve = approximate_quantiles if approx else column_quantiles
    return {c: q[0] for c, q in solve(df, gaps, [0.5], accuracy).items()}


def impute_median(df: DataFrame, medians: dict[str, float] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Fill the gaps of numeric columns; a filled column becomes DOUBLE, as a median may be x.5."""
    fill = fit_medians(df, exclude) if medians is None else medians
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(m)) for c, m in fill.items()})


def fit_modes(
    df: DataFrame, exclude: Sequence[str] = (), gaps: Sequence[str] | None = None
) -> dict[str, str]:
    """Fill text of every text column with a gap; ``gaps`` if they are known already."""
    columns = [c for c in text_columns(df) if c not in exclude]
    gaps = columns_with_gaps(df, columns) if gaps is None else [c for c in columns if c in gaps]
    return {**dict.fromkeys(gaps, UNKNOWN), **column_modes(df, gaps)}


def impute_mode(df: DataFrame, modes: dict[str, str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Fill the gaps of text columns with their mode, and what is left with the unknown mark."""
    fill = fit_modes(df, exclude) if modes is None else modes
    return df.withColumns(
        {
            c: F.coalesce(F.col(f"`{c}`"), F.lit(fill.get(c, UNKNOWN)))
            for c in text_columns(df)
            if c not in exclude
        }
    )


def labelled_rows(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Trimmed rows with a valid label as 1 or 0, without copies."""
    return drop_duplicates(binarize_label(trim_strings(df), label))


def clean_table(df: DataFrame, label: str = LABEL, exclude: Sequence[str] = ()) -> DataFrame:
    """Trim, keep valid labels, make them 1 and 0, drop copies, fill numbers, fill texts.

    The rows without copies are written once, since counting gaps, medians, modes and the result each
    read them.
    """
    rows = stage(labelled_rows(df, label), "labelled_rows")
    gaps = columns_with_gaps(rows, [*numeric_columns(rows), *text_columns(rows)])
    medians = fit_medians(rows, exclude, gaps=gaps)
    modes = fit_modes(rows, exclude, gaps=gaps)
    return impute_mode(impute_median(rows, medians), modes, exclude)
