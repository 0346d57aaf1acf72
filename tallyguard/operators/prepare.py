"""Split, scaling, encoding and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyguard.functions.numeric import spread
from tallyguard.operators.bounded import MAX_ROWS, broadcast_if_small, collect_small
from tallyguard.session import stage
from tallyguard.sources.schemas import LABEL

TEST_SHARE = 0.2
SEED = 42
# Digits of a row's place, those that a histogram looks at more each time, and the rows that one task ranks.
PLACE_LENGTH = 48
PREFIX_LENGTH = 4
EDGE_ROWS = 100_000
MISSING = "\u2205"


def row_hash(key: Sequence[str], seed: int = SEED) -> Column:
    """Hexadecimal digest of the seed and the key columns: a fixed shuffle of the rows."""
    parts = [F.coalesce(F.col(f"`{k}`").cast("string"), F.lit(MISSING)) for k in key]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def row_order(columns: Sequence[str], key: Sequence[str], seed: int = SEED) -> Column:
    """The key's digest, then a hash of the whole row: rows with one key differ in their place."""
    whole = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns])
    return F.concat(row_hash(key, seed), F.lpad(F.hex(whole), 16, "0"))


def split_limits(
    df: DataFrame,
    key: Sequence[str],
    label: str = LABEL,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    edge_rows: int = EDGE_ROWS,
) -> DataFrame:
    """(_label, _limit): per label the place of the last row of the test part.

    A histogram over the first digits of the place finds the digits where the test part ends. While more than
    ``edge_rows`` rows share them, a histogram over more digits of those rows narrows them down; what is left
    is ranked, at most ``edge_rows`` rows a label.
    """
    placed = df.select(F.col(label).alias("_label"), row_order(df.columns, key, seed).alias("_order"))
    length = PREFIX_LENGTH
    total = placed.groupBy("_label", F.substring("_order", 1, length).alias("_prefix")).agg(F.count("*").alias("n"))
    everything = Window.partitionBy("_label")
    ends = stage(_ends(total.withColumn("wanted", F.ceil(F.sum("n").over(everything) * F.lit(test_share)))), "ends")
    while (most := ends.agg(F.max("n")).first()[0] or 0) > edge_rows and length < PLACE_LENGTH:
        edge = _at_ends(placed, ends, length)
        length += PREFIX_LENGTH
        counts = edge.groupBy("_label", "wanted", F.substring("_order", 1, length).alias("_prefix"))
        ends = stage(_ends(counts.agg(F.count("*").alias("n"))), "ends")
    if most > edge_rows:
        return ends.select("_label", F.col("_prefix").alias("_limit"))
    place = F.row_number().over(Window.partitionBy("_label").orderBy("_order"))
    ranked = _at_ends(placed, ends, length).withColumn("place", place)
    return ranked.where("place = wanted").select("_label", F.col("_order").alias("_limit"))


def _ends(histogram: DataFrame) -> DataFrame:
    """(_label, _prefix, n, wanted): the digits among whose rows the wanted number is reached, and its rest."""
    in_order = Window.partitionBy("_label").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    found = histogram.withColumn("upto", F.sum("n").over(in_order)).where("upto >= wanted AND upto - n < wanted")
    return found.select("_label", "_prefix", "n", (F.col("wanted") - F.col("upto") + F.col("n")).alias("wanted"))


def _at_ends(placed: DataFrame, ends: DataFrame, length: int) -> DataFrame:
    side = broadcast_if_small(ends.select(F.col("_label").alias("_end"), "_prefix", "wanted"))
    same = F.col("_label").eqNullSafe(F.col("_end")) & (F.substring("_order", 1, length) == F.col("_prefix"))
    return placed.join(side, same).select("_label", "_order", "wanted")


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    label: str = LABEL,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    edge_rows: int = EDGE_ROWS,
) -> DataFrame:
    """The rows with ``split`` train or test: of every label the first ⌈share · n⌉ in digest order are test.

    The same rows always get the same split. Rows with an equal key are told apart by their other columns, so
    a key that repeats doesn't change the share; only rows equal in every column go together.
    """
    limits = broadcast_if_small(split_limits(df, key, label, test_share, seed, edge_rows))
    is_test = row_order(df.columns, key, seed) <= F.col("_limit")
    return df.join(limits, F.col(label).eqNullSafe(F.col("_label")), "left").select(
        *[F.col(f"`{c}`") for c in df.columns], F.when(is_test, "test").otherwise("train").alias("split")
    )


def fit_scale(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column, in one pass."""
    numbers = [F.col(f"`{c}`").cast("double") for c in columns]
    row = train.agg(*[F.struct(F.avg(x), spread(x)) for x in numbers]).first()
    return {c: tuple(pair) for c, pair in zip(columns, row)}


def apply_scale(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    """(x − mean) ÷ deviation; a constant column becomes 0."""
    scaled = {}
    for c, (mean, deviation) in scale.items():
        x = F.col(f"`{c}`").cast("double")
        if mean is None:
            scaled[c] = x
        elif deviation == 0:
            scaled[c] = F.when(x.isNotNull(), 0.0)
        else:
            scaled[c] = (x - F.lit(mean)) / F.lit(deviation)
    return df.withColumns(scaled)


def standard_scale(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_scale(df, fit_scale(train, columns))


def _distributed_codes(values: DataFrame) -> DataFrame:
    """(i, value, code) for a dictionary too large for one task: a global sort, then per partition the
    count of the values before it."""
    ordered = (
        values.repartitionByRange("i", "value")
        .sortWithinPartitions("i", "value")
        .withColumn("at", F.monotonically_increasing_id())
    )
    ordered = stage(ordered, "dictionary").withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("i", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("i").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    code = (F.col("at") - F.col("first") + F.col("before")).cast("int")
    return ordered.join(parts.drop("n"), ["i", "part"]).select("i", "value", code.alias("code"))


def category_codes(train: DataFrame, columns: Sequence[str], max_rows: int = MAX_ROWS) -> tuple[DataFrame, bool]:
    """(i, value, code) with the rank of each category in sorted order, and whether it is small."""
    pairs = F.array(
        *[F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(columns)]
    )
    values = train.select(F.inline(pairs)).where("value IS NOT NULL").distinct()
    rows = collect_small(values, max_rows)
    if rows is None:
        return _distributed_codes(values), False
    ranked: list[tuple[int, str, int]] = []
    for i in range(len(columns)):
        texts = sorted(r["value"] for r in rows if r["i"] == i)
        ranked += [(i, text, code) for code, text in enumerate(texts)]
    return train.sparkSession.createDataFrame(ranked, "i int, value string, code int"), True


def ordinal_encode(
    train: DataFrame, df: DataFrame, columns: Sequence[str], max_rows: int = MAX_ROWS
) -> DataFrame:
    """Text columns to the rank of their value among the sorted training values; unseen or missing −1."""
    codes, small = category_codes(train, columns, max_rows)
    encoded = df
    for i, c in enumerate(columns):
        side = codes.where(F.col("i") == i).select(
            F.col("value").alias(f"_value{i}"), F.col("code").alias(f"_code{i}")
        )
        if small:
            side = F.broadcast(side)
        encoded = encoded.join(side, F.col(f"`{c}`") == F.col(f"_value{i}"), "left")
    code_of = {c: F.coalesce(F.col(f"_code{i}"), F.lit(-1)).alias(c) for i, c in enumerate(columns)}
    return encoded.select(*[code_of.get(c, F.col(f"`{c}`")) for c in df.columns])


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, weight): weight = rows ÷ (classes · rows of the class)."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    rows = collect_small(counts)
    if rows is not None:
        total = sum(r["n"] for r in rows)
        weighted = [(r[label], r["n"], total / (len(rows) * r["n"])) for r in rows]
        schema = counts.schema.add("weight", "double")
        return df.sparkSession.createDataFrame(weighted, schema)
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("classes"))).scalar()
    return counts.withColumn("weight", totals["rows"] / (totals["classes"] * F.col("n")))


def with_class_weights(df: DataFrame, label: str = LABEL, column: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(F.col(label).alias("_class"), F.col("weight").alias(column))
    return df.join(broadcast_if_small(weights), F.col(label).eqNullSafe(F.col("_class"))).drop("_class")
