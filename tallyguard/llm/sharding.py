"""Reproducible shuffle into shards by a Feistel permutation of global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import numbered, ship, text_bytes

SHARDS = 40
SEED = 20
ROUNDS = 6
PRIME = (1 << 31) - 1
OVERHEAD = 16


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int, int]]:
    """Four multipliers and addends a round, drawn from a linear generator that starts at the seed."""
    state, out = seed % PRIME, []
    for _ in range(rounds):
        keys = []
        for _ in range(4):
            state = (state * 48_271 + 11) % PRIME
            keys.append(state % (PRIME - 1) + 1)
        out.append(tuple(keys))
    return out


def half_bits(count: int) -> int:
    """Bits of one half, so that two halves number at least ``count`` rows."""
    return max(1, (max(count - 1, 1).bit_length() + 1) // 2)


def feistel(x: np.ndarray, bits: int, keys) -> np.ndarray:
    """A permutation of the numbers below 2 ** (2 * bits)."""
    mask = np.int64((1 << bits) - 1)
    left, right = x >> bits, x & mask
    for a, b, c, d in keys:
        mixed = (right * a + b) % PRIME
        mixed = ((mixed ^ (mixed >> 13)) * c + d) % PRIME
        left, right = right, left ^ (mixed & mask)
    return (left << bits) | right


def permute(numbers: np.ndarray, count: int, seed: int = SEED) -> np.ndarray:
    """A permutation of the numbers below ``count``: numbers that fall outside walk on until they are inside."""
    bits, keys = half_bits(count), round_keys(seed)
    out = feistel(numbers.astype(np.int64), bits, keys)
    while (outside := out >= count).any():
        out[outside] = feistel(out[outside], bits, keys)
    return out


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row with its place in a reproducible shuffle: ``id_col``, size, text_crc32, shuffled, shard, slot.

    Rows are numbered in the order of id, checksum and size (NULL ids first), the number is permuted, and the
    permuted number modulo ``shards`` is the shard, its quotient the slot: counts of shards differ by one at
    most, slots have no gap, and both can be computed from a row number alone. Only ids, sizes and checksums
    are sorted, never texts. NULL text has no bytes. Repeated rows take neighbouring numbers, and which of
    them takes which makes no difference. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    data = text_bytes(text_col)
    light = docs.select(
        F.col(id_col),
        (F.octet_length(data) + OVERHEAD).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    rows = numbered(light, [id_col, "text_crc32", "size"])
    count = rows.count()

    @F.pandas_udf("bigint")
    def shuffled(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), count, seed))

    placed = rows.withColumn("shuffled", shuffled("row_no"))
    return placed.select(
        id_col,
        "size",
        "text_crc32",
        "shuffled",
        (F.col("shuffled") % shards).cast("int").alias("shard"),
        F.expr(f"shuffled div {shards}").alias("slot"),
    )
