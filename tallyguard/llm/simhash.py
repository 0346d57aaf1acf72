"""SimHash near-dedup: popcount cells under Manhattan distance as a lower bound, then exact bit distance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import components, ship, stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: A meeting key with more rows than this is hot; its members meet under single-bit flips instead.
HOT_KEY = 256
#: The lowest bit of each of the 16 nibbles.
NIBBLES = 16
LOW_BITS = 0x1111111111111111


def fingerprint(text: str, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64 bits, unsigned: bit set where over half of the shingle hashes have it; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, seed)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    ends = (ends[shingle - 1 :] - 1).tolist()
    hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends)], "<u8")
    octets = hashes.view("u1").reshape(-1, 8)
    bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype("int64")
    counts = np.concatenate([np.bincount(octets[:, k], minlength=256) @ bits for k in range(8)])
    return sum(1 << k for k in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(id, print): the fingerprint of every whole text as a signed 64-bit number."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def printed(batches):
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            signed = np.array(prints, "uint64").view("int64")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["id", "print"])

    return source.mapInArrow(printed, f"id {kind}, print bigint")


def nibble_counts(bits: Column) -> Column:
    """The set bits of each of the 16 nibbles, in that nibble."""
    places = [F.shiftrightunsigned(bits, k).bitwiseAND(F.lit(LOW_BITS)) for k in range(4)]
    return places[0] + places[1] + places[2] + places[3]


def cell_keys(cell: Column) -> Column:
    """The cell itself and the cells one step away along one axis: cells at Manhattan distance 2 or less share one."""
    keys = [cell]
    for i in range(NIBBLES):
        count = F.shiftrightunsigned(cell, 4 * i).bitwiseAND(F.lit(15))
        step = F.shiftleft(F.lit(1).cast("bigint"), 4 * i)
        keys += [F.when(count < 4, cell + step), F.when(count > 0, cell - step)]
    return F.array_compact(F.array(*keys))


def flip_keys(bits: Column) -> Column:
    """The fingerprint and its 64 single-bit flips: a key is shared by 65 fingerprints at most."""
    flips = [bits.bitwiseXOR(F.shiftleft(F.lit(1).cast("bigint"), i)) for i in range(64)]
    return F.array(bits, *flips)


def close_pairs(keyed: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) for all fingerprints that share a key and differ in at most ``max_bits`` bits.

    Rows are dealt by key and sorted; neighbours 1, 2, ... places apart are compared while they share a key,
    so memory holds one batch and the group at its end.
    """

    def pairs(batches):
        keys, prints = np.zeros(0, "int64"), np.zeros(0, "int64")

        def found(keys, prints):
            a, b, apart = [], [], 1
            while apart < len(keys):
                same = np.flatnonzero(keys[apart:] == keys[:-apart])
                if not len(same):
                    break
                x, y = prints[same], prints[same + apart]
                near = (np.bitwise_count((x ^ y).view("uint64")) <= max_bits) & (x != y)
                a.append(np.minimum(x, y)[near])
                b.append(np.maximum(x, y)[near])
                apart += 1
            both = np.stack([np.concatenate(a), np.concatenate(b)], 1) if a else np.zeros((0, 2), "int64")
            both = np.unique(both, axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy()])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield found(keys[:cut], prints[:cut])
                keys, prints = keys[cut:], prints[cut:]
        yield found(keys, prints)

    return keyed.repartition("key").sortWithinPartitions("key").mapInArrow(pairs, "a bigint, b bigint").distinct()


def links_between(prints: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """All pairs of different fingerprints that differ in at most ``max_bits`` (2 or less) bits.

    A fingerprint is embedded as the counts of set bits of its 16 nibbles. One differing bit changes one count
    by one, so the Manhattan distance of the counts is at most the bit distance. Every fingerprint goes to its
    own cell and the neighbouring ones, where all pairs within the bound meet, and the bits decide. A key with
    more than ``hot_key`` members would compare too many: its members meet under single-bit flips, where a
    group has 65 members at most and two fingerprints at distance 2 or less always share one.
    """
    if max_bits > 2:
        raise ValueError("cells one step away meet at a distance of 2 or less")
    celled = prints.select("print", F.explode(cell_keys(nibble_counts(F.col("print")))).alias("key"))
    celled = celled.select("key", "print")
    hot = stage(celled.groupBy("key").count().where(F.col("count") > hot_key).select("key"), "hot_keys")
    if hot.isEmpty():
        return close_pairs(celled, max_bits)
    members = celled.join(hot, "key", "left_semi").select("print").distinct()
    flipped = members.select(F.explode(flip_keys(F.col("print"))).alias("key"), "print")
    cold = celled.join(hot, "key", "left_anti")
    return close_pairs(cold, max_bits).union(close_pairs(flipped, max_bits)).distinct()


def simhash_groups(
    docs: DataFrame,
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_key: int = HOT_KEY,
) -> DataFrame:
    """``id_col``, fingerprint (16 hex digits), component_id: the smallest id reachable over linked fingerprints.

    Equal fingerprints are one node, so a group of copies costs one row. A text of fewer words than a shingle is
    one shingle; NULL, empty and blank texts have fingerprint zero and link like any other. Repeated rows come
    out each, rows with NULL ids too (they never name a component); other columns are not read; an empty table
    gives no rows.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    prints = stage(rows.groupBy("print").agg(F.min("id").alias("first")), "distinct_prints")
    roots = components(links_between(prints, max_bits, hot_key))
    tied = prints.join(roots, prints["print"] == roots["node"], "left")
    tied = stage(tied.select("print", "first", F.coalesce("root", "print").alias("root")), "roots")
    least = stage(tied.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = stage(tied.join(least, "root").select("print", "component_id"), "components")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return rows.join(named, "print").select(F.col("id").alias(id_col), hexed, "component_id")
