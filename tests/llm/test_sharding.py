import zlib

import numpy as np
import pytest

from llm_rows import ROWS
from tallyguard.llm.queries import QUERIES
from tallyguard.llm.sharding import half_bits, permute, shard_rows


@pytest.mark.parametrize("count", [1, 2, 3, 5, 16, 17, 255, 1000, 4097, 65537])
def test_the_permutation_is_one(count):
    out = permute(np.arange(count), count)
    assert sorted(out.tolist()) == list(range(count))
    assert 2 ** (2 * half_bits(count)) >= count


def test_seeds_differ_and_repeat():
    a, b = permute(np.arange(5000), 5000, 1), permute(np.arange(5000), 5000, 2)
    assert (a != b).mean() > 0.99 and (a == permute(np.arange(5000), 5000, 1)).all()


def test_neighbours_are_spread():
    out = permute(np.arange(40_000), 40_000)
    shards = out % 40
    assert abs(np.corrcoef(shards[:-1], shards[1:])[0, 1]) < 0.02
    assert abs(np.corrcoef(np.arange(40_000), out)[0, 1]) < 0.02


def test_rows_of_shards(odd):
    rows = shard_rows(odd, shards=4).collect()
    assert len(rows) == len(ROWS)
    counts = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(4)]
    assert all(c == list(range(len(c))) for c in counts)
    assert max(map(len, counts)) - min(map(len, counts)) <= 1
    data = {(i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t, _ in ROWS}
    assert {(r["doc_id"], r["text_crc32"], r["size"]) for r in rows} == data


def test_the_same_rows_in_other_partitions_take_the_same_places(odd):
    def places(df):
        return sorted(map(str, shard_rows(df, shards=4).collect()))

    assert places(odd) == places(odd.repartition(5))


def test_more_shards_than_rows_and_no_rows(odd, none):
    rows = shard_rows(odd.limit(2), shards=40).collect()
    assert len({r["shard"] for r in rows}) == 2 and {r["slot"] for r in rows} == {0}
    assert shard_rows(none).count() == 0


def plain_places(rows, shards, seed):
    """Shard and slot of each (id, text), one number at a time with plain integers."""
    prime = 2**31 - 1
    state, keys = seed, []
    for _ in range(6 * 4):
        state = (state * 48271 + 11) % prime
        keys.append(state % (prime - 1) + 1)
    bits = 1
    while 4**bits < len(rows):
        bits += 1

    def step(x):
        left, right = divmod(x, 2**bits)
        for k in range(0, len(keys), 4):
            mixed = (right * keys[k] + keys[k + 1]) % prime
            mixed = ((mixed ^ (mixed >> 13)) * keys[k + 2] + keys[k + 3]) % prime
            left, right = right, left ^ (mixed % 2**bits)
        return left * 2**bits + right

    data = [(id_, (text or "").encode()) for id_, text in rows]
    ordered = sorted((id_ is not None, id_ or 0, zlib.crc32(raw), len(raw) + 16) for id_, raw in data)
    out = []
    for number, (known, id_, crc, size) in enumerate(ordered):
        place = step(number)
        while place >= len(rows):
            place = step(place)
        out.append((id_ if known else None, size, crc, place % shards, place // shards))
    return out


def test_every_row_has_the_place_of_a_plain_version(odd, spark):
    def found(df):
        return sorted(map(str, ((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect())))

    for shards, seed in ((1, 20), (4, 7), (40, 20)):
        wanted = plain_places([r[:2] for r in ROWS], shards, seed)
        assert found(shard_rows(odd, shards, seed)) == sorted(map(str, wanted))
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op7_sharding"](spark, folder)) == sorted(map(str, plain_places(rows, 40, 20)))
