"""SimHash and vector near-dedup, against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_rows import ROWS, by
from tallyguard.llm import base, metric, simhash


def reach(links: np.ndarray) -> np.ndarray:
    label = np.arange(len(links))
    while True:
        lower = np.where(links, label[None, :], len(label)).min(axis=1)
        if (lower == label).all():
            return label
        label = lower


def plain_print(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(max(1, len(words) - shingle + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd):
    wanted = sorted([(i, format(plain_print(t), "016x")) for i, t, _ in ROWS], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert by(simhash.simhash_groups(odd), "doc_id", "fingerprint") == wanted


def test_hash_is_spark_s_too(spark):
    row = spark.sql("SELECT xxhash64('the cat sat') AS h").first()
    assert row["h"] % 2**64 == xxhash.xxh64_intdigest(b"the cat sat", 42)


def test_components_of_documents(odd, none):
    rows = sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0))
    prints = np.array([plain_print(t) for _, t, _ in rows], "uint64")
    label = reach(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2)
    wanted = sorted([(r[0], rows[k][0]) for r, k in zip(rows, label)], key=lambda t: tuple((x is None, str(x)) for x in t))
    assert by(simhash.simhash_groups(odd), "doc_id", "component_id") == wanted
    assert simhash.simhash_groups(none).count() == 0


@pytest.mark.parametrize("hot_key", [2, 20, 10_000])
def test_links_are_complete_whatever_is_hot(spark, hot_key):
    random.seed(4)
    prints = set()
    for _ in range(12):
        seed = random.getrandbits(64)
        prints.add(seed)
        for _ in range(40):
            near = seed
            for _ in range(random.randint(1, 4)):
                near ^= 1 << random.randrange(64)
            prints.add(near)
    prints |= {0, 1, 2**64 - 1, 2**63, 2**64 - 2}
    prints = sorted(prints)
    signed = np.array(prints, "uint64").view("int64").tolist()
    df = spark.createDataFrame([(p,) for p in signed], "print bigint")
    found = {(r["a"], r["b"]) for r in simhash.links_between(df, hot_key=hot_key).collect()}
    wanted = {
        (min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % 2**64).bit_count() <= 2
    }
    assert found == wanted and len(wanted) > 300


def test_cells_bound_the_bit_distance(spark):
    values = [0, -1, 1 << 62, -(1 << 63), 0x0123456789ABCDEF]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    for r in df.select("v", simhash.nibble_counts(F.col("v")).alias("c")).collect():
        nibbles = [(r["v"] % 2**64 >> 4 * i) & 15 for i in range(16)]
        assert [(r["c"] >> 4 * i) & 15 for i in range(16)] == [n.bit_count() for n in nibbles]


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_connected_components(spark, shape):
    random.seed(5)
    n = 300
    if shape == "path":
        order = random.sample(range(n), n)
        links = list(zip(order, order[1:]))
    elif shape == "star":
        links = [(n - 1, i) for i in range(n - 1)]
    else:
        links = [(random.randrange(n), random.randrange(n)) for _ in range(n // 2)]
    matrix = np.eye(n, dtype=bool)
    for a, b in links:
        matrix[a, b] = matrix[b, a] = True
    label = reach(matrix)
    out = {r["node"]: r["root"] for r in base.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {i: out.get(i, i) for i in nodes} == {i: label[i] for i in nodes}


def vectors(n, dim, seed):
    rng = np.random.default_rng(seed)
    base_ = rng.standard_normal((n, dim))
    near = base_[rng.integers(0, n, 2 * n)] + rng.standard_normal((2 * n, dim)) * rng.uniform(0, 0.5, (2 * n, 1))
    return np.concatenate([base_, near, near[:5], base_[:3] * 7]).astype("float32")


@pytest.mark.parametrize("cell_rows,block_rows", [(4096, 4096), (20, 4096), (20, 7)])
def test_vectors_against_all_pairs(spark, cell_rows, block_rows):
    v = vectors(60, 6, 7)
    rows = [(i, x.tolist(), i) for i, x in enumerate(v)]
    out = metric.near_vectors(
        spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n_links int"),
        cell_rows=cell_rows, block_rows=block_rows,
    )
    unit = v.astype("float64") / np.linalg.norm(v.astype("float64"), axis=1, keepdims=True)
    links = unit @ unit.T >= 0.95
    label = reach(links | np.eye(len(v), dtype=bool))
    wanted = [(i, int(links[i].sum()) - 1, int(label[i]), bool(label[i] == i)) for i in range(len(v))]
    assert sorted(by(out, "vec_id", "n_links", "component_id", "kept")) == wanted
    assert sum(w[1] for w in wanted) > 200


def test_links_of_tied_pivots_don_t_hang_on_batches(spark, monkeypatch):
    """Rescaled copies of one vector, several of them pivots: whichever of the tied cells is written is the home."""

    class Tied(metric.Pivots):
        def homes(self, unit, dim):
            cell, apart = super().homes(unit, dim)
            at, pivots, _ = self.of[dim]
            cos = unit @ pivots.T
            ties = cos >= cos.max(axis=1, keepdims=True) - 1e-9
            last = at[len(at) - 1 - ties[:, ::-1].argmax(axis=1)]
            return np.where(np.arange(len(unit)) % 2, at[ties.argmax(axis=1)], last), apart

    monkeypatch.setattr(metric, "Pivots", Tied)
    rng = np.random.default_rng(9)
    v = (rng.standard_normal(64) * rng.uniform(0.1, 9, (300, 1))).astype("float32")
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id bigint, embedding array<float>")
    out = metric.near_vectors(table, cell_rows=30)
    assert set(by(out, "n_links", "component_id")) == {(299, 0)}


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, []),
        (8, [1.0, None]), (9, [1.0]), (10, [3.0]), (None, [1.0, 0.01]), (11, [1e300, 0.0]), (12, [-1.0, 0.0]),
        (13, [1.0, 0.0]), (13, [1.0, 0.0]),
    ]
    out = metric.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    found = by(out, "vec_id", "n_links", "component_id", "kept")
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 12)]
    pair = [(9, 1, 9, True), (10, 1, 9, False)]
    six = [(1, 5, 1, True), (2, 5, 1, False), (11, 5, 1, False), (13, 5, 1, False), (13, 5, 1, False), (None, 5, 1, False)]
    assert sorted(map(str, found)) == sorted(map(str, alone + pair + six))
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert metric.near_vectors(empty).count() == 0


def test_a_cell_that_holds_most_vectors_is_spread(spark):
    rng = np.random.default_rng(8)
    centre = rng.standard_normal(8)
    v = np.concatenate([centre + 0.05 * rng.standard_normal((150, 8)), rng.standard_normal((50, 8))])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    out = metric.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), block_rows=16)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    counts = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    assert [r["n_links"] for r in sorted(out.collect(), key=lambda r: r["vec_id"])] == counts.tolist()
