import hashlib
import random
import zlib

import numpy as np
import pytest

from llm_rows import ROWS
from tallyguard.llm import runs
from tallyguard.llm.queries import op13_periodic_runs, with_repeats
from tallyguard.llm.runs import find_runs, kept_words, periodic_runs


def plain_runs(words):
    """Every stretch whose words q apart are identical, kept if long enough and no smaller period fits."""
    words = np.unique(words, return_inverse=True)[1] if len(words) else np.zeros(0, int)
    n, out = len(words), set()
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[False], words[:-q] == words[q:], [False]]).astype(int)
        for start, end in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            run = words[start : end + q]
            if len(run) >= max(6, 4 * q) and not any((run[d:] == run[:-d]).all() for d in range(1, q)):
                out.add((start, len(run), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(text, id_=None, plant=False):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str("" if id_ is None else id_).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    collapsed = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    exponent = 1000 * best[1] // best[2] if found else None
    digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()
    return (id_, len(found), *best, exponent, *digests)


COLUMNS = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()


def random_words(rnd):
    n, k = rnd.randint(0, 90), rnd.choice([1, 2, 2, 3, 5, 20])
    words = [rnd.randrange(k) for _ in range(n)]
    for _ in range(rnd.randint(0, 3)):
        if n > 3:
            a, p, reach = rnd.randrange(n), rnd.randint(1, 9), rnd.randint(0, n)
            for i in range(a + p, min(n, a + reach)):
                words[i] = words[i - p]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_are_those_of_brute_force(seed):
    rnd, count = random.Random(seed), 0
    for _ in range(700):
        words = random_words(rnd)
        found = find_runs(np.array(words, "int32"))
        assert found == plain_runs(words), words
        count += len(found)
    assert count > 200


def test_regions_lose_no_run_and_the_automaton_needs_none(monkeypatch):
    rnd = random.Random(9)
    texts = [random_words(rnd) for _ in range(400)]
    with_regions = [find_runs(np.array(w, "int32")) for w in texts]
    monkeypatch.setattr(runs, "regions", lambda w: [(0, len(w))] if len(w) else [])
    assert [find_runs(np.array(w, "int32")) for w in texts] == with_regions


def test_distances_are_those_to_the_last_occurrences_of_long_strings():
    """A square of smallest period q ends at a word exactly if the distance q is returned there, for q seen last."""
    rnd = random.Random(3)
    for _ in range(200):
        words = random_words(rnd)[:50]
        automaton = runs.Automaton(len(words))
        for at, word in enumerate(words):
            for d in automaton.append(word, at):
                assert words[at - d + 1 : at + 1] == words[at - 2 * d + 1 : at - d + 1]


def test_fibonacci_words_nested_runs_and_one_word():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    words = [ord(c) for c in b]
    assert find_runs(np.array(words, "int32")) == plain_runs(words)
    nested = ([1] * 6 + [2]) * 5 + [3]
    assert find_runs(np.array(nested, "int32")) == plain_runs(nested)
    assert find_runs(np.array([7] * 5, "int32")) == [] and find_runs(np.array([7] * 6, "int32")) == [(0, 6, 1)]
    assert find_runs(np.array([], "int32")) == []


def test_kept_words():
    assert kept_words(8, [(1, 6, 2)]).tolist() == [True, True, True, False, False, False, False, True]


def test_long_texts_use_arrays(monkeypatch):
    words = list(range(50)) + list(range(100, 160)) * 5
    expected = find_runs(np.array(words, "int32"))
    monkeypatch.setattr(runs, "MANY", 10)
    assert find_runs(np.array(words, "int32")) == expected == [(50, 300, 60)]
    many = np.tile(np.arange(20_000), 6)
    assert find_runs(many) == [(0, 120_000, 20_000)]


def test_awkward_documents(odd, none):
    rows = periodic_runs(odd).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str) == sorted((plain_row(t, i) for i, t, _ in ROWS), key=str)
    assert periodic_runs(none).collect() == []


def test_texts_and_runs_come_out(spark):
    docs = spark.createDataFrame([("x", "a b a b a b\ta b c")], "name string, body string")
    (row,) = periodic_runs(docs, "name", "body", with_text=True).collect()
    assert [tuple(r) for r in row["runs"]] == [(0, 8, 2)] and row["collapsed"] == "a b c" and row["name"] == "x"


def test_the_query_against_brute_force(spark, tmp_path):
    rnd = random.Random(5)
    texts = [rnd.choice([" ", "\n", "\x0b "]) + " ".join(f"w{x}" for x in random_words(rnd)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, None) for i in range(30)] + [(None, "a b c d e f g h"), (3, " \t")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=str) == sorted((plain_row(t, i, True) for i, t in rows), key=str)


def test_repeats_keep_texts_without_words(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = spark.createDataFrame([(i, t) for i in ids for t in (None, "", "  ")], "doc_id bigint, text string")
    assert {(r[0] or "").strip() for r in docs.select(with_repeats()).collect()} == {""}
