"""Packing and token files, against the library itself."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from llm_rows import ROWS
from tallyguard.llm import rans, token_files
from tallyguard.llm.packing import best_fit, pack
from tallyguard.llm.tokens import Encoder

WORDS, BYTES = path("word_bpe_49k.json"), path("byte_bpe_50k.json")
ODD = [
    "", " ", "don't stop's 'tis I'LL ½²³ ªº ß µ À.É, x.y x., a\xa0b\x85c\x0bd\x1ce", "İstanbul Σας", "a<|endoftext|>b",
    "é ﬁ 中文", "x" * 300 + "1" * 50, "\x00\x01 \xad- a\xadb", "word.!! a,b, c., 1.2 $$$ ston$$$",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("file", [WORDS, BYTES])
def test_ids_are_the_library_s(file):
    encode, whole = Encoder(file), Tokenizer.from_file(file)
    random.seed(3)
    letters = "abt é.,'s1 \n\t!$Ä"
    texts = ODD + ["".join(random.choices(letters, k=random.randint(1, 80))) for _ in range(500)]
    for text in texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def brute_fill(lengths, window):
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, i) for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting)[1]] -= length
        else:
            rooms.append(window - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(60))
def test_rules_fill_windows_as_one_by_one(seed):
    random.seed(seed)
    window = random.choice([8, 16, 50, 64])
    lengths = [random.randint(1, window) for _ in range(random.randint(0, 90))]
    counts = Counter(lengths)
    rules, spans, number = best_fit(dict(counts), window), {}, 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            rule = rules[rules["first"] <= number].iloc[-1]
            turn, within = divmod(number - rule["first"], rule["each"])
            spans.setdefault(rule["sequence"] + turn, []).append((rule["offset"] + within * length, length))
            number += 1
    rooms = []
    for span in spans.values():
        at = 0
        for offset, length in sorted(span):
            assert offset == at
            at += length
        rooms.append(window - at)
    assert sorted(rooms) == brute_fill(lengths, window)
    assert sorted(spans) == list(range(len(spans)))


def test_rules_stay_few_for_many_pieces():
    counts = {n: 10**9 + 7 * n for n in range(1, 4097)}
    assert len(best_fit(counts)) < 3 * 4096 * 12


@pytest.mark.parametrize("window", [64, 4096])
def test_packed_pieces_hold_every_id_once(odd, library, window):
    rows = pack(odd, WORDS, window=window, with_ids=True).collect()
    wanted = Counter((i, tuple(ids_of(library, t) + [2])) for i, t, _ in ROWS)
    documents = {}
    for r in rows:
        assert r["length"] == len(r["ids"]) <= window
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        documents.setdefault((r["doc_id"], r["doc_tokens"], r["start"]), []).append(tuple(r["ids"]))
    for (i, ids), times in wanted.items():
        for at in range(0, len(ids), window):
            pieces = documents[i, len(ids), at]
            assert sum(p == ids[at : at + window] for p in pieces) == times
    assert sum(r["length"] for r in rows) == sum(len(ids) * n for (_, ids), n in wanted.items())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(sequences) == list(range(len(sequences)))
    for span in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(span)])
        assert [o for o, _ in sorted(span)] == ends[:-1].tolist() and ends[-1] <= window


def test_packing_no_rows(none):
    assert pack(none, WORDS).count() == 0


@pytest.mark.parametrize("count", [0, 1, 5, 1023, 1024, 1025, 140_000])
def test_coder_round_trip_from_every_checkpoint(count):
    ids = (np.random.default_rng(1).zipf(1.3, count) % 49_000).astype("<u4")
    found, counts = np.unique(ids, return_counts=True) if count else (np.array([7]), np.array([1]))
    table = rans.Table(found, counts)
    words, places, states = rans.encode(table, ids)
    assert (rans.decode(table, words, places, states, count) == ids).all()
    step = rans.CHECKPOINT_ROWS * rans.LANES
    for i in range(len(places)):
        assert (rans.decode(table, words, places, states, count, i) == ids[i * step : (i + 1) * step]).all()


def test_coded_words_are_near_the_entropy():
    ids = np.random.default_rng(2).choice(4, 200_000, p=[0.7, 0.2, 0.06, 0.04]).astype("<u4")
    counts = np.bincount(ids)
    entropy = -(counts / counts.sum() * np.log2(counts / counts.sum())).sum() * len(ids) / 8
    words, _, _ = rans.encode(rans.Table(np.arange(4), counts), ids)
    assert 4 * len(words) < 1.02 * entropy + 4096


def test_checksums_combine():
    for a, b in ((b"abc", b"defg"), (b"", b"x" * 1000), (b"q" * 999, b"")):
        assert token_files.crc32_combine(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


@pytest.mark.parametrize("block_ids", [50, 1 << 18])
def test_files_read_back(spark, odd, library, block_ids, tmp_path):
    folder = str(tmp_path / "files")
    token_files.write_token_files(odd, WORDS, folder, block_ids=block_ids)
    rows = sorted(token_files.read_documents(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in rows] == [i for i, _, _ in order]
    at, wanted = 0, Counter((i, tuple(ids_of(library, t) + [1])) for i, t, _ in ROWS)
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += len(r["ids"])
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == wanted


def test_a_damaged_block_is_found(spark, odd, tmp_path):
    from pyspark.sql import functions as F

    folder = str(tmp_path / "files")
    token_files.write_token_files(odd, WORDS, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    worse = blocks.withColumn("words", F.overlay("words", F.lit(b"\x01\x02\x03\x04"), F.lit(9)))
    worse.write.parquet(f"{folder}-bad/blocks")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{folder}-bad/table")
    with pytest.raises(Exception, match="damaged"):
        token_files.read_documents(spark, f"{folder}-bad").collect()


def test_files_of_no_rows(spark, none, tmp_path):
    token_files.write_token_files(none, WORDS, str(tmp_path / "files"))
    assert token_files.read_documents(spark, str(tmp_path / "files")).count() == 0
