"""Language ID, quality classifier and language model: brute force where there is one, else held-out accuracy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm_rows import ROWS, by
from plain_quality import plain_quality, plain_statistics
from tallyguard.llm import base, langid, pitman_yor, quality
from tallyguard.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{FOLDER}/documents.parquet")


def remainder(doc_id, divisor):
    return zlib.crc32(str(doc_id).encode()) % divisor


# Language ID


def plain_grams(text):
    padded = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    return [padded[i - 1 : i + 2] for i in range(1, len(padded) - 1) if padded[i] != " "]


def as_text(key):
    return "".join(chr(key >> s & 0x1FFFFF) if key >> s & 0x1FFFFF else " " for s in (42, 21, 0))


@pytest.mark.parametrize("cut", [5, 1 << 20])
def test_grams_of_whole_texts(monkeypatch, cut):
    monkeypatch.setattr(langid, "SLICE", cut)
    for text in ["", "a", "Été à la mer, 12 ok!", "中文 x", "no-break", " lead and trail ", "İx ß"]:
        found = [as_text(int(k)) for part in langid.grams(text) for k in part]
        assert found == plain_grams(text), text


def test_filters_hold_what_was_learnt_and_correct_false_hits():
    rng = np.random.default_rng(1)
    keys = {lang: rng.integers(1, 2**62, 3000) for lang in ("aa", "bb", "cc")}
    filters = langid.LanguageFilters([(x, int(k), 1) for x, ks in keys.items() for k in ks], dict.fromkeys(keys, 3000))
    other = rng.integers(1, 2**62, 50_000)
    for bit, lang in enumerate(filters.langs):
        def hits(values, bit=bit):
            common = ~np.uint64(0)
            for places in filters.places(values):
                common = common & filters.masks[bit // 64, places]
            return ((common >> np.uint64(bit)) & np.uint64(1)).mean()

        assert hits(keys[lang]) == 1.0
        assert abs(hits(other) - filters.false_rate[bit]) < 0.002


def test_more_languages_than_bits_of_a_word():
    langs = [f"l{i:03d}" for i in range(130)]
    found = [(lang, (97 + i) << 21, 1) for i, lang in enumerate(langs)]
    filters = langid.LanguageFilters(found, dict.fromkeys(langs, 1))
    assert all(filters.predict(chr(97 + i))[0] == lang for i, lang in enumerate(langs) if chr(97 + i).islower())


def test_counts_agree_with_brute_force(odd, spark):
    wanted = Counter((lang, g) for _, t, lang in ROWS if lang and t for g in plain_grams(t))
    found = {(r["lang"], as_text(r["gram"])): r["count"] for r in langid.count_grams(odd, "text", "lang").collect()}
    assert found == dict(wanted)


def test_odd_texts_have_defined_languages(odd, none):
    rows = {r["doc_id"]: r for r in langid.identify(odd).collect()}
    assert [rows[i]["lang_pred"] for i in (3, 4, 5)] == ["und"] * 3
    assert rows[1]["lang_pred"] == "en" and rows[8]["lang_pred"] == "fr" and rows[8]["score"] > 0.9
    assert rows[9]["lang_pred"] in ("en", "fr") and rows[9]["score"] == 0
    assert langid.identify(odd).count() == len(ROWS)
    assert langid.identify(none).count() == 0
    untaught = langid.identify(odd, train=F.lit(False)).collect()
    assert {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}


def test_relative_score_does_not_sink_with_rare_grams(spark):
    """A script with very many 3-grams: the filter holds few of them, and clean texts would go at 0.3."""
    rng = random.Random(8)
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(80)) + " 中文中文中文中文中文" for _ in range(60)]
    docs = spark.createDataFrame([(i, t, "zh") for i, t in enumerate(texts)], "doc_id bigint, text string, lang string")
    plain = langid.identify(docs, min_share=0.005).collect()
    assert all(r["lang_pred"] == "zh" and 0 < r["score"] < 0.3 for r in plain)
    relative = langid.identify(docs, min_share=0.005, relative=True).collect()
    assert all(r["lang_pred"] == "zh" and 0.9 < r["score"] <= 1 for r in relative)


def test_thousands_of_languages(spark):
    """Each with a letter of its own, on either side of what they share."""
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 5000)]
    rows = [(i, f"{x}{x} shared {x}{x}{x}", f"l{i}") for i, x in enumerate(letters)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert all(found[i]["lang_pred"] == lang and found[i]["score"] > 0.9 for i, _, lang in rows)


def test_table_put_together_in_blocks(spark, documents, monkeypatch):
    """Blocks of the cluster make the table that the n-grams at hand make; a small table is full, not short."""
    docs = spark.createDataFrame(documents[["text", "lang"]].dropna())
    monkeypatch.setattr(langid, "BLOCK_BITS", 1 << 12)
    for size in (1 << 27, 1 << 12):
        monkeypatch.setattr(langid, "TABLE_BYTES", size)
        filters = langid.learn(docs, typical=0.0)
        counts = [(r["lang"], r["gram"], r["count"]) for r in langid.count_grams(docs, "text", "lang").collect()]
        totals = Counter()
        for lang, _, count in counts:
            totals[lang] += count
        plain = langid.LanguageFilters(counts, dict(totals))
        assert filters.masks.nbytes <= size and np.array_equal(filters.masks, plain.masks)
        assert np.allclose(filters.false_rate, plain.false_rate) and (filters.reached == 1).all()


def test_foreign_words_do_not_join_a_language(spark):
    rows = [("en", "the whole thing " * 300)] * 3 + [("fr", "une chose entière " * 900 + "whole")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string")
    counts = langid.count_grams(docs, "text", "lang")
    totals = {r["lang"]: r["t"] for r in counts.groupBy("lang").agg(F.sum("count").alias("t")).collect()}
    languages = spark.createDataFrame([("en", 0, totals["en"]), ("fr", 1, totals["fr"])], "lang string, code bigint, total bigint")
    held = {(as_text(r["gram"]), r["code"]) for r in langid.typical_grams(counts, languages, langid.TYPICAL, 0.0).collect()}
    assert ("who", 0) in held and ("who", 1) not in held and ("ose", 1) in held
    assert {g for g, _ in held} == {as_text(r["gram"]) for r in counts.collect()}


def test_language_query_on_held_out_rows(spark, documents):
    out = QUERIES["op2_language_id"](spark, FOLDER).toPandas().merge(documents, on="doc_id")
    assert list(out["held_out"]) == [remainder(i, 5) == 0 for i in out["doc_id"]]
    held = out[out["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert out["score"].between(0, 1).all() and len(out) == len(documents)


# Quality


def test_sums_meet_whole(spark):
    df = spark.range(0, 1000, 1, 40).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    total = base.summed(df, 2, lambda batch: base.matrix(batch.column(0)).sum(axis=0))
    assert total.tolist() == [499500.0, 1000.0]


def test_isotonic_steps_are_the_least_squares_ones():
    random.seed(3)
    for _ in range(50):
        n = random.randint(1, 12)
        counts, ones = [random.randint(1, 5) for _ in range(n)], []
        ones = [random.randint(0, c) for c in counts]
        fitted = quality.Calibration(list(range(n)), counts, ones)
        values = fitted.values[np.searchsorted(fitted.starts, range(n), side="right") - 1]
        means = np.array(ones) / counts
        wanted = [
            max(
                min(np.average(means[i : j + 1], weights=counts[i : j + 1]) for j in range(k, n))
                for i in range(k + 1)
            )
            for k in range(n)
        ]
        assert np.allclose(values, wanted)


def test_kernel_approximates_a_gaussian():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((40, len(quality.STATISTICS)))
    z = quality.Kernel(np.zeros(x.shape[1]), np.ones(x.shape[1]), 20_000, 1)(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None, :]) ** 2).sum(axis=2) / (2 * 2 * x.shape[1]))
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_fit_agrees_with_normal_equations_in_one_place(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(7)
    model = quality.fit(rows, features=32)
    kernel = quality.Kernel(x.mean(axis=0), x.std(axis=0), 32, quality.SEED)
    z = kernel(x)
    penalty = quality.RIDGE * np.eye(33)
    penalty[-1, -1] = 1e-6
    assert np.allclose(model.raw(x), z @ np.linalg.solve(z.T @ z + penalty, z.T @ y), atol=1e-6)


def test_statistics_take_any_text():
    for _, text, _ in ROWS:
        values = quality.statistics(text or "")
        assert len(values) == len(quality.STATISTICS) and np.isfinite(values).all()


def test_odd_documents_and_labels(odd, none, spark):
    labels = [(1, 1, 0), (2, 1, 0), (6, 1, 0), (4, 0, 0), (5, 0, 0), (7, None, 0), (None, 1, 0), (99, 1, 0), (1, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, x int")
    out = quality.classify(odd, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in out)
    untaught = quality.classify(odd, labels.where("false")).collect()
    assert {(r["score"], r["predicted"]) for r in untaught} == {(0.5, 0)}
    assert quality.classify(none, labels).count() == 0


def test_statistics_equal_a_plain_version():
    texts = [text or "" for _, text, _ in ROWS] + ["A|B !? {x}\n\nA|B !? {x}\n", "word, word; WORD É É", "\u2028 \x1c x"]
    for text in texts:
        assert np.allclose(quality.statistics(text), plain_statistics(text), atol=1e-9), text[:40]


def test_scores_equal_a_plain_version(spark):
    """The query's whole score: statistics, random features, ridge, bins and steps, written a second time."""
    labels = dict(pd.read_parquet(f"{FOLDER}/labels.parquet")[["doc_id", "quality"]].itertuples(index=False))
    rows = list(pd.read_parquet(f"{FOLDER}/documents.parquet")[["doc_id", "text"]].itertuples(index=False))
    learn = np.array([remainder(i, 4) != 2 and labels.get(i) in (0, 1) for i, _ in rows])
    wanted = plain_quality([t for _, t in rows], learn, [labels.get(i) for i, _ in rows])
    out = {r["doc_id"]: r for r in QUERIES["op9_quality"](spark, FOLDER).collect()}
    got = np.array([out[i]["score"] for i, _ in rows])
    assert np.abs(got - wanted).max() < 1e-9
    assert [out[i]["predicted"] for i, _ in rows] == [int(s >= 0.7) for s in got]


def test_quality_query_on_held_out_rows(spark):
    labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet")
    out = QUERIES["op9_quality"](spark, "/root/testdata/sf0.01").toPandas().merge(labels, on="doc_id")
    assert list(out["held_out"]) == [remainder(i, 4) == 2 for i in out["doc_id"]]
    held = out[out["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.93


# Language model


def test_moves_keep_customers_and_reach_the_right_seatings():
    """Three customers of one dish, new tables at a fixed weight: the chances of 1, 2 and 3 tables are known."""
    discount, weight, copies = 0.5, 0.8, 40_000
    seats = pitman_yor.Seats(np.full(copies, 3), discount)
    rng, every = np.random.default_rng(1), np.arange(copies)
    for _ in range(25):
        seats.remove(every, rng)
        seats.add(every, np.full(copies, weight), rng)
        assert (np.bincount(seats.owner, weights=seats.sizes) == 3).all()
    found = np.bincount(seats.tables(), minlength=4)[1:] / copies
    chance = np.array([weight * (1 - discount) * (2 - discount), 3 * weight**2 * (1 - discount), weight**3])
    assert np.abs(found - chance / chance.sum()).max() < 0.01


def test_drawn_tables_agree_with_moving_every_customer():
    discount, copies = 0.5, 20_000
    drawn = pitman_yor.draw_tables(np.full(copies, 3), np.full(copies, 0.8), discount, np.random.default_rng(1))
    chance = np.array([0.8 * (1 - discount) * (2 - discount), 3 * 0.8**2 * (1 - discount), 0.8**3])
    assert np.abs(np.bincount(drawn, minlength=4)[1:] / copies - chance / chance.sum()).max() < 0.015
    counts = np.array([0, 1, 2, 40, 512, 513, 5000])
    many = pitman_yor.draw_tables(counts, np.full(len(counts), 1e-12), discount, np.random.default_rng(2))
    assert many.tolist() == [0, 1, 1, 1, 1, 1, 1]
    many = pitman_yor.draw_tables(counts, np.full(len(counts), 1e12), discount, np.random.default_rng(2))
    assert many.tolist() == counts.tolist()


@pytest.mark.parametrize("discount", [0.1, 0.5, 0.8, 0.95])
def test_integral_agrees_with_recurrence(monkeypatch, discount):
    monkeypatch.setattr(pitman_yor, "TRIANGLE", 1500)
    monkeypatch.setattr(pitman_yor, "_triangles", {})
    for count in (513, 1500):
        for weight in (1e-9, 0.05, 1, 20, 300, 1000, 1e4, 1e6):
            logs = pitman_yor.triangle(discount)[count] + np.arange(1, count + 1) * np.log(weight)
            wanted = np.exp(logs - logs.max())
            least, chance = pitman_yor.chances(count, weight, discount)
            found = np.zeros(count)
            found[least - 1 : least - 1 + len(chance)] = chance
            assert np.abs(found - wanted / wanted.sum()).max() < 1e-6, (count, weight)


def test_a_sweep_seats_frequent_pairs_anew():
    """Two pairs with many customers forget how they started: one sweep gives the tables that their weights ask for."""
    counts = np.array([5000, 400])
    row = {"bucket": 0, "words": np.arange(2).astype("<u8").tobytes(), "each": pitman_yor.squeezed(np.ones(2), "<u4")}
    row |= {"contexts": pitman_yor.squeezed(np.zeros(2), "<u2"), "counts": pitman_yor.squeezed(counts, "<u4")}
    seated = np.zeros(pitman_yor.CONTEXTS)
    seated[0] = counts.sum()
    settings = pitman_yor.Settings(seated, 2, 3, 1)
    bucket = pitman_yor.Bucket(row, settings)
    totals = np.zeros(pitman_yor.CONTEXTS + 2)
    totals[0], totals[-2], totals[-1] = 10, 10_000, 2
    weight = (pitman_yor.STRENGTH + settings.discount * 10) * bucket.parent_probability(pitman_yor.Totals(totals))
    bucket.sweep(1, pitman_yor.Totals(totals))
    assert bucket.tables().sum() < 40 and (weight < 5).all()


def test_seats_follow_their_counts():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 9, 500)
    seats = pitman_yor.Seats(counts, 0.7)
    wanted = rng.integers(0, 9, 500)
    seats.resize(wanted, np.full(500, 0.5), rng)
    assert (np.bincount(seats.owner, weights=seats.sizes, minlength=500) == wanted).all()
    assert (seats.sizes > 0).all() and (np.diff(seats.owner) >= 0).all()


def plain_scores(rows, train):
    words = {k: (t or "").encode().lower().split() + [b""] for k, (_, t, _) in enumerate(rows)}
    counts = Counter(w for k, ws in words.items() if train(rows[k][0]) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return n, [
        (rows[k][0], len(ws), sum(w in counts for w in ws), sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        for k, ws in words.items()
    ]


@pytest.mark.parametrize("tokens,bucket,turn", [(2_000_000, 400_000, 1024), (500, 100, 2)])
def test_counts_and_base_scores(odd, monkeypatch, tokens, bucket, turn):
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", tokens)
    monkeypatch.setattr(pitman_yor, "BUCKET_WORDS", bucket)
    monkeypatch.setattr(pitman_yor, "TURN_CHUNKS", turn)
    n, wanted = plain_scores(ROWS, lambda i: i is None or i % 3 != 0)
    out = pitman_yor.score_documents(odd, F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))).collect()

    def order(r):
        return str(r[0]), r[1], r[3]

    found = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in out), key=order)
    for a, b in zip(found, sorted(wanted, key=order), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-6 * max(1, a[1])
    assert {r["train_tokens"] for r in out} == {n}
    assert all(np.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(3)
    words = np.sort(rng.choice(2**60, 30, replace=False)).astype("<u8")
    each = rng.integers(1, 5, 30)
    contexts = np.concatenate([np.sort(rng.choice(6, k, replace=False)) for k in each])
    counts = rng.integers(1, 20, len(contexts))
    squeezed = pitman_yor.squeezed
    row = {"bucket": 0, "words": words.tobytes(), "each": squeezed(each, "<u4")}
    row |= {"contexts": squeezed(contexts, "<u2"), "counts": squeezed(counts, "<u4")}
    seated = np.bincount(contexts, weights=counts, minlength=pitman_yor.CONTEXTS)
    settings = pitman_yor.Settings(seated, 30, (counts == 1).sum(), (counts == 2).sum())
    bucket = pitman_yor.Bucket(row, settings)
    history = []
    for _ in range(3):
        history.append(bucket.totals())
        bucket.sweep(len(history), pitman_yor.Totals(history[-1]))
    now = pitman_yor.Totals(bucket.totals())
    parent = bucket.parent_probability(now)
    rest = (pitman_yor.STRENGTH + settings.parent_discount * now.parents) * settings.base
    rest /= pitman_yor.STRENGTH + now.customers
    assert abs(parent.sum() + rest - 1) < 1e-9
    own = bucket.counts - settings.discount * bucket.tables()
    for context in range(7):
        open_ = pitman_yor.STRENGTH + settings.discount * now.tables[context]
        total = own[bucket.context == context].sum() + open_ * (parent.sum() + rest)
        assert abs(total / (pitman_yor.STRENGTH + seated[context]) - 1) < 1e-9


def test_replayed_seats_are_the_same():
    rng = np.random.default_rng(4)
    words, counts = np.arange(50).astype("<u8"), rng.integers(1, 30, 50)
    row = {"bucket": 3, "words": words.tobytes(), "each": pitman_yor.squeezed(np.ones(50), "<u4")}
    row |= {"contexts": pitman_yor.squeezed(np.zeros(50), "<u2"), "counts": pitman_yor.squeezed(counts, "<u4")}
    seated = np.zeros(pitman_yor.CONTEXTS)
    seated[0] = counts.sum()
    settings = pitman_yor.Settings(seated, 50, 10, 5)

    def run():
        bucket = pitman_yor.Bucket(row, settings)
        list(bucket.replay([pitman_yor.Bucket(row, settings).totals()] * 3))
        return bucket.totals()

    assert (run() == run()).all()


def test_written_seats_go_on_as_replayed_ones(odd, monkeypatch):
    """Scores don't depend on how often seats are written."""
    found = []
    for every in (1, 100):
        monkeypatch.setattr(pitman_yor, "KEPT_EVERY", every)
        rows = pitman_yor.score_documents(odd, F.lit(True)).collect()
        found.append(sorted((str(r["doc_id"]), r["n_tokens"], r["score"]) for r in rows))
    assert found[0] == found[1]


def test_contexts_are_words_not_classes(spark):
    """Long words that end alike are followed by other words; so are short ones."""
    texts = ["northing alpha", "southing beta", "to gamma", "of delta"] * 30
    asked = ["northing alpha", "northing beta", "southing beta", "southing alpha", "to gamma", "to delta"]
    rows = list(enumerate(texts + asked))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(docs, F.col("doc_id") < len(texts)).collect()}
    scores = [out[len(texts) + k] for k in range(len(asked))]
    assert all(right > wrong + 1 for right, wrong in zip(scores[::2], scores[1::2]))


def fitted_words(spark, monkeypatch, docs, train):
    """(chunk row, answers to it, model rows, what was fitted) with many buckets and few homes."""
    monkeypatch.setattr(pitman_yor, "HOMES", 3)
    monkeypatch.setattr(pitman_yor, "BOOK_WORDS", 10)
    base.ship(spark)
    chunks = pitman_yor.stage(pitman_yor.as_chunks(docs.coalesce(1), train, "doc_id", "text"), "chunks")
    book = spark.sparkContext.broadcast(pitman_yor.book_of(chunks))
    model, settings, n, notes, sizes = pitman_yor.fitted(chunks, 7, 1, book)
    found = pitman_yor.answers(pitman_yor.requests(chunks, 7, book, False), model, notes, 1, book)
    found = sorted((r.asDict() for r in found.collect()), key=lambda r: r["bucket"])
    (chunk,) = chunks.collect()
    return chunk.asDict(), found, model, settings, notes, sizes, book.value


@pytest.fixture
def word_documents(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"word{i}" for i in rng.zipf(1.5, 30) if i < 60) for _ in range(80)]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), texts


def test_pairs_and_tables_are_those_of_real_words(spark, monkeypatch, word_documents):
    """Counts of all pairs of words; totals of a context are the tables that its pairs have in all buckets."""
    from xxhash import xxh64_intdigest

    docs, texts = word_documents
    _, _, model, _, notes, sizes, book = fitted_words(spark, monkeypatch, docs, F.lit(True))
    wanted = Counter()
    for text in texts:
        words = [b"", *text.encode().split(), b""]
        wanted.update((xxh64_intdigest(w, 6), xxh64_intdigest(c, 6)) for c, w in zip(words, words[1:]))
    notes, rows = notes.collect(), [r.asDict() for r in model.collect()]
    found, tables = Counter(), [Counter() for _ in sizes]
    for row in rows:
        words, word, ids, place, counts = pitman_yor.pairs_of(row, book)
        found.update(dict(zip(zip(words[word].tolist(), ids[place].tolist()), counts.tolist())))
        for note in notes:
            if note["bucket"] == row["bucket"] and note["seated"] is not None:
                seated = np.ones(len(counts), "int64")
                seated[counts > 1] = pitman_yor.expanded(note["seated"], "<u4")
                for context, t in zip(ids[place].tolist(), seated.tolist()):
                    tables[note["sample"]][context] += t
    assert found == wanted and len(rows) == 7
    told = [Counter() for _ in sizes]
    for note in notes:
        if note["ids"] is not None:
            ids = book.unpack(note["ids"])
            assert set(ids % np.uint64(7)) == {note["bucket"]}
            for sample in told if note["sample"] is None else [told[note["sample"]]]:
                for context, t in zip(ids.tolist(), pitman_yor.expanded(note["amounts"], "<u4").tolist()):
                    sample[context] += t
    assert len(sizes) == pitman_yor.SAMPLES and [+t for t in told] == tables
    assert [sum(t.values()) for t in tables] == [customers for customers, _ in sizes]


def test_probabilities_after_a_word_sum_to_one(spark, monkeypatch, word_documents):
    docs, texts = word_documents
    words = sorted({w for t in texts for w in t.split()})
    contexts = ["word1", words[-1], "unheard"]
    asked = [f"{c} {w}" for c in contexts for w in [*words, "unseen", ""]]
    more = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(asked)], "doc_id bigint, text string")
    chunk, found, _, settings, _, sizes, _ = fitted_words(spark, monkeypatch, docs.union(more), F.col("doc_id") < 1000)
    own = pitman_yor.Chunk(chunk, 7)
    _, logs = pitman_yor.log_probabilities(own, found, settings, sizes)
    first = {chunk["ids"][k]: own.tokens[at] for k, at in enumerate(own.starts)}
    assert settings.words == len(words) + 1
    for k in range(len(contexts)):
        pairs = own.context == first[1000 + k * (len(words) + 2)]
        assert pairs.sum() == len(words) + 2 and abs((10 ** logs[pairs]).sum() - 1) < 1e-9


@pytest.mark.parametrize("high", [1, 50, 2**40, 2**62])
def test_distinct_keys_and_their_places(high):
    keys = np.random.default_rng(7).integers(0, high, 3000)
    for part in (keys, keys[:1], keys[:0]):
        found, wanted = pitman_yor.distinct(part), np.unique(part, return_inverse=True)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(found, wanted))


def test_words_come_back_from_the_book():
    rng = np.random.default_rng(6)
    words = rng.integers(0, 2**64, 400, dtype="<u8")
    book, asked = pitman_yor.Book(words[:50]), rng.choice(words[:300], 2000)
    packed = [book.pack(part) for part in np.split(asked, [700])]
    assert (np.concatenate([book.unpack(p) for p in packed]) == asked).all()
    ids, place = book.places(packed)
    assert (ids == np.unique(asked)).all() and (ids[place] == asked).all()
    known = np.sort(words[20:200])
    at, has = pitman_yor.Places(known, book).find(packed[0])
    assert (has == np.isin(asked[:700], known)).all() and (known[at[has]] == asked[:700][has]).all()
    samples = rng.integers(0, 9, (pitman_yor.SAMPLES, 40))
    assert (pitman_yor.unstacked(pitman_yor.stacked(samples)) == samples).all()


def test_runs_in_order_of_the_book_come_back_and_are_small():
    """Numbers and hashes are steps within runs: a chunk's dictionary and requests took 8 bytes a word outside before."""
    rng = np.random.default_rng(8)
    words = rng.integers(0, 2**64, 40_000, dtype="<u8")
    book, each = pitman_yor.Book(words[:20_000]), np.array([0, 3, 25_000, 0, 14_997, 0])
    for runs, parts in ((each, np.split(words, np.cumsum(each)[:-1])), (0, [words]), (None, [words])):
        packed = book.pack(words, each=runs)
        assert (book.unpack(packed, runs) == words).all()
        in_order = np.concatenate([part[book.in_order(part)] for part in parts])
        ordered = book.pack(in_order, each=runs)
        assert (book.unpack(ordered, runs) == in_order).all()
        if runs is not None:
            assert len(ordered) < 0.85 * len(packed) and len(ordered) < 7.5 * 20_000 + 20_000
            ids, place = book.places([ordered, packed], [runs, runs])
            assert (ids[place] == np.concatenate([in_order, words])).all()
    assert len(book.unpack(book.pack(words[:0], each=each[:1]), each[:1])) == 0


def test_chunks_with_a_book_hold_the_same_pairs_in_less(spark):
    """The book changes sizes only; chunks number words in its order."""
    base.ship(spark)
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.2, 300) % 20_000) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    plain = pitman_yor.as_chunks(docs, F.lit(True), "doc_id", "text").collect()[0].asDict()
    book = pitman_yor.book_of(spark.createDataFrame([plain], "tokens binary, words binary"))
    shared = spark.sparkContext.broadcast(book)
    (row,) = [r.asDict() for r in pitman_yor.as_chunks(docs, F.lit(True), "doc_id", "text", shared).collect()]
    found = []
    for chunk, known in ((pitman_yor.Chunk(plain, 3), pitman_yor.NO_BOOK), (pitman_yor.Chunk(row, 3, book), book)):
        pairs = zip(chunk.words[chunk.word].tolist(), chunk.words[chunk.context].tolist(), chunk.counts.tolist())
        found.append(sorted(pairs))
        assert (chunk.words[chunk.tokens] == pitman_yor.Chunk(plain, 3).words[pitman_yor.Chunk(plain, 3).tokens]).all()
        assert (known.in_order(chunk.words) == np.arange(len(chunk.words))).all()
    assert found[0] == found[1]
    assert len(row["words"]) < 0.6 * 8 * row["n_words"]


def test_a_bucket_answers_in_as_many_turns_as_its_pairs_need(spark, monkeypatch, odd):
    """The model went to every turn before, so that it was sent as often as there were turns of chunks."""
    monkeypatch.setattr(pitman_yor, "TURN_PAIRS", 100)
    rows = [(0, 5), (1, 100), (2, 101), (3, 250), (4, 10_000)]
    model = spark.createDataFrame(rows, "bucket bigint, asked bigint")
    assert dict(pitman_yor.turns_of(model, 7).collect()) == {0: 1, 1: 1, 2: 2, 3: 3, 4: 7}
    monkeypatch.setattr(pitman_yor, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(pitman_yor, "BUCKET_WORDS", 100)
    train, found = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True)), []
    for chunks, pairs in ((2, 1), (2, 100), (2, 1 << 24), (1024, 1)):
        monkeypatch.setattr(pitman_yor, "TURN_CHUNKS", chunks)
        monkeypatch.setattr(pitman_yor, "TURN_PAIRS", pairs)
        out = pitman_yor.score_documents(odd, train).collect()
        found.append(sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["score"]) for r in out))
    assert all(rows == found[0] for rows in found)


def test_scores_beat_the_base_on_held_out_rows(spark, documents):
    out = QUERIES["op6_lm_scoring"](spark, FOLDER).toPandas()
    assert list(out["held_out"]) == [remainder(i, 7) == 2 for i in out["doc_id"]]
    held = out[out["held_out"]]
    assert held["score"].sum() > held["base_score"].sum() + 0.1 * held["n_tokens"].sum()


def test_no_rows_to_learn_from_or_score(odd, none):
    assert pitman_yor.score_documents(none, F.lit(True)).count() == 0
    out = pitman_yor.score_documents(odd, F.lit(False)).collect()
    assert {r["train_tokens"] for r in out} == {0} and {r["n_known"] for r in out} == {0}
    assert all(abs(r["score"]) < 1e-6 and abs(r["base_score"]) < 1e-9 for r in out)
