"""The pipeline's stages and queries of this folder."""

import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from __spark_entry__ import oracle_sql, queries
from check_oracle import compare, connect
from llm_rows import CLASHES, ROWS
from plain_quality import plain_quality
from tallyguard.llm.queries import ORACLE, QUERIES
from tallyguard.session import stage
from tokenizers import Tokenizer

FOLDER = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert names["pipeline"] is pipeline.run and set(QUERIES) <= set(names) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    fine, note = compare(spark, connect(FOLDER), FOLDER, name, QUERIES[name], ORACLE[name])
    assert fine, note


def test_stages_keep_columns_and_decide(spark, odd):
    docs, kept = odd, {}
    for name, function in pipeline.STAGES[:-1]:
        docs = stage(function(spark, docs, FOLDER), name)
        assert docs.schema.simpleString() == odd.schema.simpleString()
        kept[name] = sorted(str(r["doc_id"]) for r in docs.collect())
    assert not {"3", "4", "5", "9"} & set(kept["language_id"])
    assert {"1", "8", "None", "12"} <= set(kept["language_id"])


def test_each_stage_drops_what_it_must(spark, odd):
    stages = dict(pipeline.STAGES)
    once = stage(stages["exact_dedup"](spark, odd, FOLDER), "exact")
    ids = sorted(str(r["doc_id"]) for r in once.collect())
    assert ids == sorted(["1", "3", "5", "6", "7", "8", "9", "12", "13"])
    near = stage(stages["simhash_near_dedup"](spark, once, FOLDER), "near")
    left = {r["doc_id"] for r in near.collect()}
    assert 1 in left and 13 not in left and 3 in left and 5 not in left


def test_stages_take_an_input_whose_rows_come_in_another_order_each_time(spark, odd):
    """Numbers given in two passes over such an input would name different rows."""
    restless = odd.repartition(4, F.rand()).orderBy(F.rand())
    for name, function in pipeline.STAGES[:-1]:
        steady = sorted(str(tuple(r)) for r in function(spark, odd, FOLDER).collect())
        assert sorted(str(tuple(r)) for r in function(spark, restless, FOLDER).collect()) == steady, name


@pytest.mark.parametrize("labels", [[], [(99, 1, 0), (1, None, 0), (2, 7, 0)]])
def test_every_document_stays_where_no_quality_is_learnt(spark, odd, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = dict(pipeline.STAGES)["quality"](spark, odd, str(tmp_path))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in odd.collect())


def test_empty_documents(spark, none):
    empty = stage(none, "none")
    for name, function in pipeline.STAGES:
        assert function(spark, empty, FOLDER).count() == 0, name


def test_run_on_the_tables(spark):
    rows = pipeline.run(spark, FOLDER).collect()
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert sorted(fill) == list(range(len(fill))) and max(fill.values()) <= 4096
    documents = {r["doc_id"]: r["doc_tokens"] for r in rows}
    assert sum(fill.values()) == sum(documents.values()) and 100 < len(documents) < 200
    assert len(CLASHES) and len(ROWS)


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_linked(prints):
    """The ids that are the smallest of their component, all pairs compared."""
    ids, root = sorted(prints), {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and root[a] < root[b]:
                    root[b], changed = root[a], True
    return {i for i in ids if root[i] == i}


def test_run_equals_a_plain_version(spark):
    """Quality, equal texts, near texts and tokens written a second time; languages from their operator, whose masks
    and shares have a test of their own."""
    first = pipeline.STAGES[0][1](spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), FOLDER)
    rows = sorted((r["doc_id"], r["text"]) for r in first.select("doc_id", "text").collect())
    labels = dict(pd.read_parquet(f"{FOLDER}/labels.parquet")[["doc_id", "quality"]].itertuples(index=False))
    learn = np.array([labels.get(i) in (0, 1) for i, _ in rows])
    scores = plain_quality([t for _, t in rows], learn, [labels.get(i) for i, _ in rows])
    texts = {}
    for (i, text), score in zip(rows, scores):
        if score >= 0.7:
            texts.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text), (i, text))
    texts = dict(texts.values())
    left = smallest_linked({i: fingerprint(t) for i, t in texts.items()})
    library = Tokenizer.from_file(str(tokenizer_path("word_bpe_49k.json")))
    wanted = {i: len(library.encode(texts[i], add_special_tokens=False).ids) + 1 for i in left}
    found, pieces = {}, {}
    for r in pipeline.run(spark, FOLDER).collect():
        found[r["doc_id"]] = r["doc_tokens"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert found == wanted
    for i, parts in pieces.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == wanted[i]
