import hashlib
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm_rows import ROWS, by
from tallyguard.llm.exact import exact_groups


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, _ in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for doc_id, text, _ in rows:
        group = groups[normal(text)]
        keep = min((i for i in group if i is not None), default=None)
        out.append((doc_id, keep, len(group), hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("block_chars", [7, 64, 4096])
def test_groups_agree_with_brute_force(odd, block_chars):
    out = exact_groups(odd, block_chars=block_chars)
    assert by(out, "doc_id", "keep_id", "group_size", "text_sha256") == brute(ROWS)


def test_one_row_of_every_group_stays(odd):
    out = exact_groups(odd)
    kept = out.where("kept")
    assert kept.count() == len({normal(t) for _, t, _ in ROWS})
    assert kept.where("row_no <> keep_row").isEmpty()
    assert out.where("doc_id = 8 AND kept").count() == 1


def test_names_hold_when_block_keys_collide(odd):
    out = exact_groups(odd, block_chars=16, block_key=lambda b: F.xxhash64(b) % 3)
    assert by(out, "doc_id", "keep_id", "group_size", "text_sha256") == brute(ROWS)


def test_texts_that_differ_in_one_late_byte_are_apart(make_docs):
    base = "abcd " * 5000
    docs = make_docs([(1, base + "x", None), (2, base + "y", None), (3, base + "x", None)])
    assert by(exact_groups(docs, block_chars=512), "doc_id", "keep_id") == [(1, 1), (2, 2), (3, 1)]


def test_very_long_texts_cost_in_proportion(spark, make_docs):
    """Sixteen megabytes, cut without normalising them for every block."""
    unit = "".join(f"word{i} \n" for i in range(1600))
    base = unit * (16_000_000 // len(unit))
    docs = make_docs([(1, base + "x", None), (2, base + "y", None), (3, base.replace("\n", "\t") + "x", None)])
    start = time.monotonic()
    out = by(exact_groups(docs), "doc_id", "keep_id", "text_sha256")
    assert time.monotonic() - start < 120
    assert [r[:2] for r in out] == [(1, 1), (2, 2), (3, 1)]
    assert out[0][2] == hashlib.sha256(normal(base + "x").encode()).hexdigest()


def test_no_rows(none):
    assert exact_groups(none).count() == 0


def test_no_python_runs(odd):
    plan = exact_groups(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
