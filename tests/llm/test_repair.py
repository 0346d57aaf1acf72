import hashlib
import random
import re
import zlib

import pytest

from tallyguard.llm import repair
from tallyguard.llm.queries import op12_conversation_repair
from tallyguard.llm.repair import repair_conversations

COLUMNS = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
ALLOWED = re.compile("(s?(ua)+)?")


def faults_of(rows):
    out, seen = [], set()
    for role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Every edit of every row, by growing cost: the first that gives allowed initials, least in ASCII of these.

    States are those of a plain search over (rows used, initials so far in short form, cost).
    """
    best = {}

    def search(at, shape, cost, audit, lines, limit):
        # shape: "" start, "s", "u", "a" by the last initial
        if cost > limit:
            return
        key = (at, shape)
        if (cost, audit) > best.get(key, (limit, "~")):
            return
        best[key] = (cost, audit)
        if at == len(rows) and shape in ("", "a"):
            ends.append((cost, audit, lines))
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[shape]
        if at < len(rows):
            role, text = rows[at]
            search(at + 1, shape, cost + 4, audit + "D", lines, limit)
            if faults[at] not in ("blank", "duplicate"):
                extra = 3 * (faults[at] == "truncated")
                if role[:1] and role[:1] in follow:
                    search(at + 1, role[0], cost + extra, audit + "K", [*lines, f"{role}:{text}"], limit)
                for new in ("user", "assistant"):
                    if new[0] in follow:
                        search(at + 1, new[0], cost + 3 + extra, audit + "R", [*lines, f"{new}:{text}"], limit)
        for new in ("user", "assistant"):
            if new[0] in follow:
                search(at, new[0], cost + 3, audit + "I", [*lines, f"{new}:"], limit)

    ends = []
    search(0, "", 0, "", [], 4 * len(rows))
    return min(ends)


def plain(conv, rows):
    """(turn, role, text, gone) rows in their order to the result of one conversation."""
    rows = [r for r in rows if not r[3]]
    faults = faults_of([r[1:3] for r in rows])
    cost, audit, lines = cheapest([r[1:3] for r in rows], faults)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    assert ALLOWED.fullmatch("".join(line[0] for line in lines))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (conv, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def damaged(conv, rows):
    out = []
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text, kind == 0)] * (2 if kind == 3 else 1)
    return out


def random_rows(rnd, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "no", " \n", "", None, "What? ", "a b!\t", "Sure"]
    return [(i if rnd.random() < 0.8 else None, rnd.choice(roles), rnd.choice(texts) if rnd.random() < 0.5 else f"t{rnd.random()}.") for i in range(n)]


def conversations(seed, count=120, longest=9):
    rnd = random.Random(seed)
    out = {}
    for c in range(count):
        rows = random_rows(rnd, rnd.randint(1, longest))
        if sum(r[0] is None for r in rows) > 1:  # rows with one turn have an order of their own, tested apart
            rows = [(i, *r[1:]) for i, r in enumerate(rows)]
        out[c - 1 if c else None] = rows
    return out


def test_one_conversation_against_all_edits():
    rnd = random.Random(1)
    for _ in range(400):
        rows = [(t, r or "", x or " ", rnd.random() < 0.1) for t, r, x in random_rows(rnd, rnd.randint(0, 8))]
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        found = repair.repair_one([dict(zip(("turn", "role", "text", "gone"), r)) for r in rows], True)
        assert tuple(found[c] for c in COLUMNS[1:]) == plain(0, rows)[1:], rows
        assert hashlib.sha256(found["repaired"].encode()).hexdigest() == found["repaired_sha256"]


def test_long_runs_are_powers():
    rows = [("u", False)] * 1000 + [None] * 77 + [("a", True)] * 300 + [("s", False)] * 9
    slow = repair.NOTHING
    for row in rows:
        slow = repair.product(slow, repair.power(row, 0))
    assert repair.transition(rows) == slow
    audit, state = repair.unrolled(rows, repair.AT_END, 0)
    left = slow
    cost = sum(4 * a.count("D") + 3 * a.count("I") + 3 * a.count("R") for a in audit)
    cost += sum(3 for a, r in zip(audit, rows) if r and r[1] and "D" not in a) + 3 * len(repair.ending(state))
    assert cost == repair.applied(left, repair.AT_END)[0]


@pytest.mark.parametrize(("whole", "chunk"), [(4096, 4096), (3, 2), (1, 1), (5, 3)])
def test_the_query_against_brute_force(spark, tmp_path, monkeypatch, whole, chunk):
    data = conversations(whole, longest=9 if whole > 10 else 8)
    rows = [(c, *r) for c, part in data.items() for r in part]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(repair.repair_conversations, "__defaults__", (*repair.repair_conversations.__defaults__[:-2], whole, chunk))
    found = op12_conversation_repair(spark, str(tmp_path)).collect()
    expected = [plain(c, damaged(c, part)) for c, part in data.items()]
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found), key=str) == sorted(expected, key=str)


def test_a_hot_conversation_lies_in_many_partitions(spark):
    rnd = random.Random(4)
    rows = [(7, i, *rnd.choice([("user", "Hi."), ("assistant", f"ok {i}."), ("user", f"so {i}"), ("system", "x.")])) for i in range(3000)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"{t}.") for c in range(20) for t in range(4) if c != 7]
    clashes = "k string, part int, place int, chunk int, gone int, audit int, first int, number int"
    df = spark.createDataFrame([(*r, "x", *range(7)) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {clashes}")
    found = {r["conv_id"]: r for r in repair_conversations(df, chunk_rows=100, with_text=True).collect()}
    whole = repair.repair_one([{"turn": r[1], "role": r[2], "text": r[3], "gone": False} for r in rows if r[0] == 7], True)
    assert {c: found[7][c] for c in whole} == whole
    assert all((found[c]["cost"], found[c]["audit"]) == (0, "KKKK") for c in range(20) if c != 7)


def test_equal_turns_repeated_rows_and_no_rows(spark):
    schema = "name string, turn bigint, role string, text string"
    rows = [("x", None, "user", "b."), ("x", None, "user", "b."), ("x", 1, "assistant", "c."), ("x", 1, "assistant", "c.")]
    (row,) = repair_conversations(spark.createDataFrame(rows, schema), "name").collect()
    assert (row["name"], row["duplicate"], row["cost"], row["audit"], row["gaps"]) == ("x", 2, 8, "KDKD", 0)
    assert repair_conversations(spark.createDataFrame([], schema), "name").collect() == []
    gone = spark.createDataFrame([("y", 1, "user", "a.", True)], schema + ", off boolean")
    (row,) = repair_conversations(gone, "name", gone_col="off").collect()
    assert tuple(row) == ("y", 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
