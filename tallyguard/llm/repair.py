"""Conversation structure repair: the cheapest edits that make roles alternate, by runs of equal symbols."""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import ship, stage

#: Costs of the edits; a truncated row that stays costs more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows and characters of a conversation that one task takes whole; longer conversations are cut into chunks.
WHOLE_ROWS, WHOLE_CHARS = 4096, 1 << 24
CHUNK_ROWS = 4096
BLANKS = " \t\n\x0b\x0c\r"

#: States: nothing yet, after the system row, after a user row, after an assistant row. The first and last may end.
STATES = range(4)
FAR = 1 << 60
#: The state that an inserted or reroled row leads to, and its role.
FORCED, ROLES = (2, 2, 3, 2), {2: "user", 3: "assistant"}
#: By initial, the state that a kept row leads to from each state.
KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
GONE = "gone"
#: A symbol is None for a row that must go, else its role's initial (or a blank) and whether it's truncated.
Symbol = tuple[str, bool] | None
Costs = tuple[int, ...]


def symbol(role: str, text: str, seen: bool) -> tuple[str | None, Symbol]:
    """A row's first fault (or None) and its symbol."""
    body = text.rstrip(BLANKS)
    if not body:
        return "blank", None
    if seen:
        return "duplicate", None
    cut = body[-1] not in ".!?"
    initial = role[:1] if role[:1] in KEPT else " "
    return ("truncated" if cut else None), (initial, cut)


@lru_cache(maxsize=None)
def edges(row: Symbol) -> tuple[tuple[str, int, int, int], ...]:
    """(letter, from, to, cost) of the edits that use up a row, in the order of their letters."""
    out = [("D", p, p, DELETE) for p in STATES]
    if row is not None:
        initial, cut = row
        kept = KEPT.get(initial, (None,) * 4)
        out += [("K", p, kept[p], TRUNCATED * cut) for p in STATES if kept[p] is not None]
        out += [("R", p, FORCED[p], REROLE + TRUNCATED * cut) for p in STATES]
    return tuple(out)


def with_inserts(costs: Costs) -> Costs:
    """Costs from each state if rows may be inserted first. Three inserts lead nowhere that one doesn't."""
    once = [min(costs[p], INSERT + costs[FORCED[p]]) for p in STATES]
    return tuple(min(once[p], INSERT + once[FORCED[p]]) for p in STATES)


def product(a: tuple[Costs, ...], b: tuple[Costs, ...]) -> tuple[Costs, ...]:
    """Min-plus product of two transitions."""
    return tuple(tuple(min(FAR, *(a[p][k] + b[k][q] for k in STATES)) for q in STATES) for p in STATES)


NOTHING = tuple(tuple(0 if p == q else FAR for q in STATES) for p in STATES)
#: Least cost to an allowed end once no row is left.
AT_END: Costs = with_inserts((0, FAR, FAR, 0))


@lru_cache(maxsize=None)
def power(row: Symbol, exponent: int) -> tuple[Costs, ...]:
    """The transition of 2 ** ``exponent`` equal rows, each with the inserts before it."""
    if exponent:
        half = power(row, exponent - 1)
        return product(half, half)
    step = [[FAR] * 4 for _ in STATES]
    for _, p, q, cost in edges(row):
        step[p][q] = min(step[p][q], cost)
    columns = [with_inserts(tuple(step[p][q] for p in STATES)) for q in STATES]
    return tuple(tuple(min(FAR, columns[q][p]) for q in STATES) for p in STATES)


def runs_of(symbols: list[Symbol]) -> list[tuple[Symbol, int]]:
    return [(row, len(list(same))) for row, same in groupby(symbols)]


def transition(symbols: list[Symbol]) -> tuple[Costs, ...]:
    """The transition of a row of symbols: a run of equal ones is a product of binary powers."""
    out = NOTHING
    for row, length in runs_of(symbols):
        for exponent in range(length.bit_length()):
            if length >> exponent & 1:
                out = product(out, power(row, exponent))
    return out


def applied(step: tuple[Costs, ...], after: Costs) -> Costs:
    return tuple(min(FAR, *(step[p][q] + after[q] for q in STATES)) for p in STATES)


@lru_cache(maxsize=1 << 16)
def _before_run(row: Symbol, length: int, after: Costs) -> Costs:
    for exponent in range(length.bit_length()):
        if length >> exponent & 1:
            after = applied(power(row, exponent), after)
    return after


def before_run(row: Symbol, length: int, after: Costs) -> Costs:
    """Least costs before a run from those after it; only their differences matter, so few cases come up."""
    low = min(after)
    found = _before_run(row, length, tuple(min(FAR, c - low) for c in after))
    return tuple(min(FAR, c + low) for c in found)


@lru_cache(maxsize=1 << 16)
def choices(row: Symbol, after: Costs) -> tuple[tuple[str, int], ...]:
    """From each state, the letters of the cheapest edits up to this row's own, least in ASCII, and the state
    they lead to."""
    plain = [FAR] * 4
    for _, p, q, cost in edges(row):
        plain[p] = min(plain[p], cost + after[q])
    before = with_inserts(tuple(plain))
    out = []
    for p in STATES:
        letters = ""
        while True:
            now = {letter: q for letter, s, q, cost in edges(row) if s == p and cost + after[q] == before[p]}
            if before[p] == INSERT + before[FORCED[p]]:
                now["I"] = FORCED[p]
            letter = min(now)
            letters, p = letters + letter, now[letter]
            if letter != "I":
                break
        out.append((letters, p))
    return tuple(out)


def unrolled(symbols: list[Symbol], after: Costs, state: int) -> tuple[list[str], int]:
    """Letters chosen for each row from ``state`` on, given the least costs after the last row, and the last state.

    Costs are advanced run by run from the end; within a run they're stepped row by row only as the choices are
    unrolled.
    """
    runs, marks = runs_of(symbols), [after]
    for row, length in reversed(runs):
        marks.append(before_run(row, length, marks[-1]))
    out: list[str] = []
    for (row, length), end in zip(runs, reversed(marks[:-1])):
        low = min(end)
        costs, picks = tuple(min(FAR, c - low) for c in end), []
        for _ in range(length):
            picks.append(choices(row, costs))
            costs = before_run(row, 1, costs)
            low = min(costs)
            costs = tuple(min(FAR, c - low) for c in costs)
        for pick in reversed(picks):
            letters, state = pick[state]
            out.append(letters)
    return out, state


def repaired(rows: list[tuple[str, str]], audit: list[str], state: int) -> list[str]:
    """The lines ``role:text`` that the edits leave."""
    lines = []
    for (role, text), letters in zip(rows, audit):
        for letter in letters:
            if letter == "K":
                state = KEPT[role[:1]][state]
                lines.append(f"{role}:{text}")
            elif letter != "D":
                state = FORCED[state]
                lines.append(f"{ROLES[state]}:{text if letter == 'R' else ''}")
    return lines


def ending(state: int) -> list[str]:
    """Lines of the rows inserted at the end."""
    lines = []
    while state not in (0, 3):
        state = FORCED[state]
        lines.append(f"{ROLES[state]}:")
    return lines


def counted(rows: list[dict], faults: list[str | None]) -> dict:
    """Counts over neighbouring rows of a conversation, in a form that chunks can add up."""
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    pairs = [a["role"][:1] + b["role"][:1] for a, b in zip(rows, rows[1:])]
    return {
        "first_turn": min(turns, default=None),
        "last_turn": max(turns, default=None),
        "distinct_turns": len(set(turns)),
        "first_role": rows[0]["role"][:1] if rows else None,
        "last_role": rows[-1]["role"][:1] if rows else None,
        **{fault: faults.count(fault) for fault in ("blank", "duplicate", "truncated")},
        "illegal": sum(pair not in ("su", "ua", "au") for pair in pairs),
    }


def together(counts: list[dict]) -> dict:
    """Counts of a conversation from those of its chunks in order; a turn or a pair may go over an edge."""
    out = {k: sum(c[k] for c in counts) for k in ("blank", "duplicate", "truncated", "illegal", "distinct_turns")}
    held = [c for c in counts if c["first_role"] is not None]
    for a, b in zip(held, held[1:]):
        out["illegal"] += a["last_role"] + b["first_role"] not in ("su", "ua", "au")
    held = [c for c in held if c["first_turn"] is not None]
    for a, b in zip(held, held[1:]):
        out["distinct_turns"] -= a["last_turn"] == b["first_turn"]
    distinct = out.pop("distinct_turns")
    return out | {"gaps": held[-1]["last_turn"] - held[0]["first_turn"] + 1 - distinct if held else 0}


SUMS = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
OUT = f"{SUMS}, audit string, repaired_sha256 string"
ROW = "part int, place bigint, turn bigint, role string, text string, gone boolean"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def repair_one(rows: list[dict], with_text: bool) -> dict:
    """A whole conversation's result."""
    rows = [r for r in rows if not r["gone"]]
    seen, faults, symbols = set(), [], []
    for r in rows:
        key = (r["role"], r["text"])
        fault, row = symbol(*key, key in seen)
        seen.add(key)
        faults.append(fault)
        symbols.append(row)
    audit, state = unrolled(symbols, AT_END, 0)
    tail = ending(state)
    lines = repaired([(r["role"], r["text"]) for r in rows], audit, 0) + tail
    cost = applied(transition(symbols), AT_END)[0]
    text = "\n".join(lines)
    out = together([counted(rows, faults)]) | {"cost": cost, "audit": "".join(audit) + "I" * len(tail)}
    return out | {"repaired_sha256": sha(text)} | ({"repaired": text} if with_text else {})


def repair_conversations(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    gone_col: str | None = None,
    copy_col: str | None = None,
    with_text: bool = False,
    whole_rows: int = WHOLE_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Faults of each conversation and its cheapest repair to role initials ``(s?(ua)+)?``.

    Rows are taken by turn, NULL turns first, equal turns by role, a hash of the text and ``copy_col``. Each
    row's first fault counts: blank, duplicate (role and text seen earlier), truncated (its last letter that
    isn't a blank is none of ``.!?``). Edits: keep 0, rerole to user or assistant 3, delete 4 (a must for blank
    and duplicate rows), insert an empty row 3; a truncated row that stays costs 3 more. Equal consecutive
    symbols are a run whose min-plus transition over four states is made of cached binary powers; choices are
    unrolled from the least costs after each run, the ASCII-least letter first.

    Returns a row per conversation: ``conv_col``, gaps, blank, duplicate, truncated, illegal, cost, audit (letters
    D, I, K, R in order), repaired_sha256, and with ``with_text`` repaired. NULL role and text count as one blank,
    an empty role has no allowed initial, NULL conversations are one conversation, repeated rows are duplicates,
    other columns are not read, no rows give none. Rows marked in ``gone_col`` are no part of their conversation,
    but it's returned even if none is left.

    Rows are sorted across the cluster by conversation and turn, so a conversation with a large share of the
    rows lies in many partitions. A conversation inside a partition is finished there; those at its edges and
    those above ``whole_rows`` rows are cut into chunks, whose transitions (16 numbers each) are chained. Only
    the digest, a chain by nature, streams the repaired text of a conversation through one task in bounded
    memory; ``with_text`` and the audit are a single value per conversation, whatever its length.
    """
    ship(rows.sparkSession)
    kind = rows.schema[conv_col].dataType
    key = F.coalesce(F.concat(F.lit("v"), F.col(conv_col).cast("string")), F.lit("n"))
    given = rows.select(
        key.alias("k"),
        F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.lit(False) if gone_col is None else F.coalesce(F.col(gone_col), F.lit(False))).alias("gone"),
        (F.lit(0) if copy_col is None else F.col(copy_col).cast("int")).alias("copy"),
    )
    order = ["k", "turn", "role", "digest", "copy", "number"]
    ordered = given.withColumn("digest", F.xxhash64("text")).withColumn("number", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    text = ", repaired string" if with_text else ""
    ddl = f"k string, done boolean, {OUT}{text}, {ROW}"
    fields = _arrow(rows, ddl)

    def walk(batches):
        part, place, first = TaskContext.get().partitionId(), 0, True
        now, held, chars, whole = None, [], 0, True

        def row(r):
            return {**r, "done": False, "part": part}

        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for k, turn, role, text_, gone in zip(*columns):
                if k != now:
                    if now is not None:
                        if first or not whole:
                            out.extend(map(row, held))
                        else:
                            out.append({"k": now, "done": True, **repair_one(held, with_text)})
                        first = False
                    now, held, chars, whole = k, [], 0, True
                held.append({"k": k, "place": place, "turn": turn, "role": role, "text": text_, "gone": gone})
                place, chars = place + 1, chars + len(text_)
                if len(held) > whole_rows or chars > WHOLE_CHARS:
                    out.extend(map(row, held))
                    held, chars, whole = [], 0, False
            yield pa.RecordBatch.from_pylist(out, fields)
        yield pa.RecordBatch.from_pylist(list(map(row, held)), fields)

    walked = stage(ordered.select("k", "turn", "role", "text", "gone").mapInArrow(walk, ddl), "conversations")
    names = [*[c.split(" ")[0] for c in (OUT + text).split(", ")]]
    done = walked.where("done").select("k", *names)
    cut = _chunked(walked.where("not done").select("k", *[c.split(" ")[0] for c in ROW.split(", ")]), chunk_rows, with_text)
    both = done.unionByName(cut.select("k", *names))
    conv = F.when(F.col("k").startswith("v"), F.substr("k", F.lit(2))).cast(kind).alias(conv_col)
    return both.select(conv, *names)


def _arrow(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], ddl).schema)


CHUNK = ["k", "part", "chunk"]
CHUNK_DDL = "k string, part int, chunk bigint"
COUNTS = (
    "first_turn bigint, last_turn bigint, distinct_turns bigint, first_role string, last_role string, blank bigint, "
    "duplicate bigint, truncated bigint, illegal bigint"
)


def _chunked(rows: DataFrame, chunk_rows: int, with_text: bool) -> DataFrame:
    """Results of conversations that are cut into chunks.

    Duplicates are found by an aggregate over digests. Each chunk gives its transition and counts; per
    conversation these chain to the least costs after each chunk; each chunk then tells where it leads from every
    state, which chains to the state it starts from; and at last it unrolls its letters and lines.
    """
    fields = {name: _arrow(rows, ddl) for name, ddl in _DDLS.items()}
    told = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    rows = rows.withColumn("chunk", F.floor(F.col("place") / chunk_rows)).withColumn("told", told)
    at = F.struct("part", "place")
    firsts = rows.where("not gone").groupBy("k", "told").agg(F.min(at).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select("k", "told", "first")
    marked = rows.join(firsts, ["k", "told"], "left").select(
        *CHUNK, "place", "turn", "role", "text", "gone", F.coalesce(F.col("first") < at, F.lit(False)).alias("seen")
    )
    marked = stage(marked, "chunks")

    def taken(table: pa.Table):
        rows = [r for r in table.sort_by("place").to_pylist() if not r["gone"]]
        told = [symbol(r["role"], r["text"], r["seen"]) for r in rows]
        return rows, [f for f, _ in told], [s for _, s in told]

    def named(table: pa.Table) -> dict:
        return {c: table[c][0].as_py() for c in CHUNK}

    def summary(table: pa.Table) -> pa.Table:
        rows, faults, symbols = taken(table)
        step = [c for line in transition(symbols) for c in line]
        return pa.Table.from_pylist([{**named(table), "step": step, **counted(rows, faults)}], fields["summary"])

    def costs(table: pa.Table) -> pa.Table:
        chunks = table.sort_by([("part", "ascending"), ("chunk", "ascending")]).to_pylist()
        total, after, out = together(chunks), AT_END, []
        for c in reversed(chunks):
            out.append({**{n: c[n] for n in CHUNK}, "after": list(after), **total})
            after = applied(tuple(tuple(c["step"][4 * p : 4 * p + 4]) for p in STATES), after)
        return pa.Table.from_pylist([{**r, "cost": after[0]} for r in out], fields["costs"])

    def lead(table: pa.Table) -> pa.Table:
        _, _, symbols = taken(table)
        after = tuple(table["after"][0].as_py())
        ends = [unrolled(symbols, after, p)[1] for p in STATES]
        return pa.Table.from_pylist([{**named(table), "ends": ends}], fields["lead"])

    def states(table: pa.Table) -> pa.Table:
        chunks = table.sort_by([("part", "ascending"), ("chunk", "ascending")]).to_pylist()
        state = 0
        for c in chunks:
            c["state"], state = state, c.pop("ends")[state]
            c["ends_at"] = None
        chunks[-1]["ends_at"] = state
        return pa.Table.from_pylist(chunks, fields["states"])

    def unroll(table: pa.Table) -> pa.Table:
        rows, _, symbols = taken(table)
        after, state, last = (table[c][0].as_py() for c in ("after", "state", "ends_at"))
        audit, _ = unrolled(symbols, tuple(after), state)
        lines = repaired([(r["role"], r["text"]) for r in rows], audit, state)
        tail = [] if last is None else ending(last)
        letters = "".join(audit) + "I" * len(tail)
        return pa.Table.from_pylist([{**named(table), "letters": letters, "lines": "\n".join(lines + tail)}], fields["unroll"])

    def finish(batches):
        now, digest, letters, texts, started = None, hashlib.sha256(), [], [], False

        def row():
            found = {"k": now, "audit": "".join(letters), "repaired_sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pylist([found | {"repaired": "\n".join(texts) if with_text else None}], fields["finish"])

        for batch in batches:
            for r in batch.to_pylist():
                if r["k"] != now:
                    if now is not None:
                        yield row()
                    now, digest, letters, texts, started = r["k"], hashlib.sha256(), [], [], False
                letters.append(r["letters"])
                if r["lines"]:
                    digest.update(("\n" * started + r["lines"]).encode())
                    started = True
                    if with_text:
                        texts.append(r["lines"])
        if now is not None:
            yield row()

    summaries = stage(marked.groupBy(*CHUNK).applyInArrow(summary, _DDLS["summary"]), "summaries")
    after = stage(summaries.groupBy("k").applyInArrow(costs, _DDLS["costs"]), "costs")
    leads = marked.join(after.select(*CHUNK, "after"), CHUNK).groupBy(*CHUNK).applyInArrow(lead, _DDLS["lead"])
    starts = leads.groupBy("k").applyInArrow(states, _DDLS["states"])
    known = stage(starts.join(after.select(*CHUNK, "after"), CHUNK), "starts")
    letters = marked.join(known, CHUNK).groupBy(*CHUNK).applyInArrow(unroll, _DDLS["unroll"])
    streamed = letters.repartition("k").sortWithinPartitions(*CHUNK).mapInArrow(finish, _DDLS["finish"])
    sums = [c.split(" ")[0] for c in SUMS.split(", ")]
    return streamed.join(after.groupBy("k").agg(*[F.first(c).alias(c) for c in sums]), "k")


_DDLS = {
    "summary": f"{CHUNK_DDL}, step array<bigint>, {COUNTS}",
    "costs": f"{CHUNK_DDL}, after array<bigint>, {SUMS}",
    "lead": f"{CHUNK_DDL}, ends array<int>",
    "states": f"{CHUNK_DDL}, state int, ends_at int",
    "unroll": f"{CHUNK_DDL}, letters string, lines string",
    "finish": "k string, audit string, repaired_sha256 string, repaired string",
}
