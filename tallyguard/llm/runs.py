"""Periodic runs of words: squares found online by a suffix automaton whose link tree remembers last occurrences."""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import ship

#: A run repeats its period so many times at least, and has so many words at least.
LEAST_TIMES = 4
LEAST_WORDS = 6
#: Words numbered by a worker before it starts anew, and from which size on arrays of integers replace lists.
MEMORY_WORDS = 500_000
MANY = 1 << 16

RESULT = (
    "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
    "collapsed_sha256 string"
)


class Automaton:
    """Suffix automaton with its link tree kept as a link-cut tree.

    A preferred path holds the states that the same prefix visited last, so one colour, the end of that prefix,
    stands for the last occurrence of all its strings. It's kept at the root of the path's splay tree.
    """

    def __init__(self, words: int):
        many = words > MANY

        def numbers(first: int):
            return array("q", [first]) if many else [first]

        self.next: list[dict[int, int]] = [{}]
        self.length, self.link = numbers(0), numbers(-1)
        self.left, self.right, self.up, self.end = numbers(-1), numbers(-1), numbers(-1), numbers(-1)
        self.last = 0

    def state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.left.append(-1)
        self.right.append(-1)
        self.up.append(-1)
        self.end.append(-1)
        return len(self.next) - 1

    def splay(self, x: int) -> None:
        """Make ``x`` the root of its splay tree, which holds a path by depth; ``up`` of a root is the state
        above the path."""
        left, right, up = self.left, self.right, self.up
        p, colour = up[x], self.end[x]
        while p >= 0 and (left[p] == x or right[p] == x):
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                colour = self.end[g]
                self.rotate(p if (left[g] == p) == (left[p] == x) else x)
            else:
                colour = self.end[p]
            self.rotate(x)
            p = up[x]
        self.end[x] = colour

    def rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        p = up[x]
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child >= 0:
            up[child] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def append(self, word: int, at: int) -> list[int]:
        """Append a word as number ``at`` and recolour the path of the new prefix.

        Returns the distances to earlier ends of those segments whose strings are at least as long as the
        distance: a square of that period ends here.
        """
        moves, length, link = self.next, self.length, self.link
        up, left, right, end = self.up, self.left, self.right, self.end
        new = self.state(length[self.last] + 1, 0, {})
        p = self.last
        while p >= 0 and word not in moves[p]:
            moves[p][word] = new
            p = link[p]
        if p >= 0:
            q = moves[p][word]
            if length[p] + 1 != length[q]:
                q = self.split(p, q, word)
            link[new] = q
        self.last = new
        up[new] = link[new]
        squares = []
        below, x = new, link[new]
        while x >= 0:
            self.splay(x)
            before = end[x]
            if before >= 0 and at - before <= length[x]:
                squares.append(at - before)
            deeper = right[x]
            if deeper >= 0:
                end[deeper] = before
            right[x] = below
            below, x = x, up[x]
        end[below] = at
        return squares

    def split(self, p: int, q: int, word: int) -> int:
        """A new state for the shorter strings of ``q``, above ``q`` on its path, last seen where ``q`` was."""
        moves, length, link = self.next, self.length, self.link
        clone = self.state(length[p] + 1, link[q], dict(moves[q]))
        while p >= 0 and moves[p].get(word) == q:
            moves[p][word] = clone
            p = link[p]
        self.splay(q)
        above = self.left[clone] = self.left[q]
        if above >= 0:
            self.up[above] = clone
        self.left[q] = clone
        self.up[clone] = q
        link[q] = clone
        return clone


def regions(words: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of words that hold every run, apart from each other: all else can't be part of one.

    In a run of period q every word after the first q occurred at most q words before, and there are at least
    max(6, 4q) - q of them. For each power of two that bounds q, a long enough stretch of such words, and as
    many words before it as the power, may hold a run.
    """
    n = len(words)
    if n < LEAST_WORDS:
        return []
    order = np.argsort(words, kind="stable")
    same = words[order[1:]] == words[order[:-1]]
    back = np.full(n, n, "int64")
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    found, bound = [], 1
    while LEAST_TIMES * (bound // 2 + 1) <= n:
        least = LEAST_WORDS - 1 if bound == 1 else max(LEAST_WORDS, LEAST_TIMES * (bound // 2 + 1)) - bound // 2 - 1
        far = np.flatnonzero(back > bound)
        starts = np.concatenate([[0], far + 1])
        ends = np.concatenate([far, [n]])
        long_ = ends - starts >= least
        found.extend(zip((starts[long_] - bound).tolist(), ends[long_].tolist()))
        bound *= 2
    out: list[tuple[int, int]] = []
    for start, end in sorted(found):
        start = max(start, 0)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def stretch(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """First word and end of the longest stretch around ``at`` in which words ``period`` apart are identical."""
    end, step = at + 1, 64
    while end < len(words):
        piece = words[end : end + step]
        other = np.flatnonzero(piece != words[end - period : end - period + len(piece)])
        if len(other):
            end += int(other[0])
            break
        end, step = end + len(piece), 2 * step
    start, step = at - period + 1, 64
    while start > 0:
        first = max(0, start - step)
        other = np.flatnonzero(words[first:start] != words[first + period : start + period])
        if len(other):
            start = first + int(other[-1]) + 1
            break
        start, step = first, 2 * step
    return start, end


def is_smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no divisor of ``period`` is a period of the stretch from ``start``; with twice the period or more,
    any smaller period would be such a divisor or a multiple of one."""
    block, rest, prime = words[start : start + period], period, 2
    while rest > 1:
        if prime * prime > rest:
            prime = rest
        if rest % prime == 0:
            part = period // prime
            if np.array_equal(block[part:], block[:-part]):
                return False
            while rest % prime == 0:
                rest //= prime
        prime += 1
    return True


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) by start, then period."""
    runs = set()
    for first, end in regions(words):
        automaton, reach = Automaton(end - first), {}
        for at, word in enumerate(words[first:end].tolist(), first):
            for period in automaton.append(word, at):
                if reach.get(period, -1) > at:
                    continue
                start, stop = stretch(words, at, period)
                reach[period] = stop
                length = stop - start
                if length >= max(LEAST_WORDS, LEAST_TIMES * period) and is_smallest(words, start, period):
                    runs.add((start, length, period))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def kept_words(words: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """True for each word that no run holds after its own first period."""
    steps = np.zeros(words + 1, "int64")
    for start, length, period in runs:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:-1]) == 0


class Numbers(dict):
    """Numbers of words, given as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def described(words: list[bytes], numbers: Numbers, with_text: bool = False) -> dict:
    ids = np.array(list(map(numbers.__getitem__, words)), "int32")
    runs = find_runs(ids)
    start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    if runs:
        words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
    collapsed = b" ".join(words)
    out = {
        "n_runs": len(runs),
        "start": start,
        "length": length,
        "period": period,
        "exponent_milli": 1000 * length // period if runs else None,
        "runs_sha256": hashlib.sha256(listed.encode()).hexdigest(),
        "collapsed_sha256": hashlib.sha256(collapsed).hexdigest(),
    }
    if with_text:
        out |= {"runs": [{"start": s, "length": n, "period": q} for s, n, q in runs], "collapsed": collapsed.decode()}
    return out


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """Periodic runs of the words of each text, and the text with every run collapsed to its first period.

    Words are what blanks, tabs and line ends separate. A run is a longest stretch with smallest period q (words
    q apart are identical) of at least max(6, 4q) words. Every word is appended to a suffix automaton; the new
    prefix's path in the link tree is accessed, and each piece of it that an earlier prefix coloured gives the
    distance to that prefix's end. Where strings are as long as the distance there is a square; it's extended
    to both sides and kept if long enough and its period smallest. Words that can't be part of any run by the
    distances to their last occurrences don't enter the automaton.

    Returns per row ``id_col``, n_runs, the longest run (ties: smallest start, then period; NULLs without a run),
    exponent_milli, digests of all runs and of the collapsed text (words joined by a space); ``with_text`` adds
    runs and collapsed themselves. NULL and empty texts have no word, repeated rows come out each, NULL ids stay,
    other columns are not read, an empty table gives no rows. Rows go through one pass, without a shuffle;
    memory is in proportion to the longest stretch of a text that may hold a run.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    more = ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string" if with_text else ""
    ddl = f"id {kind}, {RESULT}{more}"
    fields = _arrow(docs, ddl)

    def found(batches):
        numbers = Numbers()
        for batch in batches:
            out = []
            for text in batch.column(1):
                out.append(described(text.as_py().encode().split(), numbers, with_text))
                if len(numbers) > MEMORY_WORDS:
                    numbers = Numbers()
            columns = [batch.column(0) if f.name == "id" else pa.array([r[f.name] for r in out], f.type) for f in fields]
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    return rows.mapInArrow(found, ddl).withColumnRenamed("id", id_col)


def _arrow(docs: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(docs.sparkSession.createDataFrame([], ddl).schema)
