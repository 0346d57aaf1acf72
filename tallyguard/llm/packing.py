"""Packing of token sequences: global best-fit decreasing on counts of lengths."""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import numbered, ship
from tallyguard.llm.tokens import encoder

WINDOW = 4096
END_ID = 2


class Capacities:
    """Segment tree over remaining capacities: finds the smallest capacity of at least ``need`` with an open window."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.some = [False] * (2 * self.size)
        self.runs: dict[int, deque] = {}

    def put(self, capacity: int, run: tuple[int, int], front: bool = False) -> None:
        queue = self.runs.setdefault(capacity, deque())
        queue.appendleft(run) if front else queue.append(run)
        self._mark(capacity, True)

    def take(self, capacity: int) -> tuple[int, int]:
        run = self.runs[capacity].popleft()
        if not self.runs[capacity]:
            self._mark(capacity, False)
        return run

    def _mark(self, capacity: int, value: bool) -> None:
        at = capacity + self.size
        self.some[at] = value
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        at = need + self.size
        if self.some[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.some[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at + (not self.some[2 * at])
                return at - self.size
            at //= 2
        return None


def best_fit(counts: dict[int, int], window: int = WINDOW) -> pd.DataFrame:
    """Where pieces go, longest first, each into the tightest open window, else into a new one.

    Pieces of one length are alike, so runs of them and runs of windows of one remaining capacity are placed
    at once: a window of capacity r takes r // length pieces before the next window is the tightest. A run of
    windows more than halves its capacity whenever it is filled, so there are at most about 3 * window *
    log2(window) steps, however many pieces there are. Rows: (first, sequence, each, offset, length): the
    pieces numbered from ``first`` go ``each`` to a window, into windows from ``sequence`` on, from ``offset``.
    """
    open_, rules, first, windows = Capacities(window), [], 0, 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            capacity = open_.tightest(length)
            if capacity is None:
                capacity = window
                each = capacity // length
                start, size = windows, -(-left // each)
                windows += size
            else:
                each = capacity // length
                start, size = open_.take(capacity)
            rules.append((first, start, each, window - capacity, length))
            placed = min(left, size * each)
            full, part = divmod(placed, each)
            if full and capacity - each * length:
                open_.put(capacity - each * length, (start, full))
            if part:
                open_.put(capacity - part * length, (start + full, 1))
            if (rest := size - full - bool(part)) > 0:
                open_.put(capacity, (start + size - rest, rest), front=True)
            first += placed
            left -= placed
    return pd.DataFrame(rules, columns=["first", "sequence", "each", "offset", "length"], dtype="int64")


def cut_documents(
    docs: DataFrame, path: str, window: int, end_id: int, id_col: str, text_col: str, with_ids: bool
) -> DataFrame:
    """Pieces of at most ``window`` ids: full windows first, then what is left of the document."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        encode = encoder(path)
        for batch in batches:
            at, rows, ids = [], [], []
            for i, text in enumerate(batch.column(1)):
                data = encode(text.as_py()) + end
                for start in range(0, len(data), 4 * window):
                    piece = data[start : start + 4 * window]
                    at.append(i)
                    rows.append((start // 4, len(piece) // 4, zlib.crc32(piece), len(data) // 4))
                    if with_ids:
                        ids.append(np.frombuffer(piece, "<u4").astype("int32"))
            table = np.array(rows, "int64").reshape(-1, 4)
            columns = [batch.column(0).take(pa.array(at, "int32")), *[pa.array(table[:, k]) for k in range(4)]]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    fields = f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return source.mapInArrow(cut, fields + (", ids array<int>" if with_ids else ""))


def pack(
    docs: DataFrame,
    path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """All documents in sequences of at most ``window`` ids, best-fit decreasing over the whole table.

    Returns one row per piece: ``id_col``, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the
    ids where ``with_ids``. NULL and empty texts are the end id alone; overlong documents are cut into full
    windows first. Pieces are numbered from the longest down (ties by id, start and checksum); only the
    counts of lengths, at most ``window`` numbers, reach the driver, and the rules that it returns are bounded
    by ``window`` too. Repeated rows are packed each; an empty table gives no rows; other columns are not read.
    """
    pieces = cut_documents(docs, path, window, end_id, id_col, text_col, with_ids)
    rows = numbered(pieces, [F.desc("length"), F.col("id"), F.col("start"), F.col("ids_crc32")])
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    rules = best_fit(counts, window)
    first, sequence, each, offset = (rules[c].to_numpy() for c in ("first", "sequence", "each", "offset"))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(number: pd.Series, length: pd.Series) -> pd.DataFrame:
        number = number.to_numpy()
        rule = np.searchsorted(first, number, side="right") - 1
        turn, within = np.divmod(number - first[rule], each[rule])
        return pd.DataFrame({"sequence_id": sequence[rule] + turn, "offset": offset[rule] + within * length.to_numpy()})

    placed = rows.withColumn("placed", place("row_no", "length"))
    kept = ["start", "length", "ids_crc32", "doc_tokens"]
    columns = [F.col("id").alias(id_col), *kept, "placed.sequence_id", "placed.offset"]
    return placed.select(*columns, *(["ids"] if with_ids else []))
