"""LM scoring: a hierarchical Pitman-Yor model of words given the word before, seated by Gibbs sampling over the whole corpus."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import PART_BIT, remainder, ship, stage, summed

#: Contexts laid out by hand, as tests do; those of score_documents are words and grow with the corpus.
CONTEXTS = 1281
#: Tokens of a chunk of documents, words of a bucket of the model, chunks and pairs answered together: they bound memory.
CHUNK_TOKENS = 1_500_000
BUCKET_WORDS = 400_000
TURN_CHUNKS = 1024
TURN_PAIRS = 1 << 24
#: Words that chunks and requests write as short numbers, taken from about so many documents; all others are written out.
BOOK_WORDS = 1 << 18
BOOK_DOCUMENTS = 1 << 14
#: Totals of contexts meet in a home per bucket up to so many homes, then in one per HOME_BUCKETS buckets.
HOMES = 64
HOME_BUCKETS = 16
#: Sweeps over all seats, the last SAMPLES of which are averaged; every KEPT_EVERY-th is written to shared storage.
SWEEPS = 8
SAMPLES = 3
KEPT_EVERY = 3
#: Up to so many customers, chances of table numbers come from the recurrence; beyond, from a contour integral.
TRIANGLE = 512
STRENGTH = 1.0
SEED = 6

CHUNK_FIELDS = (
    "chunk bigint, doc_no array<bigint>, ids array<{kind}>, train array<boolean>, lengths array<bigint>, "
    "first array<int>, n_words bigint, tokens binary, words binary"
)
REQUEST_FIELDS = (
    "bucket bigint, turn bigint, chunk bigint, asked bigint, words binary, each binary, contexts binary, counts binary"
)
MODEL_FIELDS = "bucket bigint, turn bigint, asked bigint, words binary, each binary, contexts binary, counts binary"
ACTIVE_FIELDS = "bucket bigint, each binary, single binary, places binary, counts binary, ids binary"
MESSAGE_FIELDS = "bucket bigint, home bigint, ids binary, amounts binary, wanted binary"
SEATS_FIELDS = (
    "bucket bigint, home bigint, ids binary, amounts binary, wanted binary, fixed binary, seated binary, "
    "parents binary, all_customers bigint, all_parents bigint"
)
ANSWER_FIELDS = (
    "chunk bigint, bucket bigint, frequency binary, customers binary, parents binary, totals binary, counts binary, "
    "tables binary"
)


def schema_of(fields: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in map(str.split, fields.split(", "))])


def squeezed(values: np.ndarray, kind: str) -> bytes:
    """An array as compressed bytes: the first byte of every number, then the second ones, and so on."""
    import zstandard

    if kind == "<u4" and len(values) and values.max() > 0xFFFFFFFF:
        raise OverflowError("a count beyond 2**32")
    flat = np.ascontiguousarray(values.astype(kind))
    planes = flat.view("u1").reshape(-1, flat.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expanded(data: bytes, kind: str) -> np.ndarray:
    import zstandard

    if not data:
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def begins(each: np.ndarray | int | None, size: int) -> np.ndarray:
    """Where runs of so many values begin; 0 stands for one run, None for a run a value."""
    if each is None:
        return np.arange(size)
    if isinstance(each, int):
        return np.zeros(min(size, 1), "int64")
    return (np.cumsum(each) - each)[each > 0]


def steps(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Unsigned values as steps from the one before in their run, small where runs are in order."""
    before = np.roll(values, 1)
    before[starts] = 0
    return values - before


def walked(steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The values that gave the steps."""
    total = np.cumsum(steps, dtype=steps.dtype)
    return total - np.repeat((total - steps)[starts], np.diff(starts, append=len(steps)))


class Book:
    """Short numbers for frequent words, so that requests stay small; words outside are written as whole hashes.

    Numbers are written as steps within runs whose lengths the reader knows, hashes as steps within the same runs.
    Any order comes back; runs in the book's order are the shortest.
    """

    def __init__(self, words: np.ndarray):
        """Hashes of words, the most frequent first."""
        self.words = words
        self.order = np.argsort(words)
        self.sorted = words[self.order]

    def codes(self, words: np.ndarray) -> np.ndarray:
        """The number from 1 of each word, 0 of those outside."""
        at, has = find(self.sorted, words)
        out = np.zeros(len(words), "int64")
        out[has] = self.order[at[has]] + 1
        return out

    def in_order(self, words: np.ndarray, codes: np.ndarray | None = None) -> np.ndarray:
        """The book's order of words: those outside by hash, then the others by number."""
        return np.lexsort((words, self.codes(words) if codes is None else codes))

    @staticmethod
    def plain_begins(each: np.ndarray | int | None, outside: np.ndarray) -> np.ndarray:
        """Where runs begin among the words outside; without runs they are one."""
        size = np.count_nonzero(outside)
        if each is None or isinstance(each, int):
            return begins(0, size)
        run = np.repeat(np.arange(len(each)), each)
        return np.flatnonzero(np.diff(run[outside], prepend=-1))

    def pack(self, words: np.ndarray, codes: np.ndarray | None = None, each: np.ndarray | int | None = None) -> bytes:
        codes = self.codes(words) if codes is None else codes
        data = squeezed(steps(codes.astype("<u4"), begins(each, len(codes))), "<u4")
        plain = steps(words[codes == 0], self.plain_begins(each, codes == 0))
        return len(data).to_bytes(8, "little") + data + squeezed(plain, "<u8")

    def split(self, data: bytes, each: np.ndarray | int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of packed words, hashes of those with number 0)."""
        if not data:
            return np.zeros(0, "int64"), np.zeros(0, "<u8")
        end = 8 + int.from_bytes(data[:8], "little")
        codes = expanded(data[8:end], "<u4")
        codes = walked(codes, begins(each, len(codes))).astype("int64")
        return codes, walked(expanded(data[end:], "<u8"), self.plain_begins(each, codes == 0))

    def unpack(self, data: bytes, each: np.ndarray | int | None = None) -> np.ndarray:
        codes, plain = self.split(data, each)
        out, known = np.empty(len(codes), "<u8"), codes > 0
        out[known] = self.words[codes[known] - 1]
        out[~known] = plain
        return out

    def places(self, packed: list[bytes], runs: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(distinct words in order of hash, the place there of each packed word)."""
        parts = [self.split(*x) for x in (zip(packed, runs) if runs is not None else zip(packed))]
        codes, plain = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        used = np.flatnonzero(np.bincount(codes, minlength=len(self.words) + 1)[1:])
        extra, extra_at = np.unique(plain, return_inverse=True)
        ids = np.concatenate([self.words[used], extra])
        order = np.argsort(ids)
        rank = np.empty(len(ids), "int64")
        rank[order] = np.arange(len(ids))
        table = np.zeros(len(self.words) + 1, "int64")
        table[used + 1] = rank[: len(used)]
        out = table[codes]
        out[codes == 0] = rank[len(used) :][extra_at]
        return ids[order], out


class Places:
    """Finds packed words among known ones, those of the book by their number."""

    def __init__(self, known: np.ndarray, book: Book):
        self.known, self.book = known, book
        codes = book.codes(known)
        self.table = np.full(len(book.words) + 1, -1)
        self.table[codes] = np.arange(len(known))

    def find(self, data: bytes, each: np.ndarray | int | None = None) -> tuple[np.ndarray, np.ndarray]:
        codes, plain = self.book.split(data, each)
        at = self.table[codes]
        spelled, has = find(self.known, plain)
        at[codes == 0] = np.where(has, spelled, -1)
        return np.maximum(at, 0), at >= 0


NO_BOOK = Book(np.zeros(0, "<u8"))


def as_chunks(docs: DataFrame, train: Column, id_col: str, text_col: str, book=None) -> DataFrame:
    """Documents as numbers: one row per chunk with its own dictionary of words and the tokens of its documents.

    Words of a dictionary stand in the order of the book, if there is one, so that pairs of a chunk do too.
    """
    source = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), train.alias("train")
    )
    kind = source.schema["id"].dataType.simpleString()

    def chunked(batches):
        from xxhash import xxh64_intdigest

        part, number, doc_no = TaskContext.get().partitionId(), 0, 0
        words: dict[bytes, int] = {}
        rows, tokens, size = [], [], 0

        def flush():
            hashes = np.array([xxh64_intdigest(w, SEED) for w in words], "<u8")
            known = book.value if book else NO_BOOK
            codes = known.codes(hashes)
            order = known.in_order(hashes, codes)
            place = np.empty(len(order), "int64")
            place[order] = np.arange(len(order))
            names = ["doc_no", "ids", "train", "lengths", "first"]
            row = dict(zip(names, map(list, zip(*rows))))
            row |= {"chunk": (part << PART_BIT) + number, "n_words": len(order)}
            row |= {"first": place[row["first"]], "words": known.pack(hashes[order], codes[order], 0)}
            row["tokens"] = squeezed(place[np.concatenate(tokens)], "<u4")
            return pa.RecordBatch.from_pylist([row], schema)

        schema = None
        for batch in batches:
            if schema is None:
                listed = pa.list_(batch.schema.field(0).type)
                schema = pa.schema(
                    [("chunk", pa.int64()), ("doc_no", pa.list_(pa.int64())), ("ids", listed)]
                    + [("train", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int64())), ("first", pa.list_(pa.int32()))]
                    + [("n_words", pa.int64()), ("tokens", pa.binary()), ("words", pa.binary())]
                )
            for id_, text, in_train in zip(*batch.columns):
                id_, in_train = id_.as_py(), in_train.as_py()
                found = text.as_buffer().to_pybytes().lower().split()
                found.append(b"")
                before = b""
                for at in range(0, len(found), CHUNK_TOKENS):
                    piece = found[at : at + CHUNK_TOKENS]
                    first = words.setdefault(before, len(words))
                    rows.append(((part << PART_BIT) + doc_no, id_, in_train, len(piece), first))
                    tokens.append(np.array([words.setdefault(w, len(words)) for w in piece], "<u4"))
                    before = piece[-1]
                    size += len(piece)
                    if size >= CHUNK_TOKENS:
                        yield flush()
                        number, size = number + 1, 0
                        words, rows, tokens = {}, [], []
                doc_no += 1
        if rows:
            yield flush()

    return source.mapInArrow(chunked, CHUNK_FIELDS.format(kind=kind))


def book_of(chunks: DataFrame) -> Book:
    """Frequent words of chunks without a book. Results don't depend on which words are in it, only sizes do."""

    def counted(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words = NO_BOOK.unpack(row["words"], 0)
                counts = np.bincount(expanded(row["tokens"], "<u4"), minlength=len(words))
                columns = [pa.array(words.view("<i8")), pa.array(counts.astype("int64"))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "count"])

    rows = chunks.select("words", "tokens").mapInArrow(counted, "word bigint, count bigint")
    rows = rows.groupBy("word").agg(F.sum("count").alias("count")).where("count > 1")
    words = rows.orderBy(F.desc("count"), "word").limit(BOOK_WORDS).select("word").toArrow()
    return Book(words["word"].to_numpy().view("<u8"))


class Chunk:
    """A chunk's distinct (word, context) pairs, in the order of buckets in which they are asked for.

    A context is the word before, by its place in the chunk's dictionary; the end of a document stands before the next.
    """

    def __init__(self, row: dict, buckets: int, book: Book = NO_BOOK):
        if "homes" in row:
            bucket_of = expanded(row["homes"], "<u4").astype("int64")
        else:
            self.words = book.unpack(row["words"], 0)
            bucket_of = (self.words % np.uint64(buckets)).astype("int64")
        self.tokens = expanded(row["tokens"], "<u4").astype("int32")
        self.lengths = np.array(row["lengths"], "int64")
        self.starts = np.cumsum(self.lengths) - self.lengths
        context = np.empty(len(self.tokens), "int32")
        context[1:] = self.tokens[:-1]
        context[self.starts] = row["first"]
        size = len(bucket_of)
        keys = self.tokens.astype("int64")
        keys *= size
        keys += context
        keys, self.pair_of = distinct(keys)
        self.word = (keys // size).astype("int32")
        self.context = (keys - self.word * np.int64(size)).astype("int32")
        if "train" in row:
            trained = np.repeat(np.array(row["train"], bool), self.lengths)
            self.counts = np.bincount(self.pair_of[trained], minlength=len(keys))
        if buckets <= 1 << 16:
            bucket_of = bucket_of.astype("<u2")
        self.word_order = np.argsort(bucket_of, kind="stable")
        self.pair_order = np.argsort(bucket_of[self.word], kind="stable")
        self.word_buckets, self.pair_buckets = bucket_of[self.word_order], bucket_of[self.word][self.pair_order]
        self.each = np.bincount(self.word, minlength=size)
        self.found = np.unique(self.word_buckets)
        self.asked = np.diff([np.searchsorted(self.pair_buckets, self.found, side=s) for s in ("left", "right")], axis=0)[0]

    def keep(self, pairs: np.ndarray) -> None:
        """Leave out all other pairs, and words without any left."""
        self.word, self.context, self.counts = (x[pairs] for x in (self.word, self.context, self.counts))
        left = pairs[self.pair_order]
        self.pair_order = (np.cumsum(pairs) - 1)[self.pair_order[left]]
        self.pair_buckets = self.pair_buckets[left]
        self.each = np.bincount(self.word, minlength=len(self.each))
        used = self.each[self.word_order] > 0
        self.word_order, self.word_buckets = self.word_order[used], self.word_buckets[used]

    def requests(self, chunk: int, book: Book) -> pa.RecordBatch:
        """One row per bucket: its words, the number of contexts of each, the contexts, the training counts; ``asked``
        counts all pairs of the chunk, those left out too."""
        found, codes = self.found, book.codes(self.words)
        edges = [np.searchsorted(x, found, side=s) for x in (self.word_buckets, self.pair_buckets) for s in ("left", "right")]
        rows = []
        for bucket, pairs_asked, a, b, c, d in zip(found.tolist(), self.asked.tolist(), *edges):
            own, pairs = self.word_order[a:b], self.pair_order[c:d]
            contexts, each = self.context[pairs], self.each[own]
            rows.append(
                {
                    "bucket": bucket,
                    "turn": 0,
                    "chunk": chunk,
                    "asked": pairs_asked,
                    "words": book.pack(self.words[own], codes[own], 0),
                    "each": squeezed(each, "<u4"),
                    "contexts": book.pack(self.words[contexts], codes[contexts], each),
                    "counts": squeezed(self.counts[pairs], "<u4"),
                }
            )
        return pa.RecordBatch.from_pylist(rows, schema_of(REQUEST_FIELDS))


def requests(chunks: DataFrame, buckets: int, book, learn: bool) -> DataFrame:
    """Requests for all pairs of all chunks, for training those that count."""

    def asked(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row, buckets, book.value)
                del chunk.tokens, chunk.pair_of
                if learn:
                    chunk.keep(chunk.counts > 0)
                yield chunk.requests(row["chunk"], book.value)

    out = chunks.drop("ids", "doc_no", "n_words").mapInArrow(asked, REQUEST_FIELDS)
    return out.withColumn("turn", F.pmod(F.xxhash64("chunk"), F.lit(max(1, -(-chunks.count() // TURN_CHUNKS)))))


def pairs_of(row: dict, book: Book) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, the pairs' places among them, contexts, the pairs' places among them, counts) of a model row.

    Words, contexts and pairs come in order of hash, whatever the book.
    """
    each = expanded(row["each"], "<u4").astype("int64")
    words, (ids, place) = book.unpack(row["words"], 0), book.places([row["contexts"]], [each])
    by_hash = np.argsort(words)
    rank = np.empty(len(words), "int64")
    rank[by_hash] = np.arange(len(words))
    word, counts = np.repeat(rank, each), expanded(row["counts"], "<u4").astype("int64")
    order = sorting(word * max(len(ids), 1) + place)
    return words[by_hash], word[order], ids, place[order], counts[order]


def merge(group: pa.Table, book: Book) -> pa.Table:
    """Training counts of the rows of one bucket added up; pairs and words without any left out, as are buckets."""
    rows = group.select(["words", "each", "contexts", "counts"]).to_pylist()
    runs, counts = ([expanded(r[c], "<u4").astype("int64") for r in rows] for c in ("each", "counts"))
    words, word = book.places([r["words"] for r in rows], [0] * len(rows))
    contexts, context = book.places([r["contexts"] for r in rows], runs)
    each, counts = np.concatenate(runs), np.concatenate(counts)
    word_codes, codes = book.codes(words), book.codes(contexts)
    word_order, order = book.in_order(words, word_codes), book.in_order(contexts, codes)
    word_rank, rank = np.empty(len(words), "int64"), np.empty(len(contexts), "int64")
    word_rank[word_order], rank[order] = np.arange(len(words)), np.arange(len(contexts))
    keys = np.repeat(word_rank[word], each) * max(len(contexts), 1) + rank[context]
    keep = counts > 0
    if not keep.any():
        return pa.Table.from_pylist([], schema_of(MODEL_FIELDS))
    keys, counts = keys[keep], counts[keep]
    pairs, place = distinct(keys)
    totals = np.bincount(place, weights=counts, minlength=len(pairs)).astype("int64")
    word, context = np.divmod(pairs, max(len(contexts), 1))
    each = np.bincount(word, minlength=len(words))
    left, context = each > 0, order[context]
    words, word_codes, each = words[word_order][left], word_codes[word_order][left], each[left]
    row = {
        "bucket": group["bucket"][0].as_py(),
        "turn": group["turn"][0].as_py(),
        "asked": pc.sum(group["asked"]).as_py(),
        "words": book.pack(words, word_codes, 0),
        "each": squeezed(each, "<u4"),
        "contexts": book.pack(contexts[context], codes[context], each),
        "counts": squeezed(totals, "<u4"),
    }
    return pa.Table.from_pylist([row], schema_of(MODEL_FIELDS))


def stacked(samples: np.ndarray) -> bytes:
    """One row of numbers per sample, all but the first as steps from the one before."""
    steps = np.diff(samples, axis=0, prepend=0)
    return squeezed(((steps << 1) ^ (steps >> 63)).ravel(), "<u8")


def unstacked(data: bytes) -> np.ndarray:
    steps = expanded(data, "<u8").astype("int64").reshape(SAMPLES, -1)
    return np.cumsum((steps >> 1) ^ -(steps & 1), axis=0)


def first_tables(counts: np.ndarray, discount: float) -> np.ndarray:
    """About count ** discount tables a pair, to start with."""
    return np.clip(np.rint(counts**discount), 1, np.maximum(counts, 1)).astype("int64") * (counts > 0)


class Seats:
    """Customers of many (restaurant, dish) pairs at tables; one customer of each of many pairs moves at once.

    The plain sampler, which draw_tables is tested against.
    """

    def __init__(self, counts: np.ndarray, discount: float):
        """Start with about count ** discount tables a pair, evenly filled."""
        self.counts, self.discount = counts.astype("int64"), discount
        tables = first_tables(counts, discount)
        self.owner = np.repeat(np.arange(len(counts)), tables)
        turn = np.arange(len(self.owner)) - np.repeat(np.cumsum(tables) - tables, tables)
        per, extra = counts[self.owner] // tables[self.owner], counts[self.owner] % tables[self.owner]
        self.sizes = per + (turn < extra)

    def tables(self) -> np.ndarray:
        return np.bincount(self.owner, minlength=len(self.counts))

    def _pick(self, weights: np.ndarray, pairs: np.ndarray, share: np.ndarray) -> np.ndarray:
        """A table of each pair, drawn by weight; ``share`` is uniform in [0, 1)."""
        ends = np.cumsum(weights)
        first = np.searchsorted(self.owner, pairs)
        last = np.searchsorted(self.owner, pairs, side="right") - 1
        low = ends[first] - weights[first]
        at = np.searchsorted(ends, low + share * (ends[last] - low), side="right")
        return np.clip(at, first, last)

    def remove(self, pairs: np.ndarray, rng) -> None:
        """A customer of each pair leaves, any with the same chance; empty tables go."""
        table = self._pick(self.sizes, pairs, rng.random(len(pairs)))
        self.sizes[table] -= 1
        self.counts[pairs] -= 1
        keep = self.sizes > 0
        self.owner, self.sizes = self.owner[keep], self.sizes[keep]

    def add(self, pairs: np.ndarray, new_weight: np.ndarray, rng) -> None:
        """A customer of each pair sits down: at a table by its size less the discount, or at a new one."""
        seated = self.counts[pairs] - self.discount * self.tables()[pairs]
        draw = rng.random(len(pairs)) * (seated + new_weight)
        opens = (draw < new_weight) | (self.counts[pairs] == 0)
        join = pairs[~opens]
        if len(join):
            share = (draw - new_weight)[~opens] / seated[~opens]
            self.sizes[self._pick(self.sizes - self.discount, join, share)] += 1
        self.counts[pairs] += 1
        if opens.any():
            owner = np.concatenate([self.owner, pairs[opens]])
            order = np.argsort(owner, kind="stable")
            self.sizes = np.concatenate([self.sizes, np.ones(int(opens.sum()), "int64")])[order]
            self.owner = owner[order]

    def resize(self, counts: np.ndarray, new_weight: np.ndarray, rng) -> None:
        """Customers come or go one by one until every pair has its count."""
        while len(gone := np.flatnonzero(self.counts > counts)):
            self.remove(gone, rng)
        while len(due := np.flatnonzero(self.counts < counts)):
            self.add(due, new_weight[due], rng)


_triangles: dict[float, list[np.ndarray]] = {}


def triangle(discount: float) -> list[np.ndarray]:
    """Logs of the generalised Stirling numbers S(c, 1..c) for every c up to TRIANGLE: the seatings of c customers
    at t tables, each weighted by the product of (1 - discount)(2 - discount)... over its tables."""
    if discount not in _triangles:
        rows = [np.zeros(0), np.zeros(1)]
        for c in range(1, TRIANGLE):
            joins = np.append(np.log(c - discount * np.arange(1, c + 1)) + rows[c], -np.inf)
            rows.append(np.logaddexp(joins, np.append(-np.inf, rows[c])))
        _triangles[discount] = rows
    return _triangles[discount]


def chances(count: int, weight: float, discount: float) -> tuple[int, np.ndarray]:
    """(least t, chances of t, t + 1, ...) of a number of tables, given many customers and a new table's weight.

    Sizes of tables are Sibuya variables with generating function 1 - (1 - x) ** discount, their number is Poisson
    with mean weight / discount, given that the sizes add up to ``count``. The coefficient of x ** count is an
    integral by the trapezoid rule, through the saddle point: over a parabola around the cut x > 1, or over a circle
    around 0 where x is small. The number of tables is a sum of independent 0-1 variables, so its variance is below
    its mean and ten deviations hold it. Against the recurrence the chances differ by less than 1e-6.
    """
    d = discount
    low, high = -700.0, -1e-12
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if weight * math.exp((d - 1) * mid) * -math.expm1(mid) > count else (low, mid)
    u = max(math.exp(low), 2.0 / count)
    root = 1 - u**d
    middle = weight / d * root
    spread = 10 * np.sqrt(middle) + 40
    tables = np.arange(max(1, int(middle - spread)), min(count, int(middle + spread)) + 1)
    x = 1 - u
    usual = count * root / (x * d * u ** (d - 1))
    if u < 0.12:
        bend = (count + 1) / x**2 - usual * d * ((d - 1) * u ** (d - 2) * root + d * u ** (2 * d - 2)) / root**2
        width = 1 / (2 * u * np.sqrt(bend))
        step = min(0.15, width / 2)
        reach = max(12 * width, np.sqrt(np.expm1(40 / (count * (1 - d)))))
        turn = 1 + 1j * step * np.arange(int(reach / step) + 2)
        at, lead = u * turn**2, np.log(turn) - np.log1p(-u * turn**2) + np.log1p(-u)
    else:
        mean = x * d * u ** (d - 1) / root
        swing = np.sqrt(usual * max(mean + x * x * d * (1 - d) * u ** (d - 2) / root - mean**2, 0.0))
        nodes = 2 * int(12 * (swing + np.sqrt(middle) * mean)) + 257
        angle = 2 * np.pi / nodes * np.arange(int(min(np.pi, 14 / max(swing, 1e-9)) / (2 * np.pi) * nodes) + 1)
        at, lead = 1 - x * np.exp(1j * angle), 0
    height = np.log(-np.expm1(d * np.log(at))) - np.log(root)
    rest = lead - count * (np.log1p(-at) - np.log(x))
    ends = np.ones(len(at))
    ends[0] = 0.5
    leaps = np.exp(np.multiply.outer(tables[::32], height) + rest) * ends
    sums = (leaps @ np.exp(np.multiply.outer(height, np.arange(32)))).real.ravel()[: len(tables)]
    steps = np.log(weight / d * root) - np.log(tables[1:])
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chance = np.exp(logs - logs.max()) * np.maximum(sums, 0)
    return int(tables[0]), chance / chance.sum()


def draw_tables(counts: np.ndarray, weight: np.ndarray, discount: float, rng) -> np.ndarray:
    """The number of tables of each pair, drawn anew given all its customers: t with a chance in proportion to
    weight ** t times S(count, t). That is where moving every customer again and again would lead."""
    out, share = np.minimum(counts, 1), rng.random(len(counts))
    order = np.flatnonzero(counts > 1)
    kinds = np.minimum(counts[order], TRIANGLE + 1).astype("uint16")
    order = order[np.argsort(kinds, kind="stable")]
    small = order[: np.count_nonzero(kinds <= TRIANGLE)]
    rows = triangle(discount)
    for same in np.split(small, np.flatnonzero(np.diff(counts[small])) + 1) if len(small) else []:
        count = int(counts[same[0]])
        for pairs in np.array_split(same, -(-len(same) * count // (1 << 20))):
            chance = np.multiply.outer(np.log(weight[pairs]), np.arange(1, count + 1)) + rows[count]
            chance = np.cumsum(np.exp(chance - chance.max(axis=1, keepdims=True)), axis=1)
            out[pairs] = 1 + (chance[:, :-1] <= share[pairs, None] * chance[:, -1:]).sum(axis=1)
    for pair in order[len(small) :].tolist():
        least, chance = chances(int(counts[pair]), float(weight[pair]), discount)
        ends = np.cumsum(chance)
        out[pair] = least + min(np.searchsorted(ends, share[pair] * ends[-1], side="right"), len(ends) - 1)
    return out


class Totals:
    """Sums at the end of a sweep: tables of the contexts at hand, customers and tables of the parent."""

    def __init__(self, values: np.ndarray):
        self.tables, self.customers, self.parents = values[:-2], values[-2], values[-1]


class Settings:
    """What all buckets share: distinct words, discounts and base; ``seated``, customers of contexts laid out by hand."""

    def __init__(self, seated: np.ndarray, words: float, ones: float, twos: float):
        self.seated, self.words = seated, words
        self.discount = float(np.clip(ones / max(ones + 2 * twos, 1.0), 0.1, 0.95))
        self.parent_discount = self.discount
        self.base = 1.0 / (words + 1.0)

    def parent_probability(self, customers: np.ndarray, parents: np.ndarray, totals: Totals) -> np.ndarray:
        own = customers - self.parent_discount * parents
        return (own + (STRENGTH + self.parent_discount * totals.parents) * self.base) / (STRENGTH + totals.customers)


class Bucket:
    """All words of one bucket of the model, their pairs with contexts and the seats of those.

    Where a row has ``places``, it holds the pairs with two customers or more, contexts as places among the bucket's
    own, and the number of pairs with one customer of each word, whose one table never changes. Draws have seeds of
    bucket and sweep, so that a repeated task gives the same seats.
    """

    def __init__(self, row: dict, settings: Settings):
        self.number, self.settings = row["bucket"], settings
        each, self.counts = (expanded(row[c], "<u4").astype("int64") for c in ("each", "counts"))
        self.size, self.word = len(each), np.repeat(np.arange(len(each)), each)
        if "places" in row:
            self.context, self.single = (expanded(row[c], "<u4").astype("int64") for c in ("places", "single"))
        else:
            self.context, self.single = expanded(row["contexts"], "<u2").astype("int64"), np.zeros(self.size, "int64")
        self.active = np.flatnonzero(self.counts > 1)
        self.done = 0
        self.seated = first_tables(self.counts, settings.discount)
        self.parents = first_tables(self.customers(), settings.parent_discount)

    def tables(self) -> np.ndarray:
        return self.seated

    def customers(self) -> np.ndarray:
        own = np.bincount(self.word, weights=self.tables(), minlength=self.size).astype("int64")
        return own + self.single

    def totals(self) -> np.ndarray:
        contexts = np.bincount(self.context, weights=self.tables(), minlength=len(self.settings.seated))
        return np.concatenate([contexts, [self.customers().sum(), self.parents.sum()]])

    def parent_probability(self, totals: Totals) -> np.ndarray:
        return self.settings.parent_probability(self.customers(), self.parents, totals)

    def sweep(self, number: int, totals: Totals) -> None:
        """All customers of every pair are seated anew, given the totals of the sweep before; then the parent's."""
        s = self.settings
        rng = np.random.default_rng([SEED, self.number, number])
        weight = STRENGTH + s.discount * totals.tables[self.context[self.active]]
        weight *= self.parent_probability(totals)[self.word[self.active]]
        self.seated[self.active] = draw_tables(self.counts[self.active], weight, s.discount, rng)
        new = np.full(self.size, (STRENGTH + s.parent_discount * totals.parents) * s.base)
        self.parents = draw_tables(self.customers(), new, s.parent_discount, rng)

    def replay(self, history: list[np.ndarray]):
        """After every sweep of the history that isn't in the seats yet: its number."""
        for number, totals in enumerate(history[self.done :], self.done + 1):
            self.sweep(number, Totals(totals))
            yield number


class Homes:
    """Where the tables of a context meet: contexts are dealt by hash like words, homes take whole buckets."""

    def __init__(self, buckets: int):
        self.buckets, self.number = buckets, max(min(buckets, HOMES), -(-buckets // HOME_BUCKETS))

    def of(self, ids: np.ndarray) -> np.ndarray:
        return (ids % np.uint64(self.buckets)).astype("int64") % self.number

    def messages(self, bucket: int, ids: np.ndarray, amounts: np.ndarray, book: Book, wanted=None) -> list[dict]:
        """One row per home: a bucket's contexts and its amount of each. Contexts stay in their order."""
        home, codes = self.of(ids), book.codes(ids)
        rows = []
        for h in np.unique(home).tolist():
            at = np.flatnonzero(home == h)
            row = {"bucket": bucket, "home": h, "ids": book.pack(ids[at], codes[at]), "amounts": squeezed(amounts[at], "<u4")}
            if wanted is not None:
                row["wanted"] = squeezed(wanted[at], "<u1")
            rows.append(row)
        return rows


def met(messages: DataFrame, homes: Homes, book, own: bool = False) -> DataFrame:
    """To every message the sums of its contexts over all buckets, of the wanted ones where it names them; if
    ``own``, also rows with ``ids``: the sums for the bucket that holds the context as a word."""

    def meet(group: pa.Table) -> pa.Table:
        rows, home = group.to_pylist(), group["home"][0].as_py()
        known, places = book.value.places([r["ids"] for r in rows])
        amounts = [expanded(r["amounts"], "<u4") for r in rows]
        sums = np.bincount(places, weights=np.concatenate(amounts), minlength=len(known)).astype("int64")
        out = []
        for row, place in zip(rows, np.split(places, np.cumsum([len(a) for a in amounts])[:-1])):
            if row["wanted"] is not None:
                place = place[expanded(row["wanted"], "<u1") > 0]
            out.append({"bucket": row["bucket"], "home": home, "amounts": squeezed(sums[place], "<u4")})
        if own:
            bucket = (known % np.uint64(homes.buckets)).astype("int64")
            for b in np.unique(bucket).tolist():
                at = np.flatnonzero(bucket == b)
                ids, amounts = book.value.pack(known[at]), squeezed(sums[at], "<u4")
                out.append({"bucket": b, "home": home, "ids": ids, "amounts": amounts})
        return pa.Table.from_pylist(out, schema_of(MESSAGE_FIELDS))

    return messages.groupBy("home").applyInArrow(meet, MESSAGE_FIELDS)


def single_tables(model: DataFrame, homes: Homes, book) -> DataFrame:
    """Messages about pairs with one customer, whose tables never change. Wanted are contexts with other pairs too."""

    def told(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, _, ids, place, counts = pairs_of(row, book.value)
                single = np.bincount(place, weights=counts == 1, minlength=len(ids)).astype("int64")
                wanted = np.bincount(place, weights=counts > 1, minlength=len(ids)) > 0
                rows = homes.messages(row["bucket"], ids, single, book.value, wanted)
                yield pa.RecordBatch.from_pylist(rows, schema_of(MESSAGE_FIELDS))

    return model.mapInArrow(told, MESSAGE_FIELDS)


def active_pairs(model: DataFrame, book) -> DataFrame:
    """Pairs with two customers or more, which sweeps seat anew."""

    def active(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, word, ids, place, counts = pairs_of(row, book.value)
                many = counts > 1
                used = np.bincount(place[many], minlength=len(ids)) > 0
                ids, place = ids[used], (np.cumsum(used) - 1)[place]
                out = {
                    "bucket": row["bucket"],
                    "each": squeezed(np.bincount(word[many], minlength=len(words)), "<u4"),
                    "single": squeezed(np.bincount(word[~many], minlength=len(words)), "<u4"),
                    "places": squeezed(place[many], "<u4"),
                    "counts": squeezed(counts[many], "<u4"),
                    "ids": book.value.pack(ids),
                }
                yield pa.RecordBatch.from_pylist([out], schema_of(ACTIVE_FIELDS))

    return model.mapInArrow(active, ACTIVE_FIELDS)


def swept(active: DataFrame, notes: DataFrame, settings: Settings, homes: Homes, book, number: int, sums) -> DataFrame:
    """Seats after a sweep and messages about them, from the replies about the seats before and these seats.

    Number 0 lays out the first seats; its replies are about single tables, which later rows carry along.
    """
    shared = active.sparkSession.sparkContext.broadcast(settings)

    def sweep(pairs: pa.Table, notes: pa.Table) -> pa.Table:
        row = pairs.to_pylist()[0]
        bucket, ids = Bucket(row, shared.value), book.value.unpack(row["ids"])
        told, seats = [], None
        for note in notes.to_pylist():
            if note["home"] is None:
                seats = note
            else:
                told.append(note)
        told.sort(key=lambda note: note["home"])
        found = np.concatenate([expanded(n["amounts"], "<u4") for n in told] + [np.zeros(0, "<u4")]).astype("int64")
        tables = np.empty(len(ids), "int64")
        tables[np.argsort(homes.of(ids), kind="stable")] = found
        if number:
            fixed = expanded(seats["fixed"], "<u4").astype("int64")
            bucket.seated, bucket.parents = (expanded(seats[c], "<u4").astype("int64") for c in ("seated", "parents"))
            bucket.sweep(number, Totals(np.concatenate([fixed + tables, sums])))
        else:
            fixed = tables
        own = np.bincount(bucket.context, weights=bucket.seated, minlength=len(ids)).astype("int64")
        customers = bucket.customers()
        rows = homes.messages(row["bucket"], ids, own, book.value)
        rows.append(
            {
                "bucket": row["bucket"],
                "fixed": squeezed(fixed, "<u4"),
                "seated": squeezed(bucket.seated, "<u4"),
                "parents": squeezed(bucket.parents, "<u4"),
                "all_customers": int(customers.sum()),
                "all_parents": int(bucket.parents.sum()),
            }
        )
        return pa.Table.from_pylist(rows, schema_of(SEATS_FIELDS))

    return active.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(sweep, SEATS_FIELDS)


def train(model: DataFrame, settings: Settings, homes: Homes, book) -> tuple[DataFrame, list[tuple[int, int]]]:
    """Seats and sums of contexts of the last SAMPLES sweeps, and the parent's customers and tables after each.

    Pairs stay where they are through all sweeps; only totals of contexts and seats move.
    """
    parts = int(model.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    active = active_pairs(model, book).repartition(min(parts, homes.buckets), "bucket").persist(StorageLevel.DISK_ONLY)
    active.count()  # only then later plans know how it is dealt, and don't deal it again
    told = stage(met(single_tables(model, homes, book), homes, book, own=True), "single")
    notes, sums, kept, samples, sizes = told.where("ids is null"), np.zeros(2), None, [], []
    samples.append(told.where("ids is not null").withColumn("sample", F.lit(None).cast("int")))
    try:
        for number in range(SWEEPS + 1):
            out = swept(active, notes, settings, homes, book, number, sums)
            sampled = number > SWEEPS - SAMPLES
            out = stage(out, "seats") if sampled or number % KEPT_EVERY == 0 else out.persist(StorageLevel.DISK_ONLY)
            seats = out.where("home is null")
            messages = out.where("home is not null").select("bucket", "home", "ids", "amounts", "wanted")
            sums = np.array(seats.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("all_customers", "all_parents")]).first())
            told = met(messages, homes, book, own=sampled)
            if sampled:
                told = stage(told, "sums")
                samples += [p.withColumn("sample", F.lit(len(sizes))) for p in (told.where("ids is not null"), seats)]
                sizes.append(tuple(sums.tolist()))
            notes = told.where("ids is null").unionByName(seats, allowMissingColumns=True)
            if kept is not None:
                kept.unpersist()
            kept = out if out.is_cached else None
    finally:
        active.unpersist()
        if kept is not None:
            kept.unpersist()
    notes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), samples)
    return notes.select("bucket", "sample", "ids", "amounts", "seated", "parents"), sizes


class Known:
    """What the samples say about a bucket: tables of its pairs, added up, and of its words as dishes and contexts."""

    def __init__(self, rows: list[dict], book: Book):
        row = dict.fromkeys(("words", "each", "contexts", "counts"), b"")
        row = next((r for r in rows if r["words"] is not None), row)
        self.words, word, ids, place, self.counts = pairs_of(row, book)
        self.size = max(len(ids), 1)
        self.keys = word * self.size + place
        self.dishes, self.contexts = Places(self.words, book), Places(ids, book)
        frequency = np.bincount(word, weights=self.counts, minlength=len(self.words)).astype("int64")
        self.tables = np.where(self.counts > 1, 0, SAMPLES)
        many = np.flatnonzero(self.counts > 1)
        single = np.bincount(word[self.counts == 1], minlength=len(self.words))
        customers, parents, totals = (np.zeros((SAMPLES, len(self.words)), "int64") for _ in range(3))
        for note in rows:
            if note["seated"] is not None:
                seated = expanded(note["seated"], "<u4")
                self.tables[many] += seated
                own = np.bincount(word[many], weights=seated, minlength=len(self.words))
                customers[note["sample"]] = single + own.astype("int64")
                parents[note["sample"]] = expanded(note["parents"], "<u4")
            elif note["ids"] is not None:
                which = slice(None) if note["sample"] is None else note["sample"]
                at, _ = self.dishes.find(note["ids"])
                totals[which, at] += expanded(note["amounts"], "<u4").astype("int64")
        self.of_words = {"frequency": frequency, "customers": customers, "parents": parents, "totals": totals}

    def reply(self, request: dict) -> dict:
        each = expanded(request["each"], "<u4").astype("int64")
        at, has = self.dishes.find(request["words"], 0)
        context, seen = self.contexts.find(request["contexts"], each)
        pair, there = find(self.keys, np.repeat(at, each) * self.size + context)
        there &= seen & np.repeat(has, each)
        out = {"chunk": request["chunk"], "bucket": request["bucket"]}
        for name, values in self.of_words.items():
            picked = np.zeros((*values.shape[:-1], len(at)), "int64")
            picked[..., has] = values[..., at[has]]
            out[name] = squeezed(picked, "<i8") if name == "frequency" else stacked(picked)
        counts, tables = (np.zeros(len(context), "int64") for _ in range(2))
        counts[there], tables[there] = self.counts[pair[there]], self.tables[pair[there]]
        return out | {"counts": squeezed(counts, "<u4"), "tables": squeezed(tables[counts > 1], "<u4")}


def turns_of(model: DataFrame, turns: int) -> DataFrame:
    """(bucket, in how many turns it answers): all but buckets of hot words in one, so that they are sent once."""
    own = F.least(F.ceil(F.col("asked") / TURN_PAIRS), F.lit(turns).cast("bigint"))
    return model.select("bucket", own.alias("turns"))


def answers(asked: DataFrame, model: DataFrame, notes: DataFrame, turns: int, book) -> DataFrame:
    """For every request: counts of its words and their tables as dishes and contexts, counts of its pairs and tables
    of those with two customers or more."""
    known = model.drop("turn", "asked").unionByName(notes, allowMissingColumns=True)
    asked, zero = asked.drop("asked", "counts"), F.lit(0).cast("bigint")
    if turns > 1:
        own, least = F.broadcast(turns_of(model, turns)), F.coalesce("turns", F.lit(turns).cast("bigint"))
        asked = asked.join(own, "bucket", "left").withColumn("turn", F.pmod("turn", least)).drop("turns")
        known = known.join(own, "bucket", "left").withColumn("turn", F.explode(F.sequence(zero, least - 1))).drop("turns")
    else:
        asked, known = asked.withColumn("turn", zero), known.withColumn("turn", zero)

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        bucket = Known(known.to_pylist(), book.value)
        rows = asked.select(["chunk", "bucket", "words", "each", "contexts"]).to_pylist()
        return pa.Table.from_pylist([bucket.reply(r) for r in rows], schema_of(ANSWER_FIELDS))

    both = asked.groupBy("bucket", "turn").cogroup(known.groupBy("bucket", "turn"))
    return both.applyInArrow(answer, ANSWER_FIELDS)


def log_probabilities(own: Chunk, found: list[dict], settings: Settings, sizes: list[tuple[int, int]]):
    """(counts of a chunk's words, log10 of the averaged probability of its pairs) from the answers of its buckets."""
    s = settings
    size = len(own.word_order)

    def of_words(parts: list[np.ndarray]) -> np.ndarray:
        out = np.empty((*parts[0].shape[:-1], size), "int64")
        out[..., own.word_order] = np.concatenate(parts, axis=-1)
        return out

    frequency = of_words([expanded(f["frequency"], "<i8") for f in found])
    counts, tables = (np.concatenate([expanded(f[c], "<u4").astype("int64") for f in found]) for c in ("counts", "tables"))
    all_tables = SAMPLES * counts
    all_tables[counts > 1] = tables
    total = np.empty(len(counts))
    total[own.pair_order] = SAMPLES * counts - s.discount * all_tables
    each = zip(sizes, *(of_words([unstacked(f[c]) for f in found]) for c in ("customers", "parents", "totals")))
    for (all_customers, all_parents), customers, parents, tables in each:
        parent = s.parent_probability(customers, parents, Totals(np.array([all_customers, all_parents])))
        total += (STRENGTH + s.discount * tables)[own.context] * parent[own.word]
    return frequency, np.log10(total / (SAMPLES * (STRENGTH + frequency[own.context])))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order, the place there of each), keys of 0 or more; key and row share a number where they fit."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()).bit_length() + bits > 63:
        return np.unique(keys, return_inverse=True)
    kind = "int32" if bits < 32 else "int64"
    both = keys << bits
    both |= np.arange(len(keys))
    both.sort()
    rows = (both & ((1 << bits) - 1)).astype(kind)
    both >>= bits
    new = np.ones(len(keys), bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    place = np.empty(len(keys), kind)
    place[rows] = np.cumsum(new, dtype=kind) - 1
    return both[new], place


def sorting(keys: np.ndarray) -> np.ndarray:
    """The rows of distinct keys of 0 or more in order; key and row share a number where they fit."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()).bit_length() + bits > 63:
        return np.argsort(keys)
    both = keys << bits
    both |= np.arange(len(keys))
    both.sort()
    both &= (1 << bits) - 1
    return both


def find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of each wanted value in sorted values."""
    if not len(known):
        return np.zeros(len(wanted), "int64"), np.zeros(len(wanted), bool)
    order = np.argsort(wanted)
    at = np.empty(len(wanted), "int64")
    at[order] = np.minimum(np.searchsorted(known, wanted[order]), len(known) - 1)
    return at, known[at] == wanted


def fitted(chunks: DataFrame, buckets: int, turns: int, book):
    """(model, settings, training tokens, notes of the last sweeps, their sizes) of the training documents."""

    def merged(group: pa.Table) -> pa.Table:
        return merge(group, book.value)

    once = requests(chunks, buckets, book, learn=True).drop("chunk")
    once = once.groupBy("bucket", "turn").applyInArrow(merged, MODEL_FIELDS)
    model = stage(once.groupBy("bucket").applyInArrow(merged, MODEL_FIELDS) if turns > 1 else once, "model")

    def shape(batch):
        total = np.zeros(4)
        for i in range(batch.num_rows):
            words, *_, counts = pairs_of(batch.slice(i, 1).to_pylist()[0], book.value)
            total += [len(words), (counts == 1).sum(), (counts == 2).sum(), counts.sum()]
        return total

    *shapes, n = summed(model, 4, shape)
    settings = Settings(np.zeros(0), *shapes)
    return model, settings, int(n), *train(model, settings, Homes(buckets), book)


def score_documents(
    docs: DataFrame, train_rows: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id_col``, n_tokens, n_known, train_tokens, base_score, score (log10) for every whole text.

    Words and one end per document are tokens. A token's restaurant is that of the word before it, the end of a
    document standing before the first; all restaurants share one parent over words, whose base is uniform over the
    words seen and one unseen. Counts of (word, context) pairs come from all training documents. Buckets of words are
    sampled in parallel; after every sweep the tables of a context are added up over the buckets in its home and sent
    back. The probabilities of the last SAMPLES sweeps are averaged. A chunk of documents asks for each distinct pair
    once.

    NULL and empty texts are one end. Repeated rows are learnt from and scored each; without training rows all
    scores are 0; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    share = min(1.0, BOOK_DOCUMENTS / max(1, docs.count()))
    some = as_chunks(docs.sample(share, seed=SEED), train_rows, id_col, text_col)
    book = spark.sparkContext.broadcast(book_of(stage(some, "some")))
    chunks = stage(as_chunks(docs, train_rows, id_col, text_col, book), "chunks")
    size, number = chunks.agg(F.sum("n_words"), F.count("*")).first()
    buckets, turns = max(1, -(-int(size or 0) // BUCKET_WORDS)), max(1, -(-number // TURN_CHUNKS))

    model, settings, n, notes, sizes = fitted(chunks, buckets, turns, book)
    found = answers(requests(chunks, buckets, book, learn=False), model, notes, turns, book)
    kind = docs.schema[id_col].dataType.simpleString()
    log_total = float(np.log10(n + settings.words + 1))

    def slim(batches):
        for batch in batches:
            homes = [squeezed(book.value.unpack(w.as_py(), 0) % np.uint64(buckets), "<u4") for w in batch["words"]]
            yield batch.drop_columns(["words"]).append_column("homes", pa.array(homes, pa.binary()))

    fields = CHUNK_FIELDS.format(kind=kind).replace("train array<boolean>, ", "").replace("n_words bigint, ", "").replace("words", "homes")
    chunks = chunks.drop("train", "n_words").mapInArrow(slim, fields)

    def scored(chunk: pa.Table, found: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        own = Chunk(row, buckets)
        found = sorted(found.to_pylist(), key=lambda f: f["bucket"])
        counts, logs = log_probabilities(own, found, settings, sizes)
        base = np.log10(counts + 1.0) - log_total
        of_tokens = ((counts > 0).astype("int64"), own.tokens), (base, own.tokens), (logs, own.pair_of)
        sums = [np.add.reduceat(values[at], own.starts) for values, at in of_tokens]
        columns = [pa.array(row["doc_no"], pa.int64()), chunk["ids"].combine_chunks().flatten(), pa.array(own.lengths)]
        return pa.Table.from_arrays([*columns, *map(pa.array, sums)], ["doc_no", "id", "n_tokens", "n_known", "base", "score"])

    fields = f"doc_no bigint, id {kind}, n_tokens bigint, n_known bigint, base double, score double"
    pieces = chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(scored, fields)
    whole = pieces.groupBy("doc_no").agg(
        F.first("id").alias(id_col), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")]
    )
    return whole.select(
        id_col, "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score",
    )


def held_out(id_col: str = "doc_id") -> Column:
    """The rows that nothing is learnt from."""
    return remainder(id_col, 7) == 2
