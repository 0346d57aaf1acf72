"""Language ID: bit-sliced Bloom filters that return, for an n-gram, all languages that contain it."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import remainder, ship, stage

UNKNOWN = "und"
#: An n-gram belongs to a language if its share of the language's n-grams is at least this part of its share in the
#: language where it is most common; no n-gram is left out, and foreign words quoted in a language don't join it.
TYPICAL = 1 / 32
HASHES = 4
BITS_PER_GRAM = 16
#: The table of masks is never larger than this; beyond it filters get fuller, and the correction takes more off.
TABLE_BYTES = 1 << 27
#: Bits of the table that one task puts together.
BLOCK_BITS = 1 << 22
#: Characters worked on at once, and n-grams gathered before they are counted; they bound memory only.
SLICE = 1 << 20
GATHER = 1 << 21
#: The bits of every byte.
BYTE_BITS = np.arange(256)[:, None] >> np.arange(8) & 1
_letters = None


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(text: str):
    """The 3-grams of a text, in slices: each letter with its neighbours, what is no letter as 0, as numbers."""
    low = text.lower()
    for at in range(0, len(low), SLICE):
        part = low[max(0, at - 1) : at + SLICE + 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        codes = np.where(letters()[codes], codes, 0).astype("int64")
        codes = np.concatenate([[0] * (at == 0), codes, [0] * (at + SLICE >= len(low))]).astype("int64")
        middle = codes[1:-1]
        keep = middle > 0
        yield ((codes[:-2] << 42) | (middle << 21) | codes[2:])[keep]


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, gram, count) over all rows with a language and a text, counted before the shuffle."""
    source = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    source = source.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def flush(held):
        langs, keys, counts = [], [], []
        for lang, arrays in held.items():
            found, n = np.unique(np.concatenate(arrays), return_counts=True)
            langs += [lang] * len(found)
            keys.append(found)
            counts.append(n)
        if keys:
            columns = [pa.array(langs), pa.array(np.concatenate(keys)), pa.array(np.concatenate(counts))]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "count"])

    def counted(batches):
        held, size = defaultdict(list), 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in grams(text.as_py()):
                    held[lang].append(part)
                    size += len(part)
                if size > GATHER:
                    yield from flush(held)
                    held, size = defaultdict(list), 0
        yield from flush(held)

    partial = source.mapInArrow(counted, "lang string, gram bigint, count bigint")
    return partial.groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def mask_type(langs: int) -> np.dtype:
    """The smallest unsigned number with a bit for every language; of more than 64 each word holds 64."""
    return np.dtype(next((t for t in ("uint8", "uint16", "uint32") if langs <= 8 * np.dtype(t).itemsize), "uint64"))


def masks_of(places: np.ndarray, codes: np.ndarray, size: int, langs: int) -> np.ndarray:
    """(words, size) masks with the bit of each language at its places."""
    kind = mask_type(langs)
    width = 8 * kind.itemsize
    masks = np.zeros((-(-langs // width) or 1, size), kind)
    np.bitwise_or.at(masks, (codes // width, places), (np.uint64(1) << (codes % width).astype("uint64")).astype(kind))
    return masks


class LanguageFilters:
    """One table of bit masks: a position's mask has the bit of every language with an n-gram hashed there."""

    def __init__(self, found: list[tuple[str, int, int]], totals: dict[str, int]):
        """From (lang, gram, count) at hand; ``learn`` puts the table together from a cluster's."""
        distinct, kept = Counter(lang for lang, _, _ in found), Counter()
        for lang, _, count in found:
            kept[lang] += count
        self.size(totals, distinct, kept)
        number = {lang: i for i, lang in enumerate(self.langs)}
        codes = np.array([number[f[0]] for f in found], "int64")
        cells = self.cells(np.array([f[1] for f in found], "int64"), codes)
        self.take(masks_of(*np.divmod(cells, max(1, len(self.langs))), 1 << self.bits, len(self.langs)))

    def size(self, totals: dict[str, int], distinct: dict[str, int], kept: dict[str, int]) -> None:
        """Languages, bits and hashes, from the numbers of n-grams in the texts and in the filters."""
        self.langs = sorted(totals)
        self.prior = max(self.langs, key=lambda x: (totals[x], x), default=UNKNOWN)
        most, kind = max([1, *distinct.values()]), mask_type(len(self.langs))
        words = -(-len(self.langs) // (8 * kind.itemsize)) or 1
        largest = (TABLE_BYTES // (words * kind.itemsize)).bit_length() - 1
        self.bits = min(max(10, int(most * BITS_PER_GRAM - 1).bit_length()), max(10, largest))
        self.hashes = int(np.clip(round((1 << self.bits) / most * np.log(2)), 1, HASHES))
        #: The share of the n-grams of each language's own texts that its filter holds.
        self.reached = np.array([kept[x] / totals[x] if kept.get(x) else 1.0 for x in self.langs])

    def take(self, masks: np.ndarray) -> None:
        self.masks = masks
        self.false_rate = np.minimum((self.popcounts(masks) / masks.shape[1]) ** self.hashes, 0.999)

    def popcounts(self, masks: np.ndarray) -> np.ndarray:
        """How many of the masks have each language's bit: bytes are counted, then the bits of the 256 bytes."""
        cut = np.ascontiguousarray(masks).view("uint8").reshape(masks.shape[0], masks.shape[1], masks.dtype.itemsize)
        each = [np.bincount(word[:, i], minlength=256) @ BYTE_BITS for word in cut for i in range(masks.dtype.itemsize)]
        return np.concatenate(each)[: len(self.langs)]

    def places(self, keys: np.ndarray):
        """The positions of n-grams, one array per hash: bits of two multiplicative mixes."""
        x = keys.astype("uint64") * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        step = (x * np.uint64(0xBF58476D1CE4E5B9)) | np.uint64(1)
        for i in range(self.hashes):
            yield ((x + np.uint64(i) * step) >> np.uint64(64 - self.bits)).astype("int64")

    def cells(self, keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The distinct (position, language) of n-grams and the numbers of their languages, as one number each."""
        return np.unique(np.concatenate([at * len(self.langs) + codes for at in self.places(keys)]))

    def counts(self, text: str) -> tuple[int, np.ndarray]:
        """The number of n-grams, and for every language how many are in its filter."""
        total, hits = 0, np.zeros(len(self.langs), "int64")
        at_once = max(1, SLICE // len(self.masks))
        for keys in grams(text):
            total += len(keys)
            for at in range(0, len(keys), at_once):
                common = None
                for places in self.places(keys[at : at + at_once]):
                    found = self.masks[:, places]
                    common = found if common is None else common & found
                hits += self.popcounts(common)
        return total, hits

    def predict(self, text: str | None, relative: bool = False) -> tuple[str, float]:
        """(language, share of the text's n-grams that are the language's, false positives taken off).

        ``relative``: the share as a part of the one that the language's own texts reach, 1 at most.
        """
        if text is None or not self.langs:
            return UNKNOWN, 0.0
        total, hits = self.counts(text)
        if not total:
            return UNKNOWN, 0.0
        share = np.clip((hits / total - self.false_rate) / (1 - self.false_rate), 0.0, 1.0)
        best = int(share.argmax())
        score = min(1.0, share[best] / self.reached[best]) if relative else share[best]
        return (self.langs[best], float(score)) if score > 0 else (self.prior, 0.0)


def typical_grams(counts: DataFrame, languages: DataFrame, typical: float, min_share: float) -> DataFrame:
    """(gram, code, count) of n-grams in the languages that they belong to.

    One shuffle by n-gram, of at most one entry a language. The share to compare with is a low estimate, so that
    an n-gram met once in a small language doesn't keep it out of others.
    """
    count = F.col("count")
    rates = counts.join(languages, "lang").withColumns(
        {"share": count / F.col("total"), "sure": (count - F.sqrt(count)) / F.col("total")}
    )
    found = (
        rates.where(F.col("share") >= min_share)
        .groupBy("gram")
        .agg(F.collect_list(F.struct("code", "count", "share")).alias("found"), F.max("sure").alias("most"))
    )
    belongs = F.filter("found", lambda x: x["share"] >= typical * F.col("most"))
    return found.select("gram", F.inline(belongs)).drop("share")


def learn(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_share: float = 0.0,
    typical: float = TYPICAL,
) -> LanguageFilters:
    """Filters from all rows of ``docs``, their table put together in blocks across the cluster.

    The driver gets a row a language and the blocks of the table, ``TABLE_BYTES`` at most.
    """
    spark = docs.sparkSession
    ship(spark)
    counts = stage(count_grams(docs, text_col, lang_col), "grams")
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("count").alias("total")).collect()}
    filters = LanguageFilters([], totals)
    if not totals:
        return filters
    rows = [(lang, code, totals[lang]) for code, lang in enumerate(filters.langs)]
    languages = spark.createDataFrame(rows, "lang string, code bigint, total bigint")
    belonging = stage(typical_grams(counts, languages, typical, min_share), "typical")
    sizes = belonging.groupBy("code").agg(F.count("*").alias("n"), F.sum("count").alias("kept")).collect()
    names = filters.langs
    filters.size(totals, {names[r["code"]]: r["n"] for r in sizes}, {names[r["code"]]: r["kept"] for r in sizes})
    filters.masks = None
    n, positions = len(names), 1 << min(filters.bits, max(0, (BLOCK_BITS // len(names)).bit_length() - 1))

    def placed(batches):
        for batch in batches:
            cells = filters.cells(*(c.to_numpy() for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(cells // n // positions)], ["cell", "block"])

    def block(key, group):
        at, codes = np.divmod(group["cell"].to_numpy(), n)
        masks = masks_of(at % positions, codes, positions, n)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "masks": [masks.tobytes()]})

    cells = belonging.select("gram", "code").mapInArrow(placed, "cell bigint, block bigint").distinct()
    blocks = cells.groupBy("block").applyInArrow(block, "block bigint, masks binary")
    masks = masks_of(np.zeros(0, "int64"), np.zeros(0, "int64"), 1 << filters.bits, n)
    for row in blocks.toLocalIterator():
        found = np.frombuffer(row["masks"], masks.dtype).reshape(len(masks), positions)
        masks[:, row["block"] * positions : (row["block"] + 1) * positions] = found
    filters.take(masks)
    return filters


def identify(
    docs: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    min_share: float = 0.0,
    relative: bool = False,
) -> DataFrame:
    """``id_col``, lang_pred, score for every row, learnt from the rows where ``train`` holds (default: all).

    Every 3-gram of letters in the whole text is looked up once and returns the languages that contain it;
    per-language counts, less the false positives expected, decide, ties by name. Without texts to learn from,
    without letters or on NULL the language is ``und`` with score 0; a text with letters unknown to all
    languages gets the one with most n-grams, score 0. Repeated rows come out each; only id and text are read
    to predict; an empty table gives no rows. Any number of languages is taken; no n-gram is left out, unless
    ``min_share`` asks for a least share of its language. With ``relative`` the score is divided by the share
    that the language's own texts reach.
    """
    spark = docs.sparkSession
    filters = learn(docs if train is None else docs.where(train), text_col, lang_col, min_share)
    shared = spark.sparkContext.broadcast(filters)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def predicted(batches):
        model = shared.value
        for batch in batches:
            found = [model.predict(t.as_py(), relative) for t in batch.column(1)]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], ["id", "lang_pred", "score"])

    return source.mapInArrow(predicted, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """The rows that nothing is learnt from."""
    return remainder(id_col, 5) == 0
