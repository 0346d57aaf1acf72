"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import matrix, remainder, ship, stage, summed

CUT = 0.7
FEATURES = 256
RIDGE = 1.0
SEED = 9
BINS = 4096
#: Raw scores are binned over this range; labels are 0 and 1, so scores hardly leave it and are clipped to it.
RANGE = (-1.0, 2.0)

STATISTICS = (
    "log_chars letters uppers digits blanks lines stops marks symbols pipes word_length long_words capital_words "
    "odd_words distinct_words top_word same_next repeated_lines longest_word byte_entropy"
).split()


def statistics(text: str) -> list[float]:
    """Numbers about a whole text: shares of kinds of characters, words and lines. An empty text has zeros."""
    data = np.frombuffer(text.encode(), "u1")
    if not len(data):
        return [0.0] * len(STATISTICS)
    counts = np.bincount(data, minlength=256)
    n = len(data)

    def share(chars: bytes) -> float:
        return float(counts[list(chars)].sum()) / n

    words = text.split()
    m = max(1, len(words))
    kinds = Counter(words)
    length = np.array([len(w) for w in words] or [0])
    lines = [x for x in text.split("\n") if x.strip()]
    spread = counts[counts > 0] / n
    high = float(counts[128:].sum()) / n
    lower = float(counts[97:123].sum()) / n
    upper = float(counts[65:91].sum()) / n
    letters = max(lower + upper + high, 1e-9)
    same = sum(map(str.__eq__, words, words[1:]))
    odd = sum(k for w, k in kinds.items() if not w[-1].isalnum() and w[-1] not in ".,;:")
    shouted = sum(k for w, k in kinds.items() if len(w) > 1 and w.isupper())
    return [
        float(np.log1p(n)),
        lower + upper + high,
        upper / letters,
        share(b"0123456789"),
        share(b" \t"),
        len(lines) / m,
        share(b".,;:"),
        share(b"!?"),
        share(b"#$%&*+<=>@^_~{}[]\\/"),
        share(b"|"),
        float(length.mean()),
        float((length > 12).mean()),
        shouted / m,
        odd / m,
        len(kinds) / m,
        max(kinds.values(), default=0) / m,
        same / m,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(length.max())),
        float(-(spread * np.log2(spread)).sum()),
    ]


def with_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, x): the statistics of every text."""
    ship(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def measured(batches):
        for batch in batches:
            x = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["id", "x"])

    return source.mapInArrow(measured, f"id {kind}, x array<double>")


class Kernel:
    """Cosines of random projections: their products approximate a Gaussian kernel of the scaled statistics."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        width = np.sqrt(2 * len(mean))
        self.project = rng.standard_normal((len(mean), features)) / width
        self.phase = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        scaled = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.sqrt(2 / len(self.phase)) * np.cos(scaled @ self.project + self.phase)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


class Calibration:
    """Raw score to probability: the non-decreasing steps closest to the labels, over bins of the raw score."""

    def __init__(self, bins: list[int], counts: list[int], ones: list[float]):
        blocks: list[list[float]] = []
        for at, count, one in sorted(zip(bins, counts, ones)):
            blocks.append([one, count, at])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                one, count, _ = blocks.pop()
                blocks[-1][0] += one
                blocks[-1][1] += count
        self.starts = np.array([b[2] for b in blocks], "int64")
        self.values = np.array([b[0] / b[1] for b in blocks])

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.starts, bin_of(raw), side="right") - 1
        return self.values[np.maximum(at, 0)]


def bin_of(raw: np.ndarray) -> np.ndarray:
    low, high = RANGE
    return (np.clip((raw - low) / (high - low), 0, 1) * (BINS - 1)).astype("int64")


class Model:
    def __init__(self, kernel: Kernel, weights: np.ndarray, calibration: Calibration | None = None):
        self.kernel, self.weights, self.calibration = kernel, weights, calibration

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.kernel(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibration(self.raw(x))


def fit(rows: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> Model | None:
    """A model of rows (x, y), or None without rows. Three passes: moments, normal equations, score bins; each
    sends sums of fixed size to the driver."""
    k, d = len(STATISTICS), features + 1

    def moments(batch):
        x = matrix(batch.column(0))
        return np.stack([np.full(k, len(x)), x.sum(axis=0), (x * x).sum(axis=0)])

    n, total, squares = summed(rows, 3 * k, moments).reshape(3, k)
    if not n[0]:
        return None
    mean = total / n
    scale = np.sqrt(np.maximum(squares / n - mean * mean, 0))
    kernel = Kernel(mean, np.where(scale > 1e-9, scale, 1.0), features, seed)

    def equations(batch):
        z, y = kernel(matrix(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False)
        return np.concatenate([z.T @ z, (z.T @ y)[:, None]], axis=1)

    sums = summed(rows, d * (d + 1), equations).reshape(d, d + 1)
    penalty = ridge * np.eye(d)
    penalty[-1, -1] = 1e-6
    model = Model(kernel, np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1]))

    def binned(batch):
        at = bin_of(model.raw(matrix(batch.column(0))))
        y = batch.column(1).to_numpy(zero_copy_only=False)
        return np.stack([np.bincount(at, minlength=BINS), np.bincount(at, weights=y, minlength=BINS)])

    counts, ones = summed(rows, 2 * BINS, binned).reshape(2, BINS)
    some = np.flatnonzero(counts)
    model.calibration = Calibration(some.tolist(), counts[some].tolist(), ones[some].tolist())
    return model


def classify(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "quality",
    cut: float = CUT,
) -> DataFrame:
    """``id_col``, score (0 to 1, higher: label 1 likelier), predicted (score at least ``cut``) for every row.

    Learns from all rows with a label 0 or 1 for which ``train`` (of the id column) holds. Statistics are taken
    from whole texts once and written; NULL texts count as empty ones, and those have zeros. Without labels
    every score is 0.5. A label given twice counts twice; repeated rows come out each; other columns are not
    read; an empty table gives no rows.
    """
    measured = stage(with_statistics(docs, id_col, text_col), "statistics")
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("y")).where("y IN (0, 1)")
    learnt = measured if train is None else measured.withColumnRenamed("id", id_col).where(train).withColumnRenamed(id_col, "id")
    rows = stage(learnt.join(known, "id").select("x", "y"), "labelled")
    model = docs.sparkSession.sparkContext.broadcast(fit(rows))
    kind = measured.schema["id"].dataType.simpleString()

    def scored(batches):
        fitted = model.value
        for batch in batches:
            if not batch.num_rows:
                continue
            score = np.full(batch.num_rows, 0.5) if fitted is None else fitted.score(matrix(batch.column(1)))
            columns = [batch.column(0), pa.array(score), pa.array((score >= cut).astype("int32"))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "score", "predicted"])

    return measured.mapInArrow(scored, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id") -> Column:
    """The rows that nothing is learnt from."""
    return remainder(id_col, 4) == 2
