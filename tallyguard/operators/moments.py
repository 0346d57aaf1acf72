"""Correlations of many pairs of columns from matrix products over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.session import ship_package

PARTIAL = "i int, state binary"
RESULT = "i int, j int, r double"


@dataclass
class PairMoments:
    """Over the rows where both columns of a pair are present, a matrix of pairs each.

    ``odd`` counts rows of a pair with a NaN or an infinite value, which stay out of the sums.
    """

    n: np.ndarray
    odd: np.ndarray
    mean_x: np.ndarray
    mean_y: np.ndarray
    square_x: np.ndarray
    square_y: np.ndarray
    product: np.ndarray
    low_x: np.ndarray
    high_x: np.ndarray
    low_y: np.ndarray
    high_y: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, has_x: np.ndarray, y: np.ndarray, has_y: np.ndarray) -> "PairMoments":
        """The moments of rows × left columns against rows × right columns; absent values are ignored."""
        ok_x, ok_y = has_x & np.isfinite(x), has_y & np.isfinite(y)
        p, q = ok_x.astype("f8"), ok_y.astype("f8")
        shift_x, dx = _shifted(x, ok_x)
        shift_y, dy = _shifted(y, ok_y)
        n = p.T @ q
        at_least = np.maximum(n, 1)
        sum_x, sum_y = dx.T @ q, p.T @ dy
        low_x, high_x = _extremes(x, ok_x, ok_y)
        low_y, high_y = (e.T for e in _extremes(y, ok_y, ok_x))
        return cls(
            n,
            has_x.astype("f8").T @ has_y.astype("f8") - n,
            np.where(n > 0, shift_x[:, None] + sum_x / at_least, 0.0),
            np.where(n > 0, shift_y[None, :] + sum_y / at_least, 0.0),
            np.maximum((dx * dx).T @ q - sum_x * sum_x / at_least, 0),
            np.maximum(p.T @ (dy * dy) - sum_y * sum_y / at_least, 0),
            dx.T @ dy - sum_x * sum_y / at_least,
            low_x, high_x, low_y, high_y,
        )

    def plus(self, other: "PairMoments") -> "PairMoments":
        """The moments of the rows of both."""
        n = self.n + other.n
        at_least = np.maximum(n, 1)
        share = other.n / at_least
        gap_x, gap_y = other.mean_x - self.mean_x, other.mean_y - self.mean_y
        weight = self.n * share
        return PairMoments(
            n,
            self.odd + other.odd,
            np.where(self.n > 0, self.mean_x + gap_x * share, other.mean_x),
            np.where(self.n > 0, self.mean_y + gap_y * share, other.mean_y),
            self.square_x + other.square_x + gap_x * gap_x * weight,
            self.square_y + other.square_y + gap_y * gap_y * weight,
            self.product + other.product + gap_x * gap_y * weight,
            np.minimum(self.low_x, other.low_x),
            np.maximum(self.high_x, other.high_x),
            np.minimum(self.low_y, other.low_y),
            np.maximum(self.high_y, other.high_y),
        )

    def correlation(self) -> np.ndarray:
        """Pearson per pair: NaN where an odd value takes part, masked without rows or with a constant column."""
        varied = (self.low_x < self.high_x) & (self.low_y < self.high_y)
        scale = np.sqrt(self.square_x) * np.sqrt(self.square_y)
        known = varied & (scale > 0)
        r = np.where(self.odd > 0, np.nan, self.product / np.where(known, scale, 1.0))
        return np.ma.masked_array(r, mask=~known & (self.odd == 0))

    def rows(self) -> Iterator[bytes]:
        """The state of each left column against all right columns."""
        stacked = np.stack([getattr(self, f.name) for f in fields(self)])
        return (np.ascontiguousarray(stacked[:, i, :]).tobytes() for i in range(stacked.shape[1]))

    @classmethod
    def from_row(cls, state: bytes) -> "PairMoments":
        return cls(*np.frombuffer(state, "f8").reshape(len(fields(cls)), 1, -1))


def _shifted(x: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean of each column's usable values, and the values less the mean, 0 where unusable."""
    kept = np.where(ok, x, 0.0)
    mean = kept.sum(axis=0) / np.maximum(ok.sum(axis=0), 1)
    return mean, np.where(ok, kept - mean, 0.0)


def _extremes(x: np.ndarray, ok: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest of each column over the rows of each other column; columns with equal gaps share a pass."""
    gaps, which = np.unique(other, axis=1, return_inverse=True)
    low = np.empty((x.shape[1], gaps.shape[1]))
    high = np.empty_like(low)
    for k in range(gaps.shape[1]):
        both = ok & gaps[:, k : k + 1]
        low[:, k] = np.where(both, x, np.inf).min(axis=0, initial=np.inf)
        high[:, k] = np.where(both, x, -np.inf).max(axis=0, initial=-np.inf)
    which = which.reshape(-1)
    return low[:, which], high[:, which]


def _matrix(batch: pa.RecordBatch, places: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
    """Values (0 where missing) and presence of some columns of a batch."""
    columns = [batch.column(k) for k in places]
    values = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns])
    return values, np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])


def pearson(df: DataFrame, left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """(i, j, r): Pearson of the i-th left with the j-th right column over the rows where both are present.

    A task turns its batches into one small state per left column by matrix products over the batch; the states
    of a left column merge in one task, one after the other, so that the shuffle holds tasks × pairs states
    whatever the number of rows. A constant column, or a pair without rows, gives NULL; a NaN or an infinite
    value in a pair gives NaN. An empty table without partitions gives no rows.
    """
    ship_package(df.sparkSession)
    columns = list(dict.fromkeys([*left, *right]))
    xs, ys = [columns.index(c) for c in left], [columns.index(c) for c in right]
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)])

    def partial(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                found = PairMoments.of(*_matrix(batch, xs), *_matrix(batch, ys))
                total = found if total is None else total.plus(found)
        if total is not None:
            states = list(total.rows())
            yield pa.RecordBatch.from_arrays([pa.array(range(len(states)), pa.int32()), pa.array(states, pa.binary())], ["i", "state"])

    def merged(batches):
        totals: dict[int, PairMoments] = {}
        for batch in batches:
            for i, state in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = PairMoments.from_row(state.as_py())
                totals[i] = totals[i].plus(found) if i in totals else found
        for i, total in totals.items():
            r = total.correlation()[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(r), pa.int32()), pa.array(range(len(r)), pa.int32()), pa.array(r.data, pa.float64(), mask=np.ma.getmaskarray(r))],
                ["i", "j", "r"],
            )

    return numbers.mapInArrow(partial, PARTIAL).repartition("i").mapInArrow(merged, RESULT)
