"""Range asymmetric numeral system over a shared static table, many interleaved lanes at once."""

from __future__ import annotations

import numpy as np

#: State interval of a lane: below LOW a decoder reads a 32-bit word, an encoder writes one before LOW << 32.
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
LANES = 2048
#: A decoder can start at every so many rows of lanes.
CHECKPOINT_ROWS = 64
#: Ids below this bound are looked up in an array, others are searched for.
MOST_NUMBERS = 1 << 24


class Table:
    """Frequencies of ids, scaled to a power of two so that every id that occurs has at least one slot."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        order = np.argsort(ids)
        self.ids = ids[order].astype("<u4")
        counts = counts[order].astype("float64")
        self.bits = max(12, int(len(ids)).bit_length() + 3)
        slots = 1 << self.bits
        spare = slots - len(counts)
        share = np.floor(counts / max(counts.sum(), 1.0) * spare).astype("int64") + 1
        share[np.argmax(counts)] += slots - share.sum()
        self.freq = share.astype("uint64")
        self.start = np.concatenate([[0], np.cumsum(share)[:-1]]).astype("uint64")
        self._symbols = None
        top = int(self.ids[-1]) + 1
        self._numbers = None
        if top <= MOST_NUMBERS:
            self._numbers = np.zeros(top, "int32")
            self._numbers[self.ids] = np.arange(len(self.ids))

    def numbers(self, ids: np.ndarray) -> np.ndarray:
        """The places of ids in the table; all of them are in it."""
        return np.searchsorted(self.ids, ids) if self._numbers is None else self._numbers[ids]

    @property
    def symbols(self) -> np.ndarray:
        """The symbol of every slot."""
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.ids), dtype="int32"), self.freq.astype("int64"))
        return self._symbols


def encode(table: Table, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, places, states) of one block: the word stream in reading order, and for every checkpoint the
    place in it and the states of all lanes there. Id number i belongs to lane i modulo LANES."""
    symbols = table.numbers(ids)
    freq, start = table.freq[symbols], table.start[symbols]
    limit = freq << np.uint64(63 - table.bits)
    shift = np.uint64(table.bits)
    state = np.full(LANES, LOW, "uint64")
    rows = -(-len(ids) // LANES)
    groups, length, places, states = [], 0, [], []
    for row in range(rows - 1, -1, -1):
        a, b = row * LANES, min((row + 1) * LANES, len(ids))
        x, f = state[: b - a], freq[a:b]
        full = x >= limit[a:b]
        out = x[full]
        groups.append(out.astype("uint32"))
        length += len(out)
        x = np.where(full, x >> WORD, x)
        quotient = x // f
        state[: b - a] = (quotient << shift) + (x - quotient * f) + start[a:b]
        if row % CHECKPOINT_ROWS == 0:
            places.append(length)
            states.append(state.copy())
    words = np.concatenate(groups[::-1]) if groups else np.zeros(0, "uint32")
    places = length - np.array(places[::-1], "int64")
    return words, places, np.array(states[::-1], "uint64").reshape(len(places), LANES)


def decode(
    table: Table, words: np.ndarray, places: np.ndarray, states: np.ndarray, count: int, part: int | None = None
) -> np.ndarray:
    """Ids of a block, or of the rows from checkpoint ``part`` to the next one alone."""
    if part is not None:
        first = part * CHECKPOINT_ROWS * LANES
        size = min(CHECKPOINT_ROWS * LANES, count - first)
        return _decode_from(table, words, int(places[part]), states[part], size)
    pieces = [decode(table, words, places, states, count, i) for i in range(len(places))]
    return np.concatenate(pieces) if pieces else np.zeros(0, "<u4")


def _decode_from(table: Table, words: np.ndarray, place: int, states: np.ndarray, count: int) -> np.ndarray:
    symbols = table.symbols
    shift, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    state, out = states.copy(), np.empty(count, "int32")
    for a in range(0, count, LANES):
        b = min(a + LANES, count)
        x = state[: b - a]
        slot = x & mask
        symbol = symbols[slot]
        out[a:b] = symbol
        x = table.freq[symbol] * (x >> shift) + slot - table.start[symbol]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << WORD) | words[place : place + len(low)]
        place += len(low)
        state[: b - a] = x
    return table.ids[out]
