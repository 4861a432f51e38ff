"""Arrow text columns as numpy arrays: chunks of bounded size, words and their hashes without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers = np.ones(1, np.uint64)
_inverse_powers = np.ones(1, np.uint64)


def strings(column: pa.Array) -> pa.Array:
    """The column as strings, nulls as empty texts."""
    column = column.cast(pa.string()) if column.type != pa.string() else column
    return column.fill_null("") if column.null_count else column


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its rows."""
    column = strings(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most so many bytes together; a longer text is a range of its own."""
    _, offsets = utf8(column)
    start = 0
    while start < len(column):
        stop = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        stop = min(max(stop, start + 1), len(column))
        yield start, stop
        start = stop


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd multiplier modulo 2**64, and of its inverse."""
    global _powers, _inverse_powers
    if len(_powers) < n:
        size = max(n, 1 << 16)
        first, second = np.full(size, _MULTIPLIER, np.uint64), np.full(size, _INVERSE, np.uint64)
        first[0] = second[0] = 1
        _powers, _inverse_powers = np.cumprod(first, dtype=np.uint64), np.cumprod(second, dtype=np.uint64)
    return _powers[:n], _inverse_powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_SYMBOL = mix(np.arange(1, 257, dtype=np.uint64))


def prefix_hashes(symbols: np.ndarray, seed: int = 0) -> np.ndarray:
    """Sums of keyed symbols times powers, so that a range's hash is a difference; symbols are bytes or code points."""
    keyed = _SYMBOL[symbols] if symbols.dtype == np.uint8 and not seed else mix(symbols.astype(np.uint64) + np.uint64(seed * 0x1000000 + 1))
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(keyed * powers(len(symbols))[0], out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range, equal for equal contents wherever they stand."""
    value = (prefix[stops] - prefix[starts]) * powers(len(prefix))[1][starts]
    return mix(value + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def letters_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """For each byte the byte that counts in a word, 0 for separators."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[65:91] += 32
    table[0] = 255  # a byte that UTF-8 never has; 0 stands for separators
    table[np.frombuffer(separators, np.uint8)] = 0
    return table


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all rows of a chunk: hashes of their words, the words' start and stop bytes, and each row's first word (with one more for the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    symbols = table[data]
    inside = symbols != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    begins = cuts[cuts < len(data)]
    first[begins] = inside[begins]
    ends = cuts[cuts > 0] - 1
    last[ends] = inside[ends]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    return range_hashes(prefix_hashes(symbols), starts, stops), starts, stops, np.searchsorted(starts, offsets)


class Table:
    """64-bit keys to numbers by open addressing in numpy arrays, for broadcast tables of bounded size."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(2 * max(1, len(keys)) - 1).bit_length() + 1)
        self.keys, self.values = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int64)
        left, at = np.arange(len(keys)), (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        self.values_of = values
        while len(left):
            free = self.values[at] < 0
            slots, who = np.unique(at[free], return_index=True)
            placed = left[free][who]
            self.keys[slots], self.values[slots] = keys[placed], placed
            rest = ~np.isin(left, placed)
            left, at = left[rest], (at[rest] + 1) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key among the table's keys, -1 if it isn't there."""
        at = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.values[at]
        open_ = np.flatnonzero((found >= 0) & (self.keys[at] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found[open_] = self.values[at[open_]]
            open_ = open_[(found[open_] >= 0) & (self.keys[at[open_]] != keys[open_])]
        return found
