"""Array arithmetic on the bytes of many texts at once, for use inside Arrow tasks.

Texts of one batch lie one behind another in a byte array; a text, a line or a word is a pair of positions in it. Spans
are compared by 64-bit hashes of their bytes, taken from one running sum over the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BATCH_BYTES = 4 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def slices(column: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of at most ``most`` bytes, or one longer row; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        yield row, end, data[ends[row] : ends[end]], ends[row : end + 1] - ends[row]
        row = end


class Hasher:
    """64-bit hashes of any spans of one byte array."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.full(n + 1, _BASE, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:n], out=self.total[1:])
        self.n = n

    def inverse(self) -> np.ndarray:
        back = np.full(self.n + 1, _INVERSE, np.uint64)
        back[0] = 1
        return np.cumprod(back, out=back)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_back"):
            self._back = self.inverse()
        raw = (self.total[ends] - self.total[starts]) * self._back[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the first word of each text (one more entry than texts)."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words that stay in one text, and the index of each window's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(0xA24BAED4963EE407) + hashes[k : k + n])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return total[at], at


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts ``keys`` (stable) and, along it, whether an entry opens a new value."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    opens = np.ones(len(keys), bool)
    opens[1:] = ordered[1:] != ordered[:-1]
    return order, opens
