"""Words of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are hashed in pieces of about so many bytes (or one text, if it is longer): temporary arrays stay small.
PIECE = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits without visible order."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True

#: How bytes become words. raw: all but the six ASCII white-space characters; plain: ASCII letters without case, digits and
#: all bytes beyond ASCII, so that punctuation and case don't tell words apart.
RAW = np.where(_SPACES, np.uint64(0), _VALUES)
PLAIN = _VALUES.copy()
PLAIN[65:91] = _VALUES[97:123]
for _b in range(128):
    if not chr(_b).isalnum():
        PLAIN[_b] = 0


class _Powers:
    """Powers of an odd base modulo 2**64 and their inverses, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, k, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, k, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = _Powers(_BASE), _Powers(0xD6E8FEB86659FD93)


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows of a text column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray, values: np.ndarray = RAW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, byte at which it starts, number of the first word of each text and of the end)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = (values != 0)[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, np.zeros(len(offsets), np.int64)
    up, down = _BYTE_POWERS.upto(len(data))
    hashes = mixed(np.add.reduceat(values[data] * up, starts) * down[starts])
    return hashes, starts, np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` words from each word on; of the last words too, where what follows is missing or another text's."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(_WORD_POWERS.base)
        out += words[k : k + n]
    return mixed(out)


def windows(words: np.ndarray, size: int, sums: np.ndarray | None = None) -> np.ndarray:
    """Karp-Rabin hashes of all windows of ``size`` words, from running sums."""
    if sums is None:
        sums = running(words)
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return (sums[size : size + n] - sums[:n]) * _WORD_POWERS.upto(len(words))[1][:n]


def running(words: np.ndarray) -> np.ndarray:
    """Sums that :func:`windows` takes its hashes of any size from."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _WORD_POWERS.upto(len(words))[0], out=sums[1:])
    return sums
