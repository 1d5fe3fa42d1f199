"""Vectorised text helpers used inside Arrow tasks.

Texts are handled as one UTF-8 byte buffer with document offsets, taken
straight from Arrow's string layout, so no Python string is made per row.
Words are maximal runs of bytes outside ``0x20, 0x09-0x0D`` (ASCII white space
never occurs inside a multi-byte UTF-8 character).

Hashes of segments are differences of prefix sums of ``value[j] * BASE**j``
modulo 2**64, scaled back by the inverse power and mixed; two independent
tables give 128 bits where an identity depends on it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.RandomState(20240611)


def _table(n: int) -> np.ndarray:
    return (_RNG.randint(0, 1 << 32, n, dtype=np.uint64) << U(32)) | _RNG.randint(0, 1 << 32, n, dtype=np.uint64)


#: Two independent random values per byte.
BYTE_VALUES = (_table(256), _table(256))
#: Odd bases and their inverses modulo 2**64.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
INVERSES = tuple(pow(b, -1, 1 << 64) for b in BASES)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        have = np.full(size, base, U)
        have[0] = 1
        have = np.multiply.accumulate(have)
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Prefix:
    """Hashes of arbitrary ranges of one value array."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.base, self.inverse = BASES[which], INVERSES[which]
        n = len(values)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * powers(self.base, n), out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        back = powers(self.inverse, len(self.sums))
        return mix((self.sums[end] - self.sums[start]) * back[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every range of *k* values."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, U)
        return mix((self.sums[k:] - self.sums[:-k]) * powers(self.inverse, n))


def buffer_of(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets (n + 1) of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int):
    """Row ranges whose bytes stay under *limit* (a longer row is a piece of its own)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in *data*, and the first word of each row (n + 1)."""
    space = IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = ~space
    begin[1:] &= space[:-1] | edge[1 : len(data)]
    stop = ~space
    stop[:-1] &= space[1:] | edge[1 : len(data)]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    return Prefix(BYTE_VALUES[which][data], which).ranges(starts, ends)


def gather_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the given ranges, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)
