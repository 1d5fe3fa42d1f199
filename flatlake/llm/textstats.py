"""Per-document text statistics as array operations on Arrow batches."""

from __future__ import annotations

import numpy as np

from .textkit import IS_SPACE, U, Prefix, mix, word_hashes, words, BYTE_VALUES


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[np.frombuffer(chars.encode(), np.uint8)] = 1
    return out


SYMBOLS = _flags("#*$%&|<>")
#: One per byte that begins a character.
BEGINS = np.ones(256, np.int64)
BEGINS[0x80:0xC0] = 0


def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def distinct_per_row(hashes: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    key = mix(hashes + row.astype(U) * U(0x9E3779B97F4A7C15))
    first = np.unique(key, return_index=True)[1]
    return np.bincount(row[first], minlength=n)


def repeated_words(hashes: np.ndarray, first: np.ndarray, window: int) -> np.ndarray:
    """Per row: words inside *window*-word sequences that the row holds twice or more, first one included."""
    n = len(first) - 1
    grams = Prefix(mix(hashes), 1).grams(window)
    size = np.maximum(np.diff(first) - window + 1, 0)
    if not size.sum():
        return np.zeros(n, np.int64)
    row = np.repeat(np.arange(n), size)
    at = np.arange(len(row)) + np.repeat(first[:-1] - (np.cumsum(size) - size), size)
    key = mix(grams[at] + row.astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    key = key[order]
    same = key[1:] == key[:-1]
    twice = np.zeros(len(key), bool)
    twice[1:] |= same
    twice[:-1] |= same
    found = at[order[twice]]
    edge = np.zeros(int(first[-1]) + 1, np.int32)
    np.add.at(edge, found, 1)
    np.add.at(edge, found + window, -1)
    return per_row(np.cumsum(edge[:-1]) > 0, first)


class Stats:
    """Words, lines and counts of a piece of rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self.starts, self.ends, self.first = words(data, offsets)
        self.hashes = word_hashes(data, self.starts, self.ends)
        self.row = np.repeat(np.arange(self.n), np.diff(self.first))
        self.n_words = np.diff(self.first)

    def count(self, flags: np.ndarray) -> np.ndarray:
        return per_row(flags[self.data], self.offsets)

    def word_chars(self) -> np.ndarray:
        return per_row(BEGINS[self.data] * ~IS_SPACE[self.data], self.offsets)

    def duplicate_lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Per row: lines with a word, and those equal to an earlier line."""
        cut = np.flatnonzero(self.data == 10)
        filled = self.offsets[:-1][np.diff(self.offsets) > 0]
        begin = np.unique(np.concatenate([filled, cut + 1]))
        begin = begin[begin < len(self.data)]
        row = np.searchsorted(self.offsets, begin, side="right") - 1
        at = np.searchsorted(cut, begin)
        end = np.append(cut, len(self.data))[at]
        end = np.minimum(end, self.offsets[row + 1])
        real = np.searchsorted(self.starts, end) > np.searchsorted(self.starts, begin)
        begin, end, row = begin[real], end[real], row[real]
        lines = np.bincount(row, minlength=self.n)
        h = Prefix(BYTE_VALUES[1][self.data], 1).ranges(begin, end)
        return lines, lines - distinct_per_row(h, row, self.n)
