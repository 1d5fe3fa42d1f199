"""Suffix arrays by induced sorting, and permuted common prefixes.

The text level works on whole buckets at a time: suffixes of one leading byte
are induced from the bucket before as one array operation (a stable split by
the preceding byte), so a pass costs a few array operations per byte value and
run length, and time linear in the text.  Names of leftmost-smaller substrings
form the reduced text, which is sorted by the same steps recursively; its
alphabet is large, so there the induction moves one suffix at a time.
"""

from __future__ import annotations

import numpy as np

from .textkit import BYTE_VALUES, Prefix, mix


def smaller_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the closing sentinel counts as smaller)."""
    n = len(t)
    up = t[:-1] < t[1:]
    differs = np.flatnonzero(t[:-1] != t[1:])
    # each position takes the direction of the next differing pair at or after it
    at = np.searchsorted(differs, np.arange(n - 1))
    out = np.ones(n, bool)
    inside = at < len(differs)
    out[:-1][inside] = up[differs[at[inside]]]
    out[:-1][~inside] = False
    return out


def _leftmost(small: np.ndarray) -> np.ndarray:
    flag = np.zeros(len(small), bool)
    flag[1:] = small[1:] & ~small[:-1]
    return flag


def _split(chars: np.ndarray, items: np.ndarray, into: list) -> None:
    order = np.argsort(chars, kind="stable")
    chars, items = chars[order], items[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    lo = 0
    for hi in [*cuts.tolist(), len(chars)]:
        into[chars[lo]].append(items[lo:hi])
        lo = hi


def _induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, k: int) -> np.ndarray:
    """Suffix array of *t* (uint16, ends with its only 0) from sorted leftmost-smaller suffixes."""
    larger: list = [[] for _ in range(k)]
    smaller: list = [[] for _ in range(k)]
    seeded: list = [[] for _ in range(k)]
    _split(t[seeds], seeds, seeded)
    empty = np.zeros(0, np.int32)

    def before(batch, want_small):
        p = batch[batch > 0] - 1
        return p[small[p] == want_small]

    whole: list = [empty] * k
    for c in range(k):
        done = []
        while larger[c]:
            batch = np.concatenate(larger[c])
            larger[c] = []
            done.append(batch)
            p = before(batch, False)
            if len(p):
                _split(t[p], p, larger)
        if done:
            whole[c] = np.concatenate(done)
        if seeded[c]:
            p = before(np.concatenate(seeded[c]), False)
            if len(p):
                _split(t[p], p, larger)
    out: list = [empty] * (2 * k)
    smaller[0].append(np.array([len(t) - 1], np.int32))
    for c in range(k - 1, -1, -1):
        done = []
        while smaller[c]:
            batch = np.concatenate(smaller[c])
            smaller[c] = []
            done.append(batch)
            p = before(batch, True)
            if len(p):
                _split(t[p], p, smaller)
        if len(whole[c]):
            p = before(whole[c][::-1], True)
            if len(p):
                _split(t[p], p, smaller)
        out[2 * c] = whole[c]
        if done:
            out[2 * c + 1] = np.concatenate(done)[::-1]
    return np.concatenate(out)


def _induce_names(s: list, small: list, seeds: list, k: int) -> list:
    """The same for a text of names, one suffix at a time."""
    n = len(s)
    counts = np.bincount(np.asarray(s), minlength=k)
    ends = np.cumsum(counts)
    heads, tails = (ends - counts).tolist(), ends.tolist()
    sa = [-1] * n
    tail = tails.copy()
    for j in reversed(seeds):
        c = s[j]
        tail[c] -= 1
        sa[tail[c]] = j
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not small[j]:
            c = s[j]
            sa[heads[c]] = j
            heads[c] += 1
    tail = tails
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and small[j]:
            c = s[j]
            tail[c] -= 1
            sa[tail[c]] = j
    sa[0] = n - 1
    return sa


def _named(pos: np.ndarray, hashes: np.ndarray, length: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, int]:
    """Names (in text order) of substrings whose sorted order is given; equal ones share a name."""
    new = np.ones(len(order), bool)
    h, size = hashes[order], length[order]
    new[1:] = (h[1:] != h[:-1]) | (size[1:] != size[:-1])
    rank = np.cumsum(new) - 1
    names = np.empty(len(order), np.int64)
    names[order] = rank
    return names, int(rank[-1]) + 1


def _sort(t: np.ndarray, k: int, values: np.ndarray, induce) -> np.ndarray:
    """Both levels: *t* ends with its only 0; *values* are random words per symbol for substring identity."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    small = smaller_types(t)
    pos = np.flatnonzero(_leftmost(small)).astype(np.int32)
    sa = induce(t, small, pos, k)
    order = sa[_leftmost(small)[sa]]
    index = np.zeros(n, np.int32)
    index[pos] = np.arange(len(pos), dtype=np.int32)
    end = np.append(pos[1:], pos[-1]) + 1
    prefix = Prefix(values)
    names, m = _named(pos, prefix.ranges(pos, end), end - pos, index[order])
    if m < len(pos):
        inner = _sort(names, m, mix(names.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)), _scalar)
        order = pos[inner]
    return induce(t, small, order, k)


def _scalar(t, small, seeds, k):
    return np.asarray(_induce_names(t.tolist(), small.tolist(), seeds.tolist(), k), np.int32)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffix array of a byte array (the empty suffix is left out)."""
    if not len(data):
        return np.zeros(0, np.int32)
    t = np.zeros(len(data) + 1, np.uint16)
    t[:-1] = data
    t[:-1] += 1
    values = np.append(BYTE_VALUES[0][data], np.uint64(1))
    return _sort(t, 257, values, _induce)[1:]


def permuted_common_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text position: the suffix before it in sorted order (-1: none) and their common prefix, up to *most*."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([data, np.zeros(most + 16, np.uint8)])
    words = np.ndarray((n + most + 8,), "<u8", padded.tobytes(), strides=(1,))
    common = np.zeros(n, np.int64)
    alive = np.flatnonzero(before >= 0)
    done = 0
    while len(alive) and done < most:
        x = words[alive + done] ^ words[before[alive] + done]
        same = x == 0
        rest = x[~same]
        low = rest & (~rest + np.uint64(1))  # lowest differing bit, in the first differing byte
        common[alive[~same]] = done + (np.frexp(low.astype(np.float64))[1] - 1) // 8
        alive = alive[same]
        done += 8
    common[alive] = most
    reach = np.minimum(n - np.arange(n), np.where(before >= 0, n - before, 0))
    return before, np.minimum(np.minimum(common, reach), most)
