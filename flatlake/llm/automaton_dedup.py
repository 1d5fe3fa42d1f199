"""Substring dedup over words with suffix automata of reference shards.

The reference of a document is every document of smaller id.  Reference text is
cut to the regions that some other document may share (see ``anchored``), dealt
into shards, and one suffix automaton is built per shard.  Instead of sending
every automaton to every task, which grows with the corpus, the slices of the
documents that can match a shard travel to it and are streamed through its
automaton for their matching statistics.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchored import Windows, dedup_windows
from .textkit import gather_ranges

SCHEMA = "_given bigint, n_words bigint, n_removed bigint, kept string"
ARROW = pa.schema([("_given", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
#: Words of regions per suffix automaton.
SHARD = 1 << 16


class SuffixAutomaton:
    """Generalised suffix automaton; each state keeps the first (smallest) document it occurs in.

    Texts must be added in order of their document, so a state's first
    document is the one that made it, or that of the state it was split from.
    """

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]

    def _state(self, length: int, moves: dict, first: int) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for the strings of q reached from p and its suffixes."""
        moves, link, length = self.next, self.link, self.length
        clone = self._state(length[p] + 1, dict(moves[q]), self.first[q])
        link[clone] = link[q]
        link[q] = clone
        while p != -1 and moves[p].get(c) == q:
            moves[p][c] = clone
            p = link[p]
        return clone

    def add(self, text: list, document: int) -> None:
        moves, link, length = self.next, self.link, self.length
        last = 0
        for c in text:
            q = moves[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            new = self._state(length[last] + 1, {}, document)
            p = last
            while p != -1 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p != -1:
                q = moves[p][c]
                link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = new

    def first_documents(self, text: list, window: int):
        """Matching statistics of *text*: (end, first document) of each match of *window* words."""
        moves, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        for end, c in enumerate(text, 1):
            while state and c not in moves[state]:
                state = link[state]
                matched = length[state]
            if c not in moves[state]:
                continue
            state = moves[state][c]
            matched += 1
            if matched >= window:
                while length[link[state]] >= window:
                    state = link[state]
                    matched = length[state]
                yield end, first[state]


def shared_with_earlier(window: int):
    """Matcher: windows of a shard that also start in a document of smaller id."""

    def match(tokens, size, many, ids, starts):
        text = np.unique(tokens, return_inverse=True)[1].tolist()
        at = np.cumsum(size)
        lo, hi, doc = (at - size).tolist(), at.tolist(), ids.tolist()
        automaton = SuffixAutomaton()
        for i in np.argsort(ids, kind="stable").tolist():
            automaton.add(text[lo[i] : hi[i]], doc[i])
        region, offset = [], []
        for i in range(len(doc)):
            for end, first in automaton.first_documents(text[lo[i] : hi[i]], window):
                if first < doc[i]:
                    region.append(i)
                    offset.append(end - window)
        return np.array(region, np.int64), np.array(offset, np.int64)

    return match


def _finish(rows, lo, hi, offsets, bounds, gone):
    data, starts, ends = bounds
    counts = np.concatenate([[0], np.cumsum(gone)])
    removed = counts[offsets[1:]] - counts[offsets[:-1]]
    kept = ~gone
    size = (ends - starts)[kept] + 1
    text = np.append(data, np.uint8(32))[gather_ranges(starts[kept], size)]
    text[np.cumsum(size) - 1] = 32
    # the blank after a row's last word is dropped
    row = np.repeat(np.arange(hi - lo), np.diff(offsets))[kept]
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.zeros(0, bool)
    drop = np.zeros(len(text), bool)
    drop[(np.cumsum(size) - 1)[last]] = True
    per_row = np.bincount(row, weights=size - last, minlength=hi - lo).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
    n = hi - lo
    kept_text = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(text[~drop].tobytes())])
    return pa.table({"_given": rows.given.column("_given").slice(lo, n).combine_chunks(), "n_words": np.diff(offsets), "n_removed": removed, "kept": kept_text}, schema=ARROW)


def dedup_word_windows(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a *window*-word sequence that also starts in a document of smaller id.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; windows are judged on the
    input.  Result: ``id_col``, ``n_words``, ``n_removed``, ``kept`` (the kept
    words joined by one space).

    Defined cases: a null text has no words; texts shorter than *window* stay
    whole; repeats inside one document stay; a null id counts as the largest;
    rows that share an id are one document (they never remove each other's
    words); an empty table gives an empty result; other columns are ignored.
    Words are compared by 64-bit hashes, windows by at least 128 bits of them.
    """
    gram = min(5, window)
    out = dedup_windows(docs, id_col, text_col, Windows(window, gram, True, False), shared_with_earlier(window), SHARD, _finish, SCHEMA, ARROW)
    return out.withColumnRenamed("_given", id_col)


def op5_suffix_automaton_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_word_windows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
