"""Byte-level BPE as a streaming transducer with a lookahead computed from the merge list.

**Encoding.**  A text arrives in pieces of any size.  Special strings cut it,
the pre-token pattern cuts the rest, and every pre-token is merged pair by pair
(lowest rank first, then leftmost).  What could still change with later
characters is held back: at most the length of a special string and three characters besides an
open pre-token, and of an open pre-token longer than ``OPEN`` characters only its last
``window`` bytes.  A token of such a run is emitted once ``lookahead`` bytes
behind it are known; no further byte can change it.

**Sufficient lookahead.**  A token w stands in the final segmentation unless a
part on its right edge merges with its right neighbour before w is complete.
The right edge of ``w = x + y`` consists of y, the right part of y and so on
down to a byte; the part p lives from its own rank until the rank at which the
next larger part takes it up.  Only a merge (p, z) with a rank in that span can
disturb it, and whether z is there at that rank is settled by z's own bytes and
those that decide whether z was complete by then and not taken up before::

    reach(w, q) = max of  len(z) + reach(z, r)  over all merges (p, z) of rank r,
                  p on the right edge of w and r in the span of p, below q

Ranks fall strictly along such a chain, so one pass over the merges in rank
order computes it, and the largest reach of any token over all ranks bounds how far
behind a token bytes can matter.
``reach`` is a number of the merge list alone; texts never change it.

**Decoding.**  Token bytes go through a byte-to-text state machine that holds
back at most the three bytes of an unfinished character; bytes that are no
UTF-8 become U+FFFD, one for each maximal broken part.
"""

from __future__ import annotations

import codecs
import heapq
import json
from array import array
from bisect import bisect_left, bisect_right
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the byte-level pre-token pattern.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: How a long pre-token goes on, by the class of its last character.
RUNS = {"letter": r"\p{L}*", "number": r"\p{N}*", "space": r"\s*", "other": r"[^\s\p{L}\p{N}]*"}
#: Characters after which a pre-token is treated as a run of unknown length.
OPEN = 4096
#: Characters of one step of a text, and ids of one step of decoding.
STEP = 1 << 16
#: Bytes of the texts that are encoded together.
SLICE = 1 << 22
#: Words merged together at a time.
TOGETHER = 1 << 14
#: Pre-tokens kept with their ids (of at most KEEP_CHARS characters); the table starts anew when it is full.
KEEP, KEEP_CHARS = 1 << 18, 64


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: visible Latin-1 characters stand for themselves, others follow U+0100."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


class Merges:
    """Vocabulary and ranked merges of a byte-level BPE, with its sufficient lookahead."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        alphabet = byte_alphabet()
        vocab = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in data.get("added_tokens", ())}
        size = 1 + max(max(vocab.values()), *self.specials.values(), 0)
        self.size = size
        self.bytes: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        for token, i in self.specials.items():
            self.bytes[i] = token.encode()
        self.of_byte = [0] * 256
        for c, b in alphabet.items():
            self.of_byte[b] = vocab[c]
        #: left id * size + right id -> rank; the id that each rank makes
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for r, pair in enumerate(model["merges"]):
            x, y = pair if not isinstance(pair, str) else pair.split(" ")
            self.rank[vocab[x] * size + vocab[y]] = r
            self.made.append(vocab[x + y])
        keys = np.array(sorted(self.rank), np.int64)
        self.arrays = keys, np.array([self.rank[k] for k in keys.tolist()], np.int64), np.array(self.made, np.int64), np.array(self.of_byte, np.int64)
        self.lookahead = self._lookahead()
        self.longest = max(map(len, self.bytes))
        self.window = self.lookahead + max(512, 2 * self.longest)

    def _lookahead(self) -> int:
        reach = dict.fromkeys(self.of_byte, 0)
        right: dict[int, tuple[int, int]] = {}  # id -> right part and rank of its merge
        ranks: dict[int, list[int]] = {}  # id -> ranks of the merges with it on the left,
        most: dict[int, list[int]] = {}  # and the most bytes that decide any of them up to each

        def disturbed(edge: int, until: int) -> int:
            known = bisect_left(ranks.get(edge, ()), until)
            return most[edge][known] if known else 0

        for key, r in self.rank.items():
            a, b = divmod(key, self.size)
            c = self.made[r]
            if c not in reach:
                right[c] = b, r
                best, w = 0, c
                while w in right:
                    w, until = right[w]
                    best = max(best, disturbed(w, until))
                reach[c] = best
            ranks.setdefault(a, []).append(r)
            so_far = most.setdefault(a, [0])
            so_far.append(max(so_far[-1], len(self.bytes[b]) + max(reach[b], disturbed(b, r))))
        return max(max(n, disturbed(w, len(self.made))) for w, n in reach.items())

    def merged(self, data: bytes) -> list[int]:
        """Ids of *data*: the lowest rank merges first, the leftmost among equals."""
        ids = [self.of_byte[b] for b in data]
        n, size, rank = len(ids), self.size, self.rank
        if n < 2:
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[k], i, k) for i in range(n - 1) if (k := ids[i] * size + ids[i + 1]) in rank]
        heapq.heapify(heap)
        while heap:
            r, i, k = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ids[i] * size + ids[j] != k:
                continue  # one of the two has merged meanwhile
            ids[i], ids[j] = self.made[r], -1
            after[i] = m = after[j]
            if m < n:
                before[m] = i
                if (k := ids[i] * size + ids[m]) in rank:
                    heapq.heappush(heap, (rank[k], i, k))
            if (h := before[i]) >= 0 and (k := ids[h] * size + ids[i]) in rank:
                heapq.heappush(heap, (rank[k], h, k))
        return [t for t in ids if t >= 0]

    def together(self, words: list[bytes]) -> list[bytes]:
        """``merged`` of many short words, packed; one merge of every word at a time over arrays."""
        lengths = np.array([len(w) for w in words], np.int64)
        out = [b""] * len(words)
        order = np.argsort(lengths, kind="stable")
        begin = int(np.searchsorted(lengths[order], 1))
        while begin < len(order):
            # words of similar length share a matrix
            width = max(4, int(lengths[order[begin]]) * 3 // 2)
            end = min(begin + TOGETHER, int(np.searchsorted(lengths[order], width, side="right")))
            for i, ids in zip(order[begin:end].tolist(), self._matrix([words[i] for i in order[begin:end]], width)):
                out[i] = ids
            begin = end
        return out

    def _matrix(self, words: list[bytes], width: int) -> list[bytes]:
        keys, ranks_of, made, first = self.arrays
        none = len(made)
        n = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        place = np.arange(width)
        ids = np.where(place < n[:, None], first[raw], -1)

        def rank(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            key = x * self.size + y
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            return np.where((keys[at] == key) & (x >= 0) & (y >= 0), ranks_of[at], none)

        ranks = np.concatenate([rank(ids[:, :-1], ids[:, 1:]), np.full((len(words), 1), none)], axis=1)
        done = [b""] * len(words)
        row = np.arange(len(words))
        while len(row):
            at = ranks.argmin(axis=1)
            here = np.arange(len(row))
            least = ranks[here, at]
            open_ = least < none
            flat = ids[~open_].astype(np.int32).tobytes()
            for j, (i, k) in enumerate(zip(row[~open_].tolist(), n[~open_].tolist())):
                done[i] = flat[4 * width * j : 4 * (width * j + k)]
            row, n, ids, ranks, at, least = row[open_], n[open_] - 1, ids[open_], ranks[open_], at[open_], least[open_]
            here = np.arange(len(row))
            # the merged id takes the left place, everything behind moves up by one
            move = np.minimum(place + (place > at[:, None]), width - 1)
            ids, gone = np.take_along_axis(ids, move, axis=1), np.minimum(place + (place >= at[:, None]), width - 1)
            ids[here, at] = made[least]
            ids[here, n] = -1
            ranks = np.take_along_axis(ranks, gone, axis=1)
            after = np.minimum(at + 1, width - 1)
            ranks[here, at] = np.where(at + 1 < n, rank(ids[here, at], ids[here, after]), none)
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = rank(ids[left, at[left] - 1], ids[left, at[left]])
        return done

    def stable(self, tail: bytearray, out: bytearray) -> None:
        """Move the settled tokens at the start of *tail* to *out* until less than a window is left."""
        while len(tail) >= self.window:
            ids = self.merged(bytes(tail[: self.window]))
            ends = list(accumulate(len(self.bytes[t]) for t in ids))
            settled = bisect_right(ends, self.window - self.lookahead)
            out += packed(ids[:settled])
            del tail[: ends[settled - 1]]

    def whole(self, data: bytes) -> bytes:
        """Packed ids of one pre-token of any length, window by window."""
        out, tail = bytearray(), bytearray(data)
        self.stable(tail, out)
        return bytes(out) + packed(self.merged(bytes(tail)))


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers one after the other, as they go into Arrow."""
    return array("i", ids).tobytes()


class Kept(dict):
    """Pre-token -> packed ids, bounded."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> bytes:
        ids = self.merges.whole(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= KEEP_CHARS:
            if len(self) >= KEEP:
                self.clear()
            self[piece] = ids
        return ids

    def meet(self, pieces) -> None:
        """Take in what is new among *pieces*, all at once."""
        pieces = set(pieces)
        new = [p for p in pieces.difference(self) if len(p) <= KEEP_CHARS]
        if len(self) + len(new) > KEEP:
            self.clear()
            new = [p for p in pieces if len(p) <= KEEP_CHARS][:KEEP]
        self.update(zip(new, self.merges.together([p.encode("utf-8", "surrogatepass") for p in new])))


class Encoder:
    """One text in pieces: ``feed`` returns the ids that are settled, ``finish`` the rest (arrays of 32-bit integers)."""

    pattern = regex.compile(PRE_TOKEN)
    runs = {k: regex.compile(v) for k, v in RUNS.items()}

    def __init__(self, merges: Merges, kept: Kept | None = None, specials: bool = True):
        self.merges, self.kept = merges, kept if kept is not None else Kept(merges)
        names = sorted(merges.specials, key=len, reverse=True) if specials else []
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        # a blank before a special string that is not whole yet: two characters more
        self.hold = 3 + max([0, *map(len, names)])
        self.reset()

    def reset(self) -> None:
        self.held, self.open, self.tail = "", None, bytearray()

    def feed(self, text: str) -> np.ndarray:
        return np.frombuffer(self._step(text, False), np.int32)

    def finish(self) -> np.ndarray:
        out = self._step("", True)
        self.reset()
        return np.frombuffer(out, np.int32)

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([*(self.feed(text[i : i + STEP]) for i in range(0, len(text), STEP)), self.finish()])

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of many texts; new pre-tokens of all of them are merged together."""
        plain = [len(t) <= STEP and not (self.special and self.special.search(t)) for t in texts]
        cut = [self.pattern.findall(t) if p else None for t, p in zip(texts, plain)]
        self.kept.meet(chain.from_iterable(c for c in cut if c))
        ids_of = self.kept.__getitem__
        return [self.encode(t) if c is None else np.frombuffer(b"".join(map(ids_of, c)), np.int32) for t, c in zip(texts, cut)]

    def _step(self, text: str, last: bool) -> bytearray:
        buffer, out = self.held + text, bytearray()
        while self.special and (found := self.special.search(buffer)):
            self._segment(buffer[: found.start()], True, out)
            out += packed([self.merges.specials[found.group()]])
            buffer = buffer[found.end() :]
        self.held = self._segment(buffer, last, out)
        return out

    def _segment(self, buffer: str, last: bool, out: bytearray) -> str:
        """Emit what is settled of *buffer*; returns the characters that are not."""
        if self.open:
            used = self.runs[self.open].match(buffer).end()
            ended = last or used < len(buffer)
            if not ended:
                used = max(0, len(buffer) - self.hold)
            elif used < len(buffer) and self.open == "space":
                used -= 1  # the last blank belongs to what follows
            self.tail += buffer[:used].encode("utf-8", "surrogatepass")
            self.merges.stable(self.tail, out)
            buffer = buffer[used:]
            if not ended:
                return buffer
            out += packed(self.merges.merged(bytes(self.tail)))
            self.open, self.tail = None, bytearray()
        pieces = self.pattern.findall(buffer)
        rest, piece = 0, ""
        if not last:
            while pieces and rest < self.hold:
                piece = pieces.pop()
                rest += len(piece)
        out += b"".join(map(self.kept.__getitem__, pieces))
        held = buffer[len(buffer) - rest :]
        if len(piece) <= OPEN:
            return held
        kind = next(k for k, p in (("letter", r"\p{L}"), ("number", r"\p{N}"), ("space", r"\s"), ("other", r"(?s).")) if regex.match(p, piece[-1]))
        self.open, self.tail = kind, bytearray(held[0].encode("utf-8", "surrogatepass"))
        return self._segment(held[1:], False, out)


class Decoder:
    """Ids in pieces to text in pieces; an unfinished character waits for its bytes."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids, last: bool = False) -> str:
        return self.machine.decode(b"".join(map(self.merges.bytes.__getitem__, ids)), last)

    def decode(self, ids) -> str:
        if len(ids) <= STEP:
            return self.feed(ids, True)
        parts = [self.feed(ids[i : i + STEP]) for i in range(0, len(ids), STEP)]
        return "".join(parts) + self.feed([], True)


_LOADED: dict[int, tuple[Merges, Kept]] = {}


def loaded(spec: str) -> tuple[Merges, Kept]:
    """Tables of a tokenizer file's text, made once in a Python process."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        merges = Merges(spec)
        _LOADED[key] = merges, Kept(merges)
    return _LOADED[key]


def tokenizer_text(path: str | None = None) -> str:
    """The tokenizer file, read on the driver (about a megabyte, sent to the tasks as a broadcast)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def rows_of(batch: pa.RecordBatch, column: int, limit: int = 1 << 24):
    """Slices of *batch* whose values of *column* hold about *limit* bytes at most; a longer row is a slice of its own."""
    n = batch.num_rows
    whole = batch.column(column).nbytes
    step = n if whole <= limit else max(1, n * limit // whole)
    for i in range(0, n, step):
        yield batch.slice(i, step)


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", specials: bool = True) -> DataFrame:
    """``(id_col, ids array<int>)`` for every row of *docs*.

    *path* names a byte-level BPE in the tokenizers library's JSON; its special
    strings inside texts become their ids, or stay plain text with
    ``specials=False``.  Defined cases: a null text counts as empty and has no
    ids; a null id stays null; rows are encoded one by one, repeated or not; a
    text or pre-token of any length is streamed; an empty table gives an empty
    result; other columns are ignored.
    """
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_text(path))

    def run(batches):
        merges, kept = loaded(spec.value)
        encoder = Encoder(merges, kept, specials)
        for batch in batches:
            for part in rows_of(batch, 1, SLICE):
                lists = encoder.encode_all([t or "" for t in part.column(1).to_pylist()])
                offsets = np.zeros(len(lists) + 1, np.int32)
                np.cumsum([len(x) for x in lists], out=offsets[1:])
                flat = np.concatenate(lists) if lists else np.zeros(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, ids array<int>").withColumnRenamed("doc_id", id_col)


def decoded(tokens: DataFrame, path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, ids, text)`` for every row of *tokens*; null ids give an empty text, special ids their strings.

    Ids outside the vocabulary, and null elements, raise ``ValueError``.
    """
    spec = tokens.sparkSession.sparkContext.broadcast(tokenizer_text(path))

    def run(batches):
        merges, _ = loaded(spec.value)
        for batch in batches:
            for part in rows_of(batch, 1):
                lists = part.column(1)
                flat = lists.flatten()
                ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                values = flat.to_numpy(zero_copy_only=False)
                if flat.null_count or len(values) and (values.min() < 0 or values.max() >= merges.size):
                    raise ValueError("a token id is not in the vocabulary")
                texts = [Decoder(merges).decode(ids.tolist()) for ids in np.split(values, ends[:-1])] if len(ends) else []
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    narrow = tokens.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return narrow.mapInArrow(run, "doc_id bigint, ids array<int>, text string").withColumnsRenamed({"doc_id": id_col, "ids": ids_col})


def op13_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decoded(encoded(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    ids = F.coalesce("ids", F.array().cast("array<int>"))
    return out.select(
        "doc_id",
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
