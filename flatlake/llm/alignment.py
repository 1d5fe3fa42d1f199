"""Alignment of two tokenizers over a corpus: byte-aligned groups, links, and how many documents hold each linked pair.

**Groups.**  Both tokenizers cut the same bytes.  Where tokens of both end, a
group ends; within a group every A token is linked to every B token.

**Identity map.**  ``same[a]`` is the id of B's piece with the bytes of A's
entry (or none).  A group of one A and one B token that the map pairs is
regular: per document it is just the id a, and over the corpus it is counted in
a vector of A's vocabulary length.  All other groups are irregular; their
distinct pairs, with the number of links each stands for, are formed from the
distinct ids of a group (never all occurrence pairs) and only they enter the
shuffle of pairs.  A pair (a, same[a]) met inside an irregular group goes to
the vector like the others, so every pair is counted in one place.

**Counts back to documents.**  The vector, the best count of each A id (both of
vocabulary length) and the counts of the most frequent pairs (at most
SENT_PAIRS) are sent to the tasks.  The other pairs are joined by a shuffle; as
all frequent ones are gone, none of them repeats in more than a small share of
the documents.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_stream import Encoder, loaded, packed, rows_of, tokenizer_text
from .linking import written
from .textkit import gather_ranges

#: Pair counts sent to the tasks at most (16 bytes each).
SENT_PAIRS = 1 << 18
#: Pairs held in a task before they are folded, and pairs formed at a time.
FOLD = 1 << 21
#: Bytes of text handled at a time; segments kept with their ids, of at most KEEP_CHARS characters.
SLICE, KEEP, KEEP_CHARS = 1 << 21, 1 << 18, 64

_SEGMENT = re.compile(" +[^ ]*")
_BYTE = re.compile("<0x([0-9A-F]{2})>")
#: The character that stands for a space in pieces (fixed value).
MARK = "▁"


class Pieces:
    """A SentencePiece model that adds a space in front, encoding blank-separated segments once each.

    No piece holds the space mark behind another character, so no merge crosses
    the place where a blank follows another character, and segments that begin
    there are encoded on their own.  A model without this property, and a text
    with the mark itself, is encoded whole.
    """

    def __init__(self, proto: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        self.split = not any(MARK in name.lstrip(MARK) for name in names)
        byte = [_BYTE.fullmatch(name) if self.model.is_byte(i) else None for i, name in enumerate(names)]
        self.bytes = [bytes([int(m[1], 16)]) if m else name.replace(MARK, " ").encode() for m, name in zip(byte, names)]
        self.is_byte = [m is not None for m in byte]
        self.blank = self.model.piece_to_id(MARK)
        self.kept: dict[str, bytes] = {}

    def encode_all(self, spaced: list[str]) -> list[np.ndarray]:
        """Ids of texts that start with a blank (the one the model adds); new segments of all of them go to the model together."""
        cut = [_SEGMENT.findall(t) if self.split and MARK not in t else [t] for t in spaced]
        pieces = set(chain.from_iterable(cut))
        kept = self.kept
        new = list(pieces.difference(kept))
        if len(kept) + len(new) > KEEP:
            kept.clear()
            new = list(pieces)
        ids = self.model.encode([s[1:] for s in new], num_threads=1)
        if " " in pieces and " " not in kept:
            ids[new.index(" ")] = [self.blank]
        flat = packed(chain.from_iterable(ids))
        ends = np.cumsum([4 * len(x) for x in ids]).tolist()
        kept.update(zip(new, [flat[i:j] for i, j in zip([0, *ends], ends)]))
        out = [np.frombuffer(b"".join(map(kept.__getitem__, c)), np.int32) for c in cut]
        if len(new) > KEEP:
            kept.clear()
        else:
            for s in [s for s in new if len(s) > KEEP_CHARS]:
                del kept[s]
        return out


class Aligner:
    """Tables of both tokenizers and the identity map."""

    def __init__(self, spec: str, proto: bytes):
        merges, kept = loaded(spec)
        self.a, self.b = Encoder(merges, kept, specials=False), Pieces(proto)
        self.size_a, self.size_b = merges.size, len(self.b.bytes)
        self.length_a = np.array([len(x) for x in merges.bytes], np.int64)
        self.length_b = np.array([len(x) for x in self.b.bytes], np.int64)
        self.start_b = np.cumsum(self.length_b) - self.length_b
        self.bytes_b = np.frombuffer(b"".join(self.b.bytes), np.uint8)
        self.same = identity_map(merges.bytes, self.b.bytes, self.b.is_byte)
        self.text = [f"{i}{end}" for i in range(self.size_a) for end in (",", "|")] + [f"{i}{end}" for i in range(self.size_b) for end in (",", ";", "")]

    def tokens(self, texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for every text; none if B's bytes are not those of space + text (A's always are)."""
        spaced = [" " + t if t else "" for t in texts]
        b = self.b.encode_all(spaced)
        same = self.spelled(spaced, b)
        a = self.a.encode_all([t if ok else "" for t, ok in zip(spaced, same)])
        return [(x, y if ok else y[:0]) for x, y, ok in zip(a, b, same)]

    def spelled(self, spaced: list[str], b: list[np.ndarray]) -> list[bool]:
        """Whether the bytes of B's ids are those of the text; the bytes of all texts are gathered together."""
        ids = np.concatenate([np.zeros(0, np.int32), *b])
        lengths = self.length_b[ids]
        raw = self.bytes_b[gather_ranges(self.start_b[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, b)])].tolist()
        return [raw[i:j] == t.encode() for t, i, j in zip(spaced, ends, ends[1:])]


def identity_map(a: list[bytes], b: list[bytes], is_byte: list[bool]) -> np.ndarray:
    """A id -> id of B's piece with the same bytes, a plain piece before a byte piece; -1 where there is none."""
    ids: dict[bytes, int] = {}
    for i in sorted(range(len(b)), key=lambda i: is_byte[i]):
        ids.setdefault(b[i], i)
    return np.array([ids.get(x, -1) if x else -1 for x in a], np.int64)


_LOADED: dict[int, Aligner] = {}


def aligner(spec: str, proto: bytes) -> Aligner:
    key = hash((spec, proto))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(spec, proto)
    return _LOADED[key]


def folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with their summed counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], (np.add.reduceat(counts[order], first) if len(first) else counts[:0])


def group_of(ends: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Group of each token: the number of group ends before its own end."""
    closing = both[ends]
    return np.cumsum(closing) - closing


def crossed(ga, a, na, gb, b, nb, doc, size_a: int, size_b: int):
    """Per document the distinct pairs of all given groups with their links, FOLD pairs at a time.

    ``(ga, a, na)`` and ``(gb, b, nb)`` are distinct ids per group with their
    occurrences, sorted by group; *doc* is the document of each group.
    """
    last = int(max(ga[-1], 0)) + 1 if len(ga) else 0
    start_b = np.searchsorted(gb, np.arange(last + 1))
    width = (start_b[1:] - start_b[:-1])[ga]  # B ids that each A entry meets
    done = np.concatenate([[0], np.cumsum(width)])
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    i = 0
    while i < len(ga):
        j = min(len(ga), max(i + 1, int(np.searchsorted(done, done[i] + FOLD, side="right")) - 1))
        entry = np.repeat(np.arange(i, j), width[i:j])
        other = np.arange(done[j] - done[i]) - (done[entry] - done[i]) + start_b[ga[entry]]
        key = (doc[ga[entry]] * size_a + a[entry]) * size_b + b[other]
        keys, counts = folded(np.concatenate([keys, key]), np.concatenate([counts, na[entry] * nb[other]]))
        i = j
    return keys, counts


def lists(row: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """One list per row out of values sorted by row."""
    offsets = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "same_ids array<int>, same_links array<bigint>, pairs array<bigint>, pair_links array<bigint>"
)


def aligned_rows(t: Aligner, ids: pa.Array, texts: list) -> pa.RecordBatch:
    """One row per text, as ALIGNED."""
    n = len(texts)
    tokens = t.tokens(texts)
    sizes_a, sizes_b = (np.array([len(x[k]) for x in tokens], np.int64) for k in (0, 1))
    a, b = (np.concatenate([np.zeros(0, np.int32), *(x[k] for x in tokens)]).astype(np.int64) for k in (0, 1))
    row_a, row_b = np.repeat(np.arange(n), sizes_a), np.repeat(np.arange(n), sizes_b)
    ends_a, ends_b = np.cumsum(t.length_a[a]), np.cumsum(t.length_b[b])
    total = int(ends_a[-1]) if len(a) else 0
    both = np.zeros(total + 1, bool)
    both[ends_a] = True
    shared = np.zeros(total + 1, bool)
    shared[ends_b] = both[ends_b]
    ga, gb = group_of(ends_a, shared), group_of(ends_b, shared)
    groups = int(shared.sum())
    in_a, in_b = np.bincount(ga, minlength=groups), np.bincount(gb, minlength=groups)
    first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    doc = row_a[first_a] if groups else np.zeros(0, np.int64)
    regular = (in_a == 1) & (in_b == 1)
    regular[regular] = t.same[a[first_a[regular]]] == b[first_b[regular]]

    # irregular groups: distinct ids per group, then the pairs of each group
    odd_a, odd_b = np.flatnonzero(~regular[ga]) if groups else np.zeros(0, np.int64), np.flatnonzero(~regular[gb]) if groups else np.zeros(0, np.int64)
    one = np.ones(max(len(odd_a), len(odd_b)), np.int64)
    key_a, n_a = folded(ga[odd_a] * t.size_a + a[odd_a], one[: len(odd_a)])
    key_b, n_b = folded(gb[odd_b] * t.size_b + b[odd_b], one[: len(odd_b)])
    keys, links = crossed(key_a // t.size_a, key_a % t.size_a, n_a, key_b // t.size_b, key_b % t.size_b, n_b, doc, t.size_a, t.size_b)
    pair = keys % (t.size_a * t.size_b)
    plain = t.same[pair // t.size_b] == pair % t.size_b
    # pairs of the identity map, from regular groups and others
    same_keys = np.concatenate([doc[regular] * t.size_a + a[first_a[regular]], keys[plain] // t.size_b])
    same_keys, same_links = folded(same_keys, np.concatenate([np.ones(int(regular.sum()), np.int64), links[plain]]))
    keys, links = keys[~plain], links[~plain]
    per_pair = t.size_a * t.size_b

    # the groups as text: A ids, B ids, with the mark that follows each
    at_a = np.arange(len(a)) + first_b[ga] if groups else np.zeros(0, np.int64)
    at_b = np.arange(len(b)) + (first_a + in_a)[gb] if groups else np.zeros(0, np.int64)
    which = np.zeros(len(a) + len(b), np.int64)
    which[at_a] = 2 * a + shared[ends_a]
    closing = shared[ends_b].astype(np.int64)
    closing[np.cumsum(sizes_b)[sizes_b > 0] - 1] = 2
    which[at_b] = 2 * t.size_a + 3 * b + closing
    cuts = np.concatenate([[0], np.cumsum(sizes_a + sizes_b)])
    spelled = t.text.__getitem__
    said = ["".join(map(spelled, which[i:j].tolist())) for i, j in zip(cuts[:-1], cuts[1:])]
    columns = [
        ids, pa.array(sizes_a), pa.array(sizes_b), pa.array(np.bincount(doc, minlength=n)),
        pa.array(np.bincount(doc, weights=in_a * in_b, minlength=n).astype(np.int64)), pa.array(said, pa.string()),
        lists(same_keys // t.size_a, same_keys % t.size_a, n, pa.int32()), lists(same_keys // t.size_a, same_links, n, pa.int64()),
        lists(keys // per_pair, keys % per_pair, n, pa.int64()), lists(keys // per_pair, links, n, pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])


class Files:
    """Both tokenizer files, read on the driver and sent to the tasks (a few megabytes)."""

    def __init__(self, spark: SparkSession, bpe_path: str | None, piece_path: str | None):
        if piece_path is None:
            import public_tokenizers

            piece_path = public_tokenizers.path("piece_bpe_32k.model")
        with open(piece_path, "rb") as fh:
            proto = fh.read()
        here = Aligner(tokenizer_text(bpe_path), proto)
        self.size_a, self.size_b, self.same = here.size_a, here.size_b, here.same
        self.sent = spark.sparkContext.broadcast((tokenizer_text(bpe_path), proto))


def aligned(docs: DataFrame, files: Files, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups and distinct pairs of every row (columns of ALIGNED)."""
    sent = files.sent

    def run(batches):
        t = aligner(*sent.value)
        for batch in batches:
            for part in rows_of(batch, 1, SLICE):
                yield aligned_rows(t, part.column(0), part.column(1).to_pylist())

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, ALIGNED)


def vector_counts(table: DataFrame, size: int) -> np.ndarray:
    """Documents per A id that hold the pair (a, same[a]): a vector per task, then a sum of vectors."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["a", "n"])

    out = np.zeros(size, np.int64)
    for r in table.select("same_ids").mapInArrow(run, "a bigint, n bigint").groupBy("a").agg(F.sum("n").alias("n")).collect():
        out[r["a"]] = r["n"]
    return out


def pair_counts(table: DataFrame) -> DataFrame:
    """``(pair, n)``: documents that hold each irregular pair; folded in the task before the shuffle."""

    def run(batches):
        keys, counts, waiting, held = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def fold():
            new = np.concatenate([keys, *waiting])
            return folded(new, np.concatenate([counts, np.ones(held, np.int64)]))

        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            waiting.append(flat)
            held += len(flat)
            if held >= FOLD:
                keys, counts = fold()
                waiting, held = [], 0
                if len(keys) >= FOLD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])
                    keys, counts = keys[:0], counts[:0]
        keys, counts = fold()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["pair", "n"])

    return table.select("pairs").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, bound: int) -> int:
    """Least n such that at most *bound* pairs have it or more (from a histogram over steps of n)."""
    step = F.floor(8 * F.log2("n"))
    taken, least = 0, None
    for r in counts.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("many"), F.min("n").alias("least"), F.max("n").alias("most")).orderBy(F.desc("s")).collect():
        taken += r["many"]
        if taken > bound:
            return r["most"] + 1
        least = r["least"]
    return least or 1


SCORED = "rid bigint, n_best bigint, count_sum bigint, rest array<struct<pair:bigint,links:bigint>>"


def alignment(docs: DataFrame, bpe_path: str | None = None, piece_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row.

    Defined cases: null and empty texts, and texts that B does not keep byte by
    byte, have no tokens, zeros and an empty ``groups_sha256``; a null id stays
    null; every row is a document of its own, repeated ids or not; an empty
    table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    files = Files(spark, bpe_path, piece_path)
    size_a, size_b = files.size_a, files.size_b
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    rows = aligned(docs, files, id_col, text_col).withColumn("groups_sha256", digest).drop("groups")
    table = written(rows.withColumn("rid", F.monotonically_increasing_id()), "aligned")
    vector = vector_counts(table, size_a)
    counts = written(pair_counts(table), "pair-counts")
    best = vector.copy()
    for r in counts.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("n").alias("n")).collect():
        best[r["a"]] = max(best[r["a"]], r["n"])
    least = frequent(counts, sent_pairs)
    top = counts.filter(F.col("n") >= least).toArrow()
    order = np.argsort(top["pair"].to_numpy())
    sent = spark.sparkContext.broadcast((vector, best, top["pair"].to_numpy()[order], top["n"].to_numpy()[order]))

    def run(batches):
        vector, best, known, known_n = sent.value
        for batch in batches:
            n = batch.num_rows

            def flat(name):
                column = batch.column(batch.schema.get_field_index(name))
                return np.repeat(np.arange(n), column.value_lengths().to_numpy(zero_copy_only=False)), column.flatten().to_numpy(zero_copy_only=False)

            row, a = flat("same_ids")
            links, had = flat("same_links")[1], vector[a]
            row2, pair = flat("pairs")
            links2 = flat("pair_links")[1]
            at = np.minimum(np.searchsorted(known, pair), max(0, len(known) - 1))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            had2 = known_n[at[hit]] if len(known) else np.zeros(0, np.int64)
            a2 = pair[hit] // size_b
            good = np.zeros(n, np.int64)
            summed = np.zeros(n, np.int64)
            for r, which, n_links, n_docs in ((row, a, links, had), (row2[hit], a2, links2[hit], had2)):
                np.add.at(good, r, np.where(n_docs == best[which], n_links, 0))
                np.add.at(summed, r, n_links * n_docs)
            offsets = np.searchsorted(row2[~hit], np.arange(n + 1)).astype(np.int32)
            rest = pa.StructArray.from_arrays([pa.array(pair[~hit]), pa.array(links2[~hit])], names=["pair", "links"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("rid")), pa.array(good), pa.array(summed), pa.ListArray.from_arrays(pa.array(offsets), rest)],
                names=["rid", "n_best", "count_sum", "rest"],
            )

    heads = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    scored = written(table.select("rid", "same_ids", "same_links", "pairs", "pair_links").mapInArrow(run, SCORED), "scored-pairs")
    tops = spark.createDataFrame(pa.table({"a": np.arange(size_a), "best": best}))
    rare = counts.filter(F.col("n") < least).withColumn("a", F.expr(f"pair div {size_b}")).join(F.broadcast(tops), "a").select("pair", "n", (F.col("n") == F.col("best")).alias("top"))
    met = scored.select("rid", F.explode("rest").alias("r")).select("rid", "r.pair", "r.links").join(rare, "pair")
    more = met.groupBy("rid").agg(F.sum(F.when(F.col("top"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
    out = table.select("rid", *heads).join(scored.drop("rest"), "rid").join(more, "rid", "left")
    full = lambda c, m: (F.col(c) + F.coalesce(F.col(m), F.lit(0))).alias(c)
    return out.select(F.col("doc_id").alias(id_col), *heads[1:5], full("n_best", "more_best"), full("count_sum", "more_sum"), "groups_sha256")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(spark.read.parquet(f"{sf_dir}/documents.parquet"))
