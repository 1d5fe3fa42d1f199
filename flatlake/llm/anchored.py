"""Equal windows across a corpus: content-defined anchors, sharded exact matching, marks per document.

Used by the two substring operators.  A window is ``length`` consecutive
tokens (bytes or words) of one document.  Its anchor is the smallest hash among
its ``gram``-token pieces (leftmost on ties), so equal windows have equal
anchors at equal offsets; windows sharing an anchor occurrence form a region.

1. documents are dealt by a hash of their id into batches of a few MB;
2. each batch lists its regions as (anchor hash, region hash), identical
   regions folded to the first, and deals them by anchor to buckets;
3. a bucket drops anchors that occur once.  Identical regions are settled
   there: every one after the first is a repeat.  The first of each *different*
   region under a shared anchor asks its batch for the tokens;
4. batches answer with region tokens, and a matcher (suffix array or suffix
   automaton) decides window by window inside the anchor's shard;
5. marks return to the batches, which apply them to the whole documents.

Hot anchors (edges of a passage that a large share of documents hold) would
gather a region per document in one bucket.  A bounded sample names them; their
windows are dealt one by one under their own hash, where equal ones fold again.
The choice only routes rows: any set of hot anchors gives the same result.

Groups are bounded by batch and shard sizes; nothing is collected on the driver
but that bounded list, two sums and the batch count.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textkit import BYTE_VALUES, Prefix, U, buffer_of, gather_ranges, mix, pieces, word_hashes, words

#: Bytes of text per batch (more for very large inputs, so that the number of batches grows slower than the input).
BATCH_BYTES, BATCH_BYTES_MOST, BATCHES = 4 << 20, 64 << 20, 4000
#: Bytes of text per array step inside a task.
STEP = 1 << 20
#: Documents looked at for hot anchors, and the share of them that makes an anchor hot.
HOT_SAMPLE, HOT_SHARE = 8000, 0.004
LAST_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Windows:
    """What counts as a window, and which earlier ones count."""

    length: int
    gram: int
    by_words: bool
    own_document: bool  # does an earlier start in the same document count


class Rows:
    """One batch as arrays: rows in order of (id, text); rows that share an id follow one another."""

    def __init__(self, table: pa.Table):
        ids = table.column("_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        if len(ids) > 1 and (np.diff(ids[order]) == 0).any():
            order = np.array(table.select(["_id", "_text"]).to_pandas().fillna({"_text": ""}).sort_values(["_id", "_text"], kind="stable").index)
        table = table.take(pa.array(order))
        self.ids = ids[order]
        self.data, self.offsets = buffer_of(table.column("_text"))
        self.given = table

    def steps(self) -> Iterator[tuple[int, int]]:
        return pieces(self.offsets, STEP)


def tokens_of(rows: Rows, lo: int, hi: int, spec: Windows):
    """Token values (two kinds), token offsets per row of rows lo..hi, and word bounds if by words."""
    base, end = rows.offsets[lo], rows.offsets[hi]
    data, offsets = rows.data[base:end], rows.offsets[lo : hi + 1] - base
    if not spec.by_words:
        return BYTE_VALUES[0][data], BYTE_VALUES[1][data], offsets, None
    starts, ends, first = words(data, offsets)
    h = word_hashes(data, starts, ends)
    return h, mix(h ^ U(0xA5A5A5A55A5A5A5A)), first, (data, starts, ends)


def regions(v1: np.ndarray, v2: np.ndarray, offsets: np.ndarray, spec: Windows, hot: np.ndarray):
    """(anchor, region hash, row, first window start, number of windows) of every region; starts count from the array's begin."""
    n, length, k = len(v1), spec.length, spec.gram
    none = np.zeros(0, np.int64)
    if n < length or not (np.diff(offsets) >= length).any():
        return none.astype(U), none.astype(U), none, none, none
    p1, p2 = Prefix(v1, 0), Prefix(v2, 1)
    grams = p1.grams(k)
    low = U((1 << int(n).bit_length()) - 1)
    least = (grams & ~low) | np.arange(len(grams), dtype=U)
    width, span = length - k + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    at = (least & low).astype(np.int64)
    long_rows = np.flatnonzero(np.diff(offsets) >= length)
    edge = np.zeros(len(at) + 1, np.int32)
    np.add.at(edge, offsets[long_rows], 1)
    np.add.at(edge, offsets[long_rows + 1] - length + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    change = valid.copy()
    change[1:] &= (at[1:] != at[:-1]) | ~valid[:-1]
    start = np.flatnonzero(change)
    row = np.searchsorted(offsets, start, side="right") - 1
    stop = np.minimum(np.append(start[1:], n), offsets[row + 1] - length + 1)
    anchor = grams[at[start]]
    shift = (at[start] - start).astype(U)
    region = mix(p2.ranges(start, stop - 1 + length) + shift)
    if len(hot):
        single = np.isin(anchor, hot)
        if single.any():
            many = stop[single] - start[single]
            s = gather_ranges(start[single], many)
            r = np.repeat(row[single], many)
            a1, a2 = p1.ranges(s, s + length), p2.ranges(s, s + length)
            keep = ~single
            return (np.append(anchor[keep], mix(a1 ^ U(0x0F0F0F0F12345678))), np.append(region[keep], a2), np.append(row[keep], r),
                    np.append(start[keep], s), np.append((stop - start)[keep], np.ones(len(s), np.int64)))
    return anchor, region, row, start, stop - start


def listed(rows: Rows, spec: Windows, hot: np.ndarray):
    """Regions of a whole batch: anchor, region hash, id, start within the id's rows, windows; and how to find their tokens."""
    for lo, hi in rows.steps():
        v1, v2, offsets, bounds = tokens_of(rows, lo, hi, spec)
        a, r, row, start, many = regions(v1, v2, offsets, spec, hot)
        yield lo, hi, v1, offsets, bounds, a, r, row, start, many


def row_bases(rows: Rows, spec: Windows) -> np.ndarray:
    """Where each row starts within its id (rows that share an id are parts of one document)."""
    n = len(rows.ids)
    base = np.zeros(n, np.int64)
    same = np.append(False, rows.ids[1:] == rows.ids[:-1]) if n else np.zeros(0, bool)
    if same.any():
        sizes = np.zeros(n, np.int64)
        for lo, hi in rows.steps():
            sizes[lo:hi] = np.diff(tokens_of(rows, lo, hi, spec)[2])
        for i in np.flatnonzero(same):
            base[i] = base[i - 1] + sizes[i - 1]
    return base


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpack(blob: bytes, types: tuple) -> list[np.ndarray]:
    size = sum(np.dtype(t).itemsize for t in types)
    n, at, out = len(blob) // size, 0, []
    for t in types:
        out.append(np.frombuffer(blob, t, n, at))
        at += n * np.dtype(t).itemsize
    return out


def unpack_all(blobs: list, types: tuple) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns of all blobs, and which blob each entry came from."""
    parts = [unpack(b, types) for b in blobs]
    if not parts:
        return [np.zeros(0, t) for t in types], np.zeros(0, np.int64)
    which = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
    return [np.concatenate(c) for c in zip(*parts)], which


def by_key(keys: np.ndarray):
    """(key, indices) for each distinct small integer key."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(keys[part[0]]), part


LISTED = (np.uint64, np.uint64, np.int64, np.uint32, np.uint8)  # anchor, region, id, start, more than one
ASKED = (np.uint64, np.uint64, np.int64, np.uint32, np.uint8)  # anchor, region, first id, first start, to be matched
MARKED = (np.int64, np.uint32, np.uint32)  # id, first window start, windows
ROUTED = "kind int, bucket int, batch int, payload binary"


def _table(schema: str, rows: list) -> pa.Table:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.binary() if x.split()[1] == "binary" else pa.int32() for x in schema.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(list(c), t) for n, t, c in zip(names, kinds, cols)})


def joined_ranges(ids: np.ndarray, start: np.ndarray, many: np.ndarray):
    """Ranges per id sorted and merged where they touch."""
    order = np.lexsort((start, ids))
    ids, start, stop = ids[order], start[order].astype(np.int64), (start + many)[order].astype(np.int64)
    if not len(ids):
        return ids, start, stop - start
    fresh = np.append(True, (ids[1:] != ids[:-1]) | (start[1:] > stop[:-1]))
    # starts within an id do not overlap unless they repeat, so a running end is the end of the last piece
    first = np.flatnonzero(fresh)
    last = np.maximum.reduceat(stop, first)
    return ids[first], start[first], last - start[first]


def list_batch(spec: Windows, buckets: int, hot: np.ndarray) -> Callable:
    """Step 2: the regions of a batch, identical ones folded, by bucket."""

    def run(table: pa.Table) -> pa.Table:
        batch = table.column("_batch")[0].as_py()
        rows = Rows(table)
        base = row_bases(rows, spec)
        a, r, d, s = [], [], [], []
        for lo, _, _, offsets, _, anchor, region, row, start, _ in listed(rows, spec, hot):
            a.append(anchor)
            r.append(region)
            d.append(rows.ids[lo + row])
            s.append(start - offsets[row] + base[lo + row])
        a, r, d, s = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, r, d, s))
        if not len(a):
            return _table("bucket int, batch int, payload binary", [])
        order = np.lexsort((s, d, r, a.astype(U)))
        a, r, d, s = a[order], r[order], d[order], s[order]
        fresh = np.append(True, (a[1:] != a[:-1]) | (r[1:] != r[:-1]))
        first = np.flatnonzero(fresh)
        more = (np.diff(np.append(first, len(a))) > 1).astype(np.uint8)
        a, r, d, s = a[first], r[first], d[first], s[first].astype(np.uint32)
        out = [(key, batch, pack(a[i], r[i], d[i], s[i], more[i])) for key, i in by_key((a % U(buckets)).astype(np.int32))]
        return _table("bucket int, batch int, payload binary", out)

    return run


def settle_bucket() -> Callable:
    """Step 3: which regions occur again, where the first one is, and which differ under a shared anchor."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        batches = table.column("batch").to_numpy()
        (a, r, d, s, more), which = unpack_all(table.column("payload").to_pylist(), LISTED)
        b = batches[which]
        order = np.lexsort((s, d, r, a))
        a, r, d, s, more, b = (x[order] for x in (a, r, d, s, more, b))
        new_a = np.append(True, a[1:] != a[:-1])
        new_r = new_a | np.append(True, r[1:] != r[:-1])
        ga, gr = np.cumsum(new_a) - 1, np.cumsum(new_r) - 1
        kinds = np.bincount(ga, weights=new_r)[ga]
        copies = np.bincount(gr)[gr] + np.maximum.reduceat(more, np.flatnonzero(new_r))[gr]
        keep = (kinds > 1) | (copies > 1)
        first = np.flatnonzero(new_r)[gr]
        fd, fs, match = d[first], s[first], (kinds > 1).astype(np.uint8)
        a, r, fd, fs, match, b = (x[keep] for x in (a, r, fd, fs, match, b))
        out = [(0, bucket, key, pack(a[i], r[i], fd[i], fs[i], match[i])) for key, i in by_key(b)]
        return _table(ROUTED, out)

    return run


def answer_batch(spec: Windows, buckets: int, hot: np.ndarray) -> Callable:
    """Step 4a: marks for repeats of whole regions, and tokens of regions to be matched."""

    def run(docs: pa.Table, asked: pa.Table) -> pa.Table:
        if not docs.num_rows or not asked.num_rows:
            return _table(ROUTED, [])
        batch = docs.column("_batch")[0].as_py()
        rows = Rows(docs)
        base = row_bases(rows, spec)
        (qa, qr, fd, fs, match), _ = unpack_all(asked.column("payload").to_pylist(), ASKED)
        key = mix(qa) + qr * U(0x9E3779B97F4A7C15)
        order = np.argsort(key)
        key, fd, fs, match = key[order], fd[order], fs[order], match[order]
        marks, asked_for = [], []
        for lo, _, v1, offsets, bounds, a, r, row, start, many in listed(rows, spec, hot):
            if not len(a):
                continue
            mine = mix(a) + r * U(0x9E3779B97F4A7C15)
            at = np.minimum(np.searchsorted(key, mine), len(key) - 1)
            known = key[at] == mine
            a, row, start, many, at = a[known], row[known], start[known], many[known], at[known]
            d, s = rows.ids[lo + row], start - offsets[row] + base[lo + row]
            first = d == fd[at]
            if spec.own_document:
                first &= s == fs[at]
            marks.append((d[~first], s[~first], many[~first]))
            ask = first & (match[at] > 0)
            if ask.any():
                values = rows.data[rows.offsets[lo] : rows.offsets[lo] + len(v1)] if not spec.by_words else v1
                asked_for.append((a[ask], d[ask], s[ask], many[ask], values, start[ask]))
        out = []
        if marks:
            d, s, m = joined_ranges(*(np.concatenate(x) for x in zip(*marks)))
            if len(d):
                out.append((1, batch % buckets, batch, pack(d, s.astype(np.uint32), m.astype(np.uint32))))
        for a, d, s, m, values, start in asked_for:
            for k, i in by_key((a % U(buckets)).astype(np.int32)):
                tokens = values[gather_ranges(start[i], m[i] + spec.length - 1)]
                head = np.array([len(i)], np.int64)
                out.append((2, k, batch, pack(head, a[i], d[i], s[i].astype(np.uint32), m[i].astype(np.uint32), tokens)))
        return _table(ROUTED, out)

    return run


Matcher = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def match_bucket(spec: Windows, matcher: Matcher, shard_tokens: int) -> Callable:
    """Step 4b: shards of whole anchor groups go through the matcher; marks of step 4a pass."""
    kind = np.uint64 if spec.by_words else np.uint8

    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        batches, blobs = table.column("batch").to_numpy(), table.column("payload")
        out = [(int(batches[i]), blobs[i].as_py()) for i in np.flatnonzero(kinds == 1).tolist()]
        a, d, s, m, b, tokens = [], [], [], [], [], []
        for i in np.flatnonzero(kinds == 2).tolist():
            blob = blobs[i].as_py()
            n = int(np.frombuffer(blob, np.int64, 1)[0])
            for into, t, at in ((a, np.uint64, 8), (d, np.int64, 8 + 8 * n), (s, np.uint32, 8 + 16 * n), (m, np.uint32, 8 + 20 * n)):
                into.append(np.frombuffer(blob, t, n, at))
            tokens.append(np.frombuffer(blob, kind, -1, 8 + 24 * n))
            b.append(np.full(n, batches[i], np.int32))
        if a:
            a, d, s, m, b, tokens = (np.concatenate(x) for x in (a, d, s, m, b, tokens))
            size = m.astype(np.int64) + spec.length - 1
            at = np.cumsum(size) - size
            order = np.lexsort((s, d, a))
            ends = np.flatnonzero(np.append(a[order][1:] != a[order][:-1], True)) + 1
            total = np.cumsum(size[order])
            lo, marks = 0, []
            for hi in ends[np.append(np.diff(total[ends - 1] // shard_tokens) > 0, True)].tolist():
                part = order[lo:hi]
                lo = hi
                region, offset = matcher(tokens[gather_ranges(at[part], size[part])], size[part], m[part], d[part], s[part])
                marks.append((b[part][region], d[part][region], s[part][region].astype(np.int64) + offset))
            b, d, s = (np.concatenate(x) for x in zip(*marks))
            for key, i in by_key(b):
                rd, rs, rm = joined_ranges(d[i], s[i], np.ones(len(i), np.int64))
                out.append((key, pack(rd, rs.astype(np.uint32), rm.astype(np.uint32))))
        return _table("batch int, payload binary", out)

    return run


def apply_batch(spec: Windows, finish: Callable, schema: pa.Schema) -> Callable:
    """Step 5: tokens covered by marked windows, per row, handed to *finish*."""

    def run(docs: pa.Table, marked: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        rows = Rows(docs)
        base = row_bases(rows, spec)
        (d, s, m), _ = unpack_all(marked.column("payload").to_pylist(), MARKED)
        order = np.lexsort((s, d))
        d, s, m = d[order], s[order].astype(np.int64), m[order].astype(np.int64)
        out = []
        for lo, hi in rows.steps():
            _, _, offsets, bounds = tokens_of(rows, lo, hi, spec)
            edge = np.zeros(int(offsets[-1]) + 1, np.int32)
            size = np.diff(offsets)
            left = np.searchsorted(d, rows.ids[lo:hi], "left")
            right = np.searchsorted(d, rows.ids[lo:hi], "right")
            for i in np.flatnonzero(right > left).tolist():
                begin = s[left[i] : right[i]] - base[lo + i]
                many = m[left[i] : right[i]]
                mine = (begin >= 0) & (begin < size[i])
                begin, stop = begin[mine] + offsets[i], (begin + many)[mine] - 1 + spec.length + offsets[i]
                np.add.at(edge, begin, 1)
                np.add.at(edge, np.minimum(stop, offsets[i + 1]), -1)
            gone = np.cumsum(edge[:-1]) > 0
            out.append(finish(rows, lo, hi, offsets, bounds, gone))
        return pa.concat_tables(out)

    return run


def hot_anchors(docs: DataFrame, spec: Windows, n_docs: int) -> np.ndarray:
    """Anchors with many different regions in a sample (a bounded list; it only routes rows)."""
    share = min(1.0, HOT_SAMPLE / max(1, n_docs))

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rows = Rows(table)
            seen = [np.unique(np.stack([a, r]), axis=1) for *_, a, r, _, _, _ in listed(rows, spec, np.zeros(0, U)) if len(a)]
            if seen:
                a, r = np.concatenate(seen, axis=1).view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": a, "r": r})

    sample = docs.select("_id", "_text").sample(withReplacement=False, fraction=share, seed=11) if share < 1 else docs.select("_id", "_text")
    least = max(32, int(HOT_SHARE * min(n_docs, HOT_SAMPLE)))
    counted = sample.mapInArrow(run, "a bigint, r bigint").distinct().groupBy("a").count().filter(F.col("count") >= least)
    found = counted.orderBy(F.desc("count"), "a").limit(20_000).collect()
    return np.sort(np.array([x["a"] for x in found], np.int64).view(U))


def dedup_windows(docs: DataFrame, id_col: str, text_col: str, spec: Windows, matcher: Matcher, shard_tokens: int, finish: Callable, schema: str, arrow_schema: pa.Schema) -> DataFrame:
    """Run the five steps over *docs*; *finish* turns each batch's marks into result rows."""
    narrow = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("_id"), F.col(id_col).cast("bigint").alias("_given"), F.col(text_col).cast("string").alias("_text"))
    total, n_docs = narrow.agg(F.sum(F.octet_length("_text")), F.count(F.lit(1))).first()
    total = int(total or 0)
    size = min(BATCH_BYTES_MOST, max(BATCH_BYTES, total // BATCHES))
    batches = max(1, -(-total // size))
    buckets = max(1, batches // 2)
    hot = hot_anchors(narrow, spec, n_docs)
    dealt = narrow.withColumn("_batch", F.pmod(F.xxhash64("_id"), F.lit(batches)).cast("int"))
    asked = (
        dealt.groupBy("_batch").applyInArrow(list_batch(spec, buckets, hot), "bucket int, batch int, payload binary")
        .groupBy("bucket").applyInArrow(settle_bucket(), ROUTED)
    )
    answered = dealt.groupBy("_batch").cogroup(asked.groupBy("batch")).applyInArrow(answer_batch(spec, buckets, hot), ROUTED)
    marked = answered.groupBy("bucket").applyInArrow(match_bucket(spec, matcher, shard_tokens), "batch int, payload binary")
    return dealt.groupBy("_batch").cogroup(marked.groupBy("batch")).applyInArrow(apply_batch(spec, finish, arrow_schema), schema)
