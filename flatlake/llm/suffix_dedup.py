"""Exact substring dedup over bytes with suffix arrays (induced sorting, permuted common prefixes)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .anchored import Windows, dedup_windows
from .sais import permuted_common_prefixes, suffix_array

SCHEMA = "_given bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
ARROW = pa.schema([("_given", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
#: Bytes of regions per suffix array.
SHARD = 1 << 20


def repeated_windows(length: int):
    """Matcher: windows of a shard whose bytes also start earlier, by the shard's suffix array."""

    def match(data, size, many, ids, starts):
        sa = suffix_array(data)
        before, common = permuted_common_prefixes(data, sa, length)
        run = np.cumsum(common[sa] < length)  # suffixes that agree on a window's bytes are neighbours
        ends = np.cumsum(size)
        region = np.searchsorted(ends, sa, side="right")
        offset = sa - (ends - size)[region]
        real = offset < many[region]
        run, region, offset = run[real], region[real], offset[real]
        shared = np.bincount(run, minlength=int(run.max()) + 1 if len(run) else 1)[run] > 1
        run, region, offset = run[shared], region[shared], offset[shared]
        order = np.lexsort((starts[region] + offset, ids[region], run))
        run, region, offset = run[order], region[order], offset[order]
        later = np.append(False, run[1:] == run[:-1]) if len(run) else np.zeros(0, bool)
        return region[later], offset[later]

    return match


def _finish(rows, lo, hi, offsets, bounds, gone):
    base = rows.offsets[lo]
    data = rows.data[base : base + len(gone)]
    counts = np.concatenate([[0], np.cumsum(gone)])
    removed = counts[offsets[1:]] - counts[offsets[:-1]]
    first = gone.copy()
    first[1:] &= ~gone[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    first[starts] = gone[starts]  # a span ends with its document
    spans = np.concatenate([[0], np.cumsum(first)])
    kept_at = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)])
    kept = data[~gone]
    n = hi - lo
    blob = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(kept_at.astype(np.int32).tobytes()), pa.py_buffer(kept.tobytes())])
    return pa.table({"_given": rows.given.column("_given").slice(lo, n).combine_chunks(), "n_bytes": np.diff(offsets), "n_removed": removed,
                     "n_spans": spans[offsets[1:]] - spans[offsets[:-1]], "kept": blob}, schema=ARROW)


def dedup_substrings(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every byte covered by a *length*-byte string that also starts earlier.

    Earlier: in a document of smaller id, or before it in the same document.
    All strings are judged on the input.  Result: ``id_col``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the
    remaining bytes; a cut may fall inside a character, hence binary).

    Defined cases: a null text is empty; texts shorter than *length* stay
    whole; a null id counts as the largest; rows that share an id are parts of
    one document in order of their text (matches never cross rows); an empty
    table gives an empty result; other columns are ignored.  Texts may be as
    long as an Arrow value (2 GB).
    """
    gram = min(32, max(1, length // 3))
    out = dedup_windows(docs, id_col, text_col, Windows(length, gram, False, True), repeated_windows(length), SHARD, _finish, SCHEMA, ARROW)
    return out.withColumnRenamed("_given", id_col)


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
