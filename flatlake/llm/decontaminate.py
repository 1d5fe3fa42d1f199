"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment over words.

1. The benchmark's n-grams fill a bitmap of fixed size, the only thing sent to
   every task (its size does not depend on the data).
2. A pass over the corpus reports where they occur, and how often each does.
3. Every item gets its seeds: of its n-grams that occur at all the most common
   are left out, as long as no copy with words replaced or dropped can reach
   the score, and no run of RUN words can stand, without one of the rest
   (:func:`rare_seeds`).  So a phrase that every document holds joins nothing
   unless the item cannot be found without it.
4. A join of the hits with the seeds gives item and diagonal.  Documents with a
   candidate are aligned, if the item's words that occur there at all could
   reach the score.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .linking import written
from .textkit import Prefix, U, buffer_of, mix, pieces, word_hashes, words

#: Words of an n-gram, and bits of the bitmap (two probes).
GRAM, BITS = 3, 24
#: Words in a row that count as a copy whatever the length of the item.
RUN = 13
#: Words of an item whose seeds are chosen together, and n-grams kept in a row before the choice ends.
STRETCH, TRIALS = 64, 8
STEP = 1 << 20
LAST_ID = (1 << 63) - 1

#: A-Z lowered, other ASCII that is not a letter or digit becomes a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256, dtype=np.uint8)
for _lo, _hi in ((48, 58), (97, 123)):
    _FOLD[_lo:_hi] = np.arange(_lo, _hi, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123, dtype=np.uint8)


def folded_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes (case and ASCII punctuation ignored) and the first word of each row."""
    data = _FOLD[data]
    starts, ends, first = words(data, offsets)
    return word_hashes(data, starts, ends), first


def grams_of(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and position in the row of every n-gram inside a row."""
    grams = Prefix(mix(hashes)).grams(GRAM)
    size = np.maximum(np.diff(first) - GRAM + 1, 0)
    row = np.repeat(np.arange(len(size)), size)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    return grams[first[:-1][row] + pos], row, pos


def _slots(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return grams & U((1 << BITS) - 1), (grams >> U(32)) & U((1 << BITS) - 1)


def bitmap_of(seeds: DataFrame) -> np.ndarray:
    """Bitmap over ``seeds(gram)``; each task sends its own, compressed, and they are merged one at a time."""

    def run(batches):
        bits = np.zeros(1 << BITS, bool)
        for batch in batches:
            for slot in _slots(batch.column(0).to_numpy(zero_copy_only=False).view(U)):
                bits[slot] = True
        yield pa.RecordBatch.from_pydict({"bits": [zlib.compress(np.packbits(bits).tobytes(), 1)]})

    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in seeds.select("gram").mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out


def _probed(packed: np.ndarray, grams: np.ndarray) -> np.ndarray:
    x, y = _slots(grams)
    look = lambda s: (packed[s >> U(3)] >> (U(7) - (s & U(7))).astype(np.uint8)) & 1
    hit = np.flatnonzero(look(x))
    return hit[look(y[hit]).astype(bool)]


def found_grams(docs: DataFrame, packed: np.ndarray) -> DataFrame:
    """Corpus n-grams that pass the bitmap: ``(gram, id, pos)``."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = buffer_of(batch.column(1))
            parts = []
            for lo, hi in pieces(offsets, STEP):
                hashes, first = folded_words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                grams, row, pos = grams_of(hashes, first)
                hit = _probed(packed, grams)
                parts.append((grams[hit], ids[lo + row[hit]], pos[hit]))
            grams, who, pos = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, U), ids[:0], ids[:0])
            yield pa.RecordBatch.from_pydict({"gram": grams.view(np.int64), "id": who, "pos": pos.astype(np.int64)})

    return docs.mapInArrow(run, "gram bigint, id bigint, pos bigint")


def item_grams(items: DataFrame) -> DataFrame:
    """``(gram, item, pos, n_words)`` of the benchmark; an item shorter than an n-gram has none."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            hashes, first = folded_words(*buffer_of(batch.column(1)))
            grams, row, pos = grams_of(hashes, first)
            yield pa.RecordBatch.from_pydict({"gram": grams.view(np.int64), "item": ids[row], "pos": pos.astype(np.int64), "n_words": np.diff(first)[row].astype(np.int64)})

    return items.mapInArrow(run, "gram bigint, item bigint, pos bigint, n_words bigint")


def reach_without(seeds: np.ndarray, n: int) -> int:
    """Most points of *n* item words, words replaced or dropped, of which no n-gram marked in *seeds* stands whole."""
    never = -(1 << 40)
    apart, one, two = 0, never, never  # points with 0, 1, 2 or more equal words in a row at the end
    best = 0
    for i in range(n):
        more = two + 2 if i >= GRAM - 1 and not seeds[i - GRAM + 1] else never
        apart, one, two = max(0, max(apart, one, two) - 1), apart + 2, max(one + 2, more)
        best = max(best, one, two)
    return best


def rare_seeds(counts: np.ndarray, n: int, least: float) -> np.ndarray:
    """Which n-grams of an item of *n* words are seeds, by their corpus *counts* (0: occurs nowhere, cannot be a hit).

    From the most common on, an n-gram is left out if afterwards no alignment
    that misses all the others scores *least* (or more than one that misses
    all), and every RUN words still hold one of the others.  Words of different
    stretches are judged apart; n-grams across two stretches stay.
    """
    kept = np.ones(len(counts), bool)
    for start in range(0, n, STRETCH):
        words = min(STRETCH, n - start)
        own = kept[start : start + max(0, words - GRAM + 1)]  # a view
        limit = max(reach_without(own, words), int(np.ceil(least * 2 * words)) - 1)
        failed = 0
        for p in np.argsort(-counts[start : start + len(own)], kind="stable"):
            if counts[start + p] == 0 or failed == TRIALS:
                break
            own[p] = False
            gaps = np.diff(np.flatnonzero(np.concatenate([[True], kept[max(0, start - RUN) : start + STRETCH + RUN], [True]])))
            if reach_without(own, words) > limit or gaps.max() > RUN - GRAM + 1:
                own[p] = True
                failed += 1
    return kept & (counts > 0)


def chosen(grams: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """Rows of ``grams(gram, item, pos, n_words)`` that are seeds; an item's n-grams, at most its words, are one group."""

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        return pdf[rare_seeds(pdf["n"].to_numpy(), int(pdf["n_words"].iloc[0]), least)][["gram", "item", "pos", "n_words"]]

    counted = grams.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.groupBy("item").applyInPandas(pick, "gram bigint, item bigint, pos bigint, n_words bigint")


def longest_run(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Most equal words in a row of both sequences, and where they end in the passage."""
    run, best = np.zeros(len(passage) + 1, np.int64), (0, 0)
    for w in item:
        run[1:] = np.where(passage == w, run[:-1] + 1, 0)
        at = int(run.argmax())
        if run[at] > best[0]:
            best = (int(run[at]), at)
    return best


def smith_waterman(passage: np.ndarray, item: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -1) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: score, and the passage words [start, stop) it spans.

    A row at a time; the gap along the row is a running maximum.
    """
    n = len(passage)
    slope = -gap * np.arange(n + 1)
    score, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for w in item:
        step = np.where(passage == w, match, mismatch)
        diagonal, up = score[:-1] + step, score[1:] + gap
        new = np.maximum(np.maximum(diagonal, up), 0)
        came = np.where(new == 0, np.arange(1, n + 1), np.where(diagonal >= up, begin[:-1], begin[1:]))
        new, came = np.append(0, new), np.append(0, came)
        along = new + slope
        top = np.maximum.accumulate(along)
        source = np.maximum.accumulate(np.where(along == top, np.arange(n + 1), 0))
        score, begin = top - slope, came[source]
        at = int(np.argmax(score))
        if score[at] > best[0]:
            best = (int(score[at]), int(begin[at]), at)
    return best


def _aligned(least: float):
    """Per (document, candidates): the items whose alignment reaches *least* of their words, or with RUN equal words in a row."""

    def run(frames):
        for pdf in frames:
            out = []
            for doc, text, candidates in zip(pdf["id"], pdf["text"], pdf["candidates"]):
                raw = np.frombuffer(text.encode(), np.uint8)
                hashes, _ = folded_words(raw, np.array([0, len(raw)]))
                best: dict = {}
                items: dict = {}
                for c, diagonal in ((c, diagonal) for c in candidates for diagonal in c["diagonals"]):
                    if c["item"] not in items:
                        own = np.frombuffer(c["item_text"].encode(), np.uint8)
                        items[c["item"]] = folded_words(own, np.array([0, len(own)]))[0]
                    item = items[c["item"]]
                    pad = max(4, len(item) // 2)
                    lo, hi = max(0, diagonal - pad), min(len(hashes), diagonal + len(item) + 2 * pad)
                    # the score is at most 2 per item word that occurs in the window
                    common = np.isin(item, hashes[lo:hi]).sum()
                    if common < min(RUN, least * len(item)):
                        continue
                    score, start, stop = smith_waterman(hashes[lo:hi], item)
                    share = score / max(1, 2 * len(item))
                    enough = share >= least
                    if not enough and common >= RUN:
                        run, end = longest_run(hashes[lo:hi], item)
                        enough, start, stop = run >= RUN, end - run, end
                    if enough and share > best.get(c["item"], (0,))[0]:
                        best[c["item"]] = (share, lo + start, lo + stop)
                out += [(doc, item, *found) for item, found in best.items()]
            yield pd.DataFrame(out, columns=["id", "item", "score", "start", "stop"])

    return run


def contaminated(docs: DataFrame, items: DataFrame, least: float = 0.55, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``(id, item, score, start, stop)``: items found in documents, their score per item word, the words spanned.

    An alignment counts 2 for an equal word, -1 for an unequal one and for a
    gap, over 2 per item word: a verbatim copy scores 1, one with a fifth of its words
    replaced 0.7.  Found is what scores *least* or more, or holds RUN words of
    the item in a row (then with its score and the span of the run).  Whole
    texts are searched.  A copy that shares no three words in a row with the
    item (a word put in after every second one) has no hit.

    Defined cases: null texts match nothing; items of fewer than GRAM words
    have no seed and are not searched for; null ids count as the largest id;
    rows sharing an id each count; repeated items are found once per item id;
    empty tables give an empty result; other columns are ignored.
    """
    narrow = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.col(text_col).cast("string").alias("text"))
    bench = items.select(F.coalesce(F.col(item_col).cast("bigint"), F.lit(LAST_ID)).alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("item_text"))
    bench = bench.groupBy("item").agg(F.max("item_text").alias("item_text"))
    grams = written(item_grams(bench), "item-grams")
    hits = written(found_grams(narrow, bitmap_of(grams)), "gram-hits")
    counts = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    seeds = chosen(grams, counts, least).withColumnRenamed("pos", "at")
    # hits of one copy lie near one diagonal; a step of a quarter item keeps one candidate for them
    step = F.greatest(F.lit(4), F.floor(F.col("n_words") / 4))
    near = (F.floor((F.col("pos") - F.col("at")) / step) * step).cast("bigint")
    candidates = hits.join(seeds, "gram").groupBy("id", "item").agg(F.collect_set(near).alias("diagonals"))
    # an item's text comes once a document, however many diagonals it has there
    per_doc = candidates.join(bench, "item").groupBy("id").agg(F.collect_list(F.struct("item", "diagonals", "item_text")).alias("candidates"))
    found = narrow.filter("text is not null").join(per_doc, "id").mapInPandas(_aligned(least), "id bigint, item bigint, score double, start bigint, stop bigint")
    return found.groupBy("id", "item").agg(F.max(F.struct("score", "start", "stop")).alias("m")).select("id", "item", "m.*")


def verdicts(docs: DataFrame, items: DataFrame, least: float = 0.55, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per row of *docs*: ``id_col``, ``n_items`` found, best ``item_id`` and ``score``, ``contaminated`` and ``kept``."""
    found = contaminated(docs, items, least, id_col, text_col, item_col)
    best = found.groupBy("id").agg(F.count(F.lit(1)).alias("n_items"), F.max(F.struct("score", (-F.col("item")).alias("minus"))).alias("m"))
    best = best.select("id", "n_items", (-F.col("m.minus")).alias("item_id"), F.round("m.score", 6).alias("score"))
    rows = docs.select(F.col(id_col).cast("bigint").alias(id_col), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"))
    out = rows.join(best, "id", "left")
    return out.select(id_col, F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", "score", F.col("n_items").isNotNull().alias("contaminated"), F.col("n_items").isNull().alias("kept"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark")))
