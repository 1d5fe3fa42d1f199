"""Importance resampling towards a target text with an Aho-Corasick word dictionary.

**Features.**  Texts are lower-cased (A-Z) and cut into words; a feature is a
run of 1 to ``grams`` consecutive words of one text joined by one space, and
its bucket is the CRC-32 of its UTF-8 bytes modulo ``buckets``.

**Dictionary.**  Every task keeps a dictionary of the distinct words it has
met, each held between two delimiters and carrying its CRC and length as
payload.  One automaton scan of a piece of text (all delimiters made spaces)
emits the payloads of the words in it; words not in the dictionary yet are
hashed one by one and enter it before the next piece.  The dictionary is
bounded by WORDS words of LETTERS bytes; it only saves time, the payloads are
the same either way.

**Composition.**  The CRC of "u v" follows from the payloads of u and v alone:
``crc(xy) = shift(crc(x), len(y)) ^ crc(y)``, where the shift is a linear map
over bits, applied by table for every binary digit of the length.

**Counts and draw.**  Bucket counts are added up per task and then in Spark;
the gains of the buckets (a fixed number) go back to the tasks, which sum them
per text in a second scan.  Documents get a Gumbel-perturbed score; a range
sort ranks them over all tasks.
"""

from __future__ import annotations

import math
import zlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .linking import written
from .textkit import buffer_of

#: Words of a task's dictionary at most, and bytes of each.
WORDS, LETTERS = 1 << 16, 64
#: Bytes of text scanned at a time (then up to the next delimiter).
PIECE = 1 << 22
SPACE = 32

#: Delimiters (0x00-0x2F, 0x3A-0x60 after lower-casing, 0x7B-0x7F) to a space, A-Z to a-z.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[65:91] += 32
PLAIN[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = SPACE


def _zero_tables() -> list[np.ndarray]:
    """Tables of the maps "append 2**k zero bytes" on a CRC register, for k = 0 .. 31."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1).astype(np.uint32)
    values = np.arange(256, dtype=np.uint32)
    one = np.stack([step, values, values << np.uint32(8), values << np.uint32(16)])
    # appending one zero byte: the low byte goes through the table, the others move down
    tables = [one]
    for _ in range(31):
        tables.append(np.stack([_mapped(_mapped(values << np.uint32(8 * byte), tables[-1]), tables[-1]) for byte in range(4)]))
    return tables


def _mapped(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]


ZEROS = _zero_tables()


def composed(crc: np.ndarray, more: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of x + y from those of x and y and the lengths of y."""
    out, k, left = crc.astype(np.uint32), 0, length.copy()
    while left.any():
        at = np.flatnonzero(left & 1)
        out[at] = _mapped(out[at], ZEROS[k])
        left >>= 1
        k += 1
    return out ^ more.astype(np.uint32)


class Dictionary:
    """Delimiter-bounded words with payloads (length << 32 | CRC); texts as Latin-1 views of their bytes."""

    def __init__(self, words: int = WORDS, letters: int = LETTERS):
        self.limit, self.letters = words, letters
        self.known: dict[str, int] = {}
        self.waiting: dict[str, int] = {}
        self.automaton = None

    def _grow(self) -> None:
        """Take the waiting words in, once they are a fair part of the dictionary."""
        if not self.waiting or 4 * len(self.waiting) < len(self.known):
            return
        self.known.update(self.waiting)
        self.waiting = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY)  # STORE_INTS hands back 32 bits
        for word, payload in self.known.items():
            self.automaton.add_word(f" {word} ", payload)
        self.automaton.make_automaton()

    def payloads(self, data: np.ndarray) -> np.ndarray:
        """Payloads of the words of *data* in order; it starts and ends with a space and holds no other delimiter."""
        self._grow()
        text = data.tobytes().decode("latin-1")
        letter = data != SPACE
        starts = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
        ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
        out = np.full(len(ends), -1, np.int64)
        if self.automaton is not None:
            hits = np.fromiter(self.automaton.iter(text), np.dtype((np.int64, 2)))
            if len(hits):
                out[np.searchsorted(ends, hits[:, 0])] = hits[:, 1]
        waiting, room = self.waiting, self.limit - len(self.known)
        for i in np.flatnonzero(out < 0).tolist():
            word = text[starts[i] : ends[i]]
            payload = waiting.get(word)
            if payload is None:
                raw = word.encode("latin-1")
                payload = len(raw) << 32 | zlib.crc32(raw)
                if len(raw) <= self.letters and len(waiting) < room:
                    waiting[word] = payload
            out[i] = payload
        return out


def scanned(dictionary: Dictionary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Payloads of all words of the rows, and the first word of each row (n + 1)."""
    n = len(offsets) - 1
    # one space before every row and one at the end
    spaced = np.full(len(data) + n + 1, SPACE, np.uint8)
    spaced[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = PLAIN[data]
    letter = spaced != SPACE
    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    first = np.searchsorted(ends, offsets + np.arange(n + 1), side="right")
    found, at = [], 0
    while at < len(spaced) - 1:
        to = min(at + PIECE, len(spaced) - 1)
        if to < len(spaced) - 1 and letter[to]:
            to = int(ends[np.searchsorted(ends, to)])
        found.append(dictionary.payloads(spaced[at : to + 1]))
        at = to
    return (np.concatenate(found) if found else np.zeros(0, np.int64)), first


def features(payload: np.ndarray, first: np.ndarray, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every run of 1 to *grams* words."""
    crc, length = (payload & 0xFFFFFFFF).astype(np.uint32), payload >> 32
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    space = np.uint32(zlib.crc32(b" "))
    out, rows, run = [crc], [row], crc
    for k in range(1, grams):
        run, after, last = run[:-1], crc[k:], length[k:]
        spaced = composed(run, np.full(len(run), space), np.ones(len(run), np.int64))
        run = composed(spaced, after, last)
        same = row[: len(run)] == row[k:]
        out.append(run[same])
        rows.append(row[: len(run)][same])
    return np.concatenate(out).astype(np.int64) % buckets, np.concatenate(rows)


def _slices(column, limit: int = 1 << 25):
    """Bytes, offsets and row range of slices of about *limit* bytes; a longer text is one of its own."""
    data, offsets = buffer_of(column)
    n, i = len(offsets) - 1, 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1))
        yield data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i, j
        i = j


def bucket_counts(texts: DataFrame, text_col: str, grams: int, buckets: int) -> DataFrame:
    """``(bucket, n)`` over all rows: one vector per task, then a sum."""

    def run(batches):
        dictionary, total = Dictionary(), np.zeros(buckets, np.int64)
        for batch in batches:
            for data, offsets, _, _ in _slices(batch.column(0)):
                which, _ = features(*scanned(dictionary, data, offsets), grams, buckets)
                total += np.bincount(which, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    parts = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "bucket bigint, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down, per bucket."""
    big_s, big_t = sum(corpus.values()) + buckets, sum(target.values()) + buckets
    return np.array([
        math.floor(1000 * math.log(float((target.get(b, 0) + 1) * big_s) / float((corpus.get(b, 0) + 1) * big_t))) for b in range(buckets)
    ], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, grams: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` per row."""
    schema = "doc_id bigint, n_words bigint, n_features bigint, weight bigint"

    def run(batches):
        dictionary = Dictionary()
        for batch in batches:
            for data, offsets, i, j in _slices(batch.column(1)):
                payload, first = scanned(dictionary, data, offsets)
                which, row = features(payload, first, grams, len(gain))
                weight = np.zeros(j - i, np.int64)
                np.add.at(weight, row, gain[which])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first)), pa.array(np.bincount(row, minlength=j - i)), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def ranked(rows: DataFrame, order: list, many: int) -> DataFrame:
    """*rows* with ``rank`` 1, 2, ... in *order* over all tasks, null beyond *many*.

    A range shuffle and a sort inside its parts; a row's number is its place in
    its part and the sizes of the parts before (one number a part on the driver).
    """
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    placed = written(placed, "ranked")
    part, place = F.shiftrightunsigned("__place", 33), F.col("__place").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    before, total = [], 0
    for r in sizes:
        before.append((r["p"], total))
        total += r["n"]
    starts = F.broadcast(rows.sparkSession.createDataFrame(before, "__part bigint, __before bigint"))
    out = placed.withColumn("__part", part).join(starts, "__part", "left")
    rank = F.col("__before") + place + 1
    return out.select(*rows.columns, F.when(rank <= many, rank).alias("rank"))


def importance_sample(
    docs: DataFrame, target: DataFrame, *, grams: int = 1, buckets: int = 10000, percent: int = 10, least_words: int = 20,
    seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """``(id_col, n_words, n_features, weight, score, rank)`` for every row of *docs*; drawn rows have a rank.

    Of the N rows with at least *least_words* words, floor(percent * N / 100)
    with the highest scores are drawn, ties to the smaller id.

    Defined cases: a null text has no words; a null id is hashed as an empty
    one and sorted after the others; rows that share an id are scored and drawn
    one by one (equal scores among them by n_features); an empty target gives
    every bucket its smoothed share; an empty table gives an empty result;
    other columns are ignored.
    """
    count = lambda df, column: {r["bucket"]: r["n"] for r in bucket_counts(df, column, grams, buckets).collect()}
    gain = gains(count(docs, text_col), count(target, target_col), buckets)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("bigint")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296)))
    scored = written(weights(docs, gain, id_col, text_col, grams).withColumn("score", (F.col("weight") + gumbel).cast("bigint")), "importance")
    open_ = scored.filter(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    drawn = ranked(open_, order, percent * open_.count() // 100)
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest).withColumnRenamed("doc_id", id_col)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return importance_sample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 of a word's bytes, byte by byte, over the distinct words of both tables.
_SQL = r"""
WITH RECURSIVE table_step(v, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL
    SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM table_step WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM table_step WHERE k = 8),
cut AS (
    SELECT doc_id, 'd' AS side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
    UNION ALL
    SELECT item_id, 'b', regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
),
word_counts AS (
    SELECT side, doc_id, w, count(*) AS n FROM (SELECT side, doc_id, unnest(ws) AS w FROM cut) GROUP BY side, doc_id, w
),
hexed AS (SELECT w, hex(encode(w)) AS hx FROM (SELECT DISTINCT w FROM word_counts)),
crcs AS (
    SELECT w, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, length(hx) // 2), lambda i: ((strpos('0123456789ABCDEF', hx[2 * i + 1]) - 1) * 16 + strpos('0123456789ABCDEF', hx[2 * i + 2]) - 1)::BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295::BIGINT) % 10000 AS bucket
    FROM hexed, crc_table
),
per_bucket AS (
    SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM word_counts JOIN crcs USING (w) GROUP BY bucket
),
totals AS (SELECT sum(s) AS big_s, sum(t) AS big_t FROM per_bucket),
gain AS (
    SELECT bucket, floor(1000 * ln(((t + 1) * (big_s + 10000))::DOUBLE / ((s + 1) * (big_t + 10000))::DOUBLE))::BIGINT AS g FROM per_bucket, totals
),
weighed AS (
    SELECT doc_id, sum(n * g) AS weight FROM word_counts JOIN crcs USING (w) JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id
),
scored AS (
    SELECT doc_id, len(ws) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM cut LEFT JOIN weighed USING (doc_id) WHERE side = 'd'
),
placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END::BIGINT AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

SQL = {"op11_importance_resampling": _SQL}
