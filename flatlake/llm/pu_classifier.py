"""Quality classifier learnt from trusted positives and unlabelled text (non-negative PU risk).

Features are statistics of the text alone.  Each feature is cut into quantile
bins and the score is an additive (logistic) model over the bins.  Training
minimises the non-negative unbiased risk

    prior * E_P[l(f, +)] + max(0, E_U[l(f, -)] - prior * E_P[l(f, -)])

over trusted positives P and unlabelled text U; when the second term falls
below zero its gradient is reversed, which stops the model from fitting the
positives hidden in U as negatives.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .linking import written
from .textkit import U, Prefix, buffer_of, mix, pieces
from .textstats import BEGINS, Stats, _flags, distinct_per_row, per_row, repeated_words

STEP = 1 << 20
#: Training rows at most: trusted positives, unlabelled documents, documents for the prior.
POSITIVES, UNLABELLED, LABELLED = 12_000, 24_000, 24_000
BINS, ROUNDS, RATE, DECAY = 12, 1500, 0.1, 1e-4
#: Share of trusted positives that the zero point may leave below it.
LOST = 0.002

_CLASSES = [_flags(x) for x in ("#", "*", "$", "%", "&", "|", "<>", "!", "?", ".", ",", ";:", "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "aeiou", "\n", "-_=+~^", "()[]{}", "\"'`", "/\\@")]
_HIGH = np.zeros(256, np.int64)
_HIGH[0xC0:] = 1
_CLASSES.append(_HIGH)
_LETTERS = _CLASSES[13] | _HIGH | _flags("abcdefghijklmnopqrstuvwxyz")
_END_PUNCTUATION = np.zeros(256, bool)
_END_PUNCTUATION[np.frombuffer(b"#*$%&|<>!", np.uint8)] = True


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text; an empty text has zeros."""
    s = Stats(data, offsets)
    n = np.maximum(s.n_words, 1).astype(float)
    chars = np.maximum(per_row(BEGINS[data], offsets), 1).astype(float)
    word_chars = s.word_chars()
    size = (s.ends - s.starts).astype(float)
    sums = lambda v: np.bincount(s.row, weights=v, minlength=s.n)
    lines, again = s.duplicate_lines()
    letters = per_row(_LETTERS[data], offsets)
    columns = [np.log1p(s.n_words), np.log1p(lines), word_chars / n, np.sqrt(np.maximum(sums(size**2) / n - (sums(size) / n) ** 2, 0)), s.n_words / np.maximum(lines, 1)]
    columns += [s.count(c) / chars for c in _CLASSES]
    columns.append(letters / np.maximum(word_chars, 1))
    last = data[s.ends - 1] if len(s.ends) else data[:0]
    columns.append(sums(_END_PUNCTUATION[last]) / n)  # words that end in a symbol
    one = sums((size == 1) & ~_LETTERS[data[s.starts]].astype(bool)) / n if len(size) else np.zeros(s.n)
    columns.append(one)
    upper = np.concatenate([[0], np.cumsum(_CLASSES[13][data])])
    columns.append(sums((upper[s.ends] - upper[s.starts] >= 2)) / n)  # words with capitals inside
    columns.append(distinct_per_row(s.hashes, s.row, s.n) / n)
    beside = np.zeros(len(s.hashes))
    beside[1:] = (s.hashes[1:] == s.hashes[:-1]) & (s.row[1:] == s.row[:-1])
    columns.append(sums(beside) / n)
    pairs = Prefix(mix(s.hashes)).grams(2)
    inside = np.flatnonzero(s.row[1:] == s.row[:-1]) if len(pairs) else np.zeros(0, np.int64)
    columns.append(distinct_per_row(pairs[inside], s.row[inside], s.n) / n)
    columns += [repeated_words(s.hashes, s.first, w) / n for w in (3, 8)]
    columns.append(again / np.maximum(lines, 1))
    out = np.stack(columns, axis=1).astype(np.float32)
    out[s.n_words == 0] = 0
    return out


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """``(doc_id, x)`` per input row, with ``row`` if given: the features of the whole text (null: empty)."""
    heads = [F.col(id_col).cast("bigint").alias("doc_id"), *([] if row is None else [row.cast("bigint").alias("row")])]
    names = ["doc_id", *([] if row is None else ["row"])]

    def run(batches):
        for batch in batches:
            data, offsets = buffer_of(batch.column(len(names)))
            for lo, hi in pieces(offsets, STEP):
                x = features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                at = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                kept = [batch.column(i).slice(lo, hi - lo) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(at), pa.array(x.reshape(-1)))], names=[*names, "x"])

    narrow = docs.select(*heads, F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, ", ".join(f"{n} bigint" for n in names) + ", x array<float>")


@dataclass
class Model:
    cuts: list  # per feature, bin limits
    weights: list  # per feature, one weight per bin
    bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for j, (cut, weight) in enumerate(zip(self.cuts, self.weights)):
            out += weight[np.searchsorted(cut, x[:, j], side="right")]
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Full-batch Adam on the non-negative PU risk; no random numbers."""
    both = np.concatenate([unlabelled, positive])
    cuts = [np.unique(np.quantile(both[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(both.shape[1])]
    sizes = [len(c) + 1 for c in cuts]
    shift = np.cumsum([0, *sizes])
    code = lambda x: np.stack([np.searchsorted(c, x[:, j], side="right") + shift[j] for j, c in enumerate(cuts)], axis=1)
    p, u = code(positive), code(unlabelled)
    w, bias = np.zeros(shift[-1]), float(np.log(prior / (1 - prior)))
    m, v = np.zeros((2, shift[-1] + 1))

    def spread(codes, g):
        grad = np.zeros(shift[-1])
        for j in range(codes.shape[1]):
            grad[shift[j] : shift[j + 1]] += np.bincount(codes[:, j] - shift[j], weights=g, minlength=sizes[j])
        return np.append(grad, g.sum())

    for t in range(1, ROUNDS + 1):
        sp, su = sigmoid(w[p].sum(axis=1) + bias), sigmoid(w[u].sum(axis=1) + bias)
        # logistic loss: l(f, +) = -log s, l(f, -) = -log(1 - s)
        negative = -np.log1p(-np.minimum(su, 1 - 1e-12)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        from_positive = spread(p, -prior * (1 - sp) / len(p))
        hidden = spread(u, su / len(u)) - spread(p, prior * sp / len(p))
        grad = from_positive + hidden if negative >= 0 else -hidden
        grad[:-1] += DECAY * w
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        step = RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    # the zero point moves half way up to where the share of U above it is the prior, never past the trusted positives
    zero = min(np.quantile(w[u].sum(axis=1) + bias, 1 - prior), np.quantile(w[p].sum(axis=1) + bias, LOST))
    return Model(cuts, [w[a:b] for a, b in zip(shift[:-1], shift[1:])], bias - 0.5 * max(0.0, float(zero)), prior)


def mixture_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in U from scores of both: the least ratio of upper tails, with a deviation bound."""
    cut = np.quantile(positive, np.linspace(0, 0.9, 91))
    in_p = 1 - np.searchsorted(np.sort(positive), cut) / len(positive)
    in_u = 1 - np.searchsorted(np.sort(unlabelled), cut) / len(unlabelled)
    slack = np.sqrt(np.log(20) / (2 * len(unlabelled))) + np.sqrt(np.log(20) / (2 * len(positive)))
    best = int(np.argmin((in_u + slack) / in_p))
    return float(np.clip(in_u[best] / in_p[best], 0.01, 0.99))


def fitted(x: DataFrame, labels: DataFrame, learn: str) -> Model | None:
    """Model from the rows of ``x(doc_id, x)`` for which the SQL condition *learn* holds; None without a positive.

    The rows used are bounded by POSITIVES, UNLABELLED and LABELLED, picked by
    a hash of the id.  The prior is the share of positives among labelled rows
    if both labels occur, else estimated from the scores of a first model.
    """
    rows = x.filter(learn).filter("doc_id is not null")
    truth = labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("quality")).filter(learn)
    counts = {r["quality"]: r["count"] for r in truth.groupBy("quality").count().collect()}
    if not counts.get(1):
        return None

    def some(df: DataFrame, bound: int) -> np.ndarray:
        # a share by hash first, so that the tasks together send little more than the bound
        share = min(1.0, 1.1 * bound / max(1, df.count()))
        part = df.select("doc_id", "x", F.xxhash64("doc_id", F.lit(5)).alias("h")).filter(F.pmod("h", F.lit(1 << 30)) <= int(share * (1 << 30)))
        got = part.orderBy("h", "doc_id").limit(bound).select("x").toPandas()["x"]
        return np.array(got.tolist(), np.float32).reshape(len(got), -1 if len(got) else 0)

    positive = some(rows.join(truth.filter("quality = 1"), "doc_id"), POSITIVES)
    unlabelled = some(rows, UNLABELLED)
    if not len(positive) or not len(unlabelled):
        return None
    if counts.get(0):
        prior = min(0.99, max(0.01, counts[1] / (counts[0] + counts[1])))
    else:
        first = train(positive, unlabelled, 0.5)
        prior = mixture_prior(first.logits(positive), first.logits(unlabelled))
    return train(positive, unlabelled, prior)


def scored(x: DataFrame, model: Model | None) -> DataFrame:
    """*x* with ``score`` in place of the features; without a model every score is 0.5."""
    names = [c for c in x.columns if c != "x"]
    if model is None:
        return x.select(*names, F.lit(0.5).alias("score"))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                lists = batch.column(len(names))
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                score = sigmoid(model.logits(flat.reshape(batch.num_rows, -1)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*names, "score"])

    return x.mapInArrow(run, ", ".join(f"{n} bigint" for n in names) + ", score double")


#: Labels are learnt where crc32 of the id's text leaves this remainder other than 1.
HELD_OUT = "pmod(crc32(cast(cast(doc_id as string) as binary)), 3) = 1"


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of *docs*, led by ``row`` if given.

    Defined cases: a null text counts as empty and is scored like any other; a
    null id is scored, never learnt from, and not held out; null labels are
    ignored and repeated ones count once (the larger); without a positive
    label every score is 0.5; rows are scored one by one, repeated or not; an
    empty table gives an empty result; other columns are ignored.
    """
    x = written(featured(docs, id_col, text_col, row), "features")
    out = scored(x, fitted(x, labels, f"not ({HELD_OUT})"))
    return out.select(
        *([] if row is None else ["row"]), F.col("doc_id").alias(id_col), F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op10_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))
