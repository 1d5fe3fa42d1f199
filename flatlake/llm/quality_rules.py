"""Quality rules whose cutoffs come with a guarantee on wrongly rejected documents.

Every rule rejects on one side of a cutoff of a text statistic.  A labelled
holdout decides, per stratum, which cutoffs may be used: a cutoff passes if the
exact binomial test shows that it rejects less than ``risk / rules`` of good
documents.  Cutoffs of a rule are tested from the loosest on and testing stops
at the first that fails (fixed sequence), at level ``delta / (strata * rules)``
(Bonferroni).  So with probability 1 - delta all rules together reject at most
a share *risk* of the good documents in every stratum at once.
"""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .linking import written
from .textkit import buffer_of, pieces
from .textstats import SYMBOLS, Stats, repeated_words

STEP = 1 << 20
WINDOW = 8
MEASURED = "doc_id bigint, stratum string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_upper bigint"
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1

#: rule -> (statistic, cutoffs from loosest to tightest); a document fails above the cutoff (or below, if marked "<").
RULES: dict[str, tuple[str, str, list[float]]] = {
    "symbols_per_word": ("n_symbols / greatest(n_words, 1)", ">", [2.0, 1.5, 1.0, 0.8, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03]),
    "repeated_words": ("n_repeat_words / greatest(n_words, 1)", ">", [0.8, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05]),
    "duplicate_lines": ("n_dup_lines / greatest(n_lines, 1)", ">", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1]),
    "upper_case": ("n_upper / greatest(word_chars, 1)", ">", [0.9, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1]),
    "short_words": ("word_chars / greatest(n_words, 1)", "<", [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0]),
    "long_words": ("word_chars / greatest(n_words, 1)", ">", [40.0, 30.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0, 7.0]),
}


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Statistics of every whole text (null: no words), one row per input row."""

    def run(batches):
        for batch in batches:
            data, offsets = buffer_of(batch.column(2))
            for lo, hi in pieces(offsets, STEP):
                s = Stats(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                lines, again = s.duplicate_lines()
                columns = [s.n_words, s.word_chars(), s.count(SYMBOLS), again, repeated_words(s.hashes, s.first, WINDOW), lines, s.count(_UPPER)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *(pa.array(c.astype(np.int64)) for c in columns)],
                                                 names=[x.split()[0] for x in MEASURED.split(", ")])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, MEASURED)


def base_failed() -> F.Column:
    return F.expr("n_words < 20 or 100 * n_repeat_words > 30 * n_words")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exactly summed."""
    if k >= n:
        return 1.0
    terms = [lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log(1 - p) for i in range(k + 1)]
    top = max(terms)
    return min(1.0, exp(top) * sum(exp(t - top) for t in terms))


def chosen_cutoff(cutoffs: list[float], good: list[int], bad: list[int], n_good: int, n_bad: int, risk: float, level: float, price: float = 20.0) -> float | None:
    """The certified cutoff of most use: share of bad documents rejected less *price* times that of good ones."""
    best, use = None, 0.0
    for cutoff, wrong, right in zip(cutoffs, good, bad):
        if not n_good or binomial_tail(int(wrong), int(n_good), risk) > level:
            break
        gain = right / max(n_bad, 1) - price * wrong / n_good
        if gain > use:
            best, use = cutoff, gain
    return best


def certified(stats: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """``(stratum, rule, cutoff)`` for every certified rule, from labelled rows (doc_id, quality) of *stats*.

    Rows that the base test rejects take no part; null labels are ignored.
    """
    truth = labels.filter(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("quality").alias("quality"))
    held = stats.filter(~base_failed()).join(truth, "doc_id")
    slots = []
    for rule, (value, side, cutoffs) in RULES.items():
        passed = " + ".join(f"int({value} {side} {c}D)" for c in cutoffs)
        slots.append(F.struct(F.lit(rule).alias("rule"), F.expr(passed).alias("slot")))
    counted = held.select("stratum", "quality", F.explode(F.array(*slots)).alias("s")).groupBy("stratum", "s.rule", "s.slot", "quality").count()
    counted = written(counted, "holdout")
    tests = max(1, counted.select("stratum").distinct().count() * len(RULES))
    names, per_rule, level = list(RULES), risk / len(RULES), delta / tests

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for rule in names:
            cutoffs = RULES[rule][2]
            hist = np.zeros((2, len(cutoffs) + 1))
            for q, slot, n in pdf.loc[pdf["rule"] == rule, ["quality", "slot", "count"]].itertuples(index=False):
                hist[int(q), int(slot)] += n
            # slot s: beyond the s tightest cutoffs, so cutoff j (0 is the loosest) rejects slots len - j and up
            beyond = hist[:, ::-1].cumsum(axis=1)[:, :-1]
            found = chosen_cutoff(cutoffs, beyond[1], beyond[0], hist[1].sum(), hist[0].sum(), per_rule, level)
            if found is not None:
                out.append((pdf["stratum"].iloc[0], rule, found))
        return pd.DataFrame(out, columns=["stratum", "rule", "cutoff"])

    return counted.groupBy("stratum").applyInPandas(choose, "stratum string, rule string, cutoff double")


def rule_verdicts(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Statistics, ``base_failed``, the failed rules and ``kept`` for every row of *docs*.

    Defined cases: a null or empty text has no words and fails the base test; a
    null stratum is a stratum of its own; a stratum without enough labelled
    good documents gets no rules (all that pass the base test are kept); an
    empty table gives an empty result; rows are judged one by one, repeated or
    not; a null id is never labelled; other columns are ignored.
    """
    stats = written(measured(docs, id_col, text_col, stratum_col), "measured")
    cutoffs = written(certified(stats, labels, risk, delta), "cutoffs")
    per_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    if cutoffs.count() <= 10_000:  # at most one row per stratum and rule
        per_stratum = F.broadcast(per_stratum)
    judged = stats.join(per_stratum, "stratum", "left")
    failed = [F.expr(f"case when {value} {side} element_at(cutoffs, '{rule}') then '{rule}' end") for rule, (value, side, _) in RULES.items()]
    judged = judged.withColumn("failed_rules", F.array_compact(F.array(*failed))).withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("cutoffs")


def op9_certified_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = rule_verdicts(docs, labels)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))
