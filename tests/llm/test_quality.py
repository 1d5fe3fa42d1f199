import random
import zlib
from collections import Counter
from math import comb

import numpy as np
import pytest

from flatlake.llm import pu_classifier as pu
from flatlake.llm.quality_rules import RULES, binomial_tail, chosen_cutoff, measured, rule_verdicts

from llm_helpers import make_docs, odd_rows, split_words


def brute_stats(text):
    words = split_words(text)
    lines = [x for x in (text or "").split("\n") if split_words(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if many[g] > 1:
            covered.update(range(i, i + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_statistics_against_brute_force(spark):
    rnd = random.Random(8)
    rows = odd_rows(6) + [(900 + i, "".join(rnd.choice("ab é#*|\n\t!A") for _ in range(rnd.randint(0, 80)))) for i in range(80)]
    got = measured(make_docs(spark, rows), stratum_col="key").collect()
    assert {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got} == {d: brute_stats(t) for d, t in rows}


def test_binomial_tail_is_exact():
    for k, n, p in [(0, 10, 0.1), (3, 20, 0.3), (7, 50, 0.05), (10, 10, 0.5)]:
        assert binomial_tail(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)), rel=1e-9)


def test_cutoffs_keep_the_promise():
    # stops at the first cutoff without a certificate, even if a later one had one
    assert chosen_cutoff([3, 2, 1], [0, 400, 0], [10, 50, 90], 1000, 100, 0.01, 0.01) == 3
    assert chosen_cutoff([3, 2], [0, 900], [10, 90], 1000, 100, 0.01, 0.01) == 3
    assert chosen_cutoff([3, 2], [0, 0], [10, 90], 1000, 100, 0.01, 0.01) == 2
    assert chosen_cutoff([3, 2], [0, 0], [10, 90], 100, 100, 0.01, 0.01) is None  # too few to certify
    # simulated: true false-rejection rate above the risk is certified no more often than the level allows
    rng = np.random.RandomState(0)
    wrong = sum(binomial_tail(rng.binomial(800, 0.011), 800, 0.01) <= 0.05 for _ in range(2000))
    assert wrong <= 0.05 * 2000 * 1.3


def labelled(n=3000, seed=5):
    rnd = random.Random(seed)
    vocab = [f"{a}{b}ing" for a in "abcdefgh" for b in "klmnop"] + ["of", "the", "and"]
    rows, quality = [], []
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(25, 60))]
        good = rnd.random() < 0.8
        if not good:
            words = rnd.choice([[w + "###" for w in words], [w.upper() + "!!" for w in words], [w for w in words[:6] for _ in range(7)]])
        rows.append((i, " ".join(words) + "."))
        quality.append((i, int(good)))
    return rows, quality


def test_rules_reject_junk_and_keep_good(spark):
    rows, quality = labelled()
    labels = spark.createDataFrame(quality + [(1, None), (10**6, 1)], "doc_id bigint, quality int")
    out = {r["doc_id"]: r for r in rule_verdicts(make_docs(spark, rows + [(-1, None), (-2, "")]), labels, stratum_col="key").collect()}
    good = [d for d, q in quality if q]
    bad = [d for d, q in quality if not q]
    assert sum(not out[d]["kept"] for d in good) <= 0.05 * len(good)
    assert sum(not out[d]["kept"] for d in bad) >= 0.6 * len(bad)
    assert out[-1]["base_failed"] and not out[-1]["kept"] and out[-2]["base_failed"]
    for d, r in out.items():
        n, rep = r["n_words"], r["n_repeat_words"]
        assert r["base_failed"] == (n < 20 or 100 * rep > 30 * n)
        assert r["kept"] == (not r["base_failed"] and not r["failed_rules"])


def test_rules_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    text = " ".join(f"word{i}" for i in range(30))
    out = rule_verdicts(make_docs(spark, [(1, text), (1, text), (None, text)]), none, stratum_col="key").collect()
    assert [r["kept"] for r in out] == [True] * 3
    assert rule_verdicts(make_docs(spark, []), none, stratum_col="key").collect() == []
    assert len(RULES) == 6


def test_classifier_on_held_out_rows(spark):
    rows, quality = labelled(1500, seed=6)
    labels = spark.createDataFrame(quality + [(7, None)], "doc_id bigint, quality int")
    out = {r["doc_id"]: r for r in pu.quality_scores(make_docs(spark, rows + [(-1, None), (-2, "")]), labels).collect()}
    for d, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(d, q) for d, q in quality if out[d]["held_out"]]
    assert sum(out[d]["predicted"] == q for d, q in held) >= 0.97 * len(held)


def test_classifier_ignores_held_out_labels(spark):
    rows, quality = labelled(400, seed=7)
    flipped = [(d, 1 - q if zlib.crc32(str(d).encode()) % 3 == 1 else q) for d, q in quality]
    df = make_docs(spark, rows)
    scores = [sorted((r["doc_id"], r["score"]) for r in pu.quality_scores(df, spark.createDataFrame(x, "doc_id bigint, quality int")).collect()) for x in (quality, flipped)]
    assert scores[0] == scores[1]


def test_classifier_without_positives_and_empty(spark):
    none = spark.createDataFrame([(1, 0)], "doc_id bigint, quality int")
    assert {r["score"] for r in pu.quality_scores(make_docs(spark, [(1, "a"), (None, None)]), none).collect()} == {0.5}
    assert pu.quality_scores(make_docs(spark, []), none).collect() == []


def test_prior_from_scores():
    rng = np.random.RandomState(1)
    positive = rng.normal(2, 1, 4000)
    unlabelled = np.concatenate([rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)])
    assert abs(pu.mixture_prior(positive, unlabelled) - 0.7) < 0.06


def test_negative_risk_is_not_overfitted():
    rng = np.random.RandomState(2)
    x = rng.normal(size=(300, 3)).astype(np.float32)
    model = pu.train(x, x.copy(), 0.7)  # unlabelled text that is all positive
    assert (pu.sigmoid(model.logits(x)) >= 0.5).mean() > 0.9
