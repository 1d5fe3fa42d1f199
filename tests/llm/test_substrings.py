import hashlib
import random

import numpy as np
import pytest

from flatlake.llm import anchored
from flatlake.llm.automaton_dedup import SuffixAutomaton, dedup_word_windows
from flatlake.llm.sais import permuted_common_prefixes, suffix_array
from flatlake.llm.suffix_dedup import dedup_substrings

from llm_helpers import make_docs, odd_rows, split_words


def sha(b):
    return hashlib.sha256(b).hexdigest()


@pytest.mark.parametrize("alphabet", [1, 2, 3, 26, 256])
def test_suffix_array_and_common_prefixes(alphabet):
    rnd = random.Random(alphabet)
    for n in [1, 2, 3, 7, 40, 200]:
        data = np.array([rnd.randrange(alphabet) for _ in range(n)], np.uint8)
        raw = data.tobytes()
        want = sorted(range(n), key=lambda i: raw[i:])
        sa = suffix_array(data)
        assert sa.tolist() == want
        before, common = permuted_common_prefixes(data, sa, 12)
        for r in range(1, n):
            i, j, k = want[r], want[r - 1], 0
            while max(i, j) + k < n and raw[i + k] == raw[j + k] and k < 12:
                k += 1
            assert (before[i], common[i]) == (j, k)


def test_suffix_array_of_nothing_and_of_one_repeated_byte():
    assert len(suffix_array(np.zeros(0, np.uint8))) == 0
    assert suffix_array(np.full(500, 7, np.uint8)).tolist() == list(range(499, -1, -1))


def test_automaton_finds_first_documents():
    rnd = random.Random(4)
    texts = [[rnd.randrange(3) for _ in range(rnd.randint(0, 30))] for _ in range(8)]
    a = SuffixAutomaton()
    for d, t in enumerate(texts):
        a.add(t, d)
    for t in texts:
        found = dict(a.first_documents(t, 4))
        for end in range(4, len(t) + 1):
            gram = t[end - 4 : end]
            want = min(d for d, u in enumerate(texts) if any(u[i : i + 4] == gram for i in range(len(u) - 3)))
            assert found[end] == want


def brute_bytes(rows, length):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = [True] * length
            seen.add(w)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[d] = (len(b), sum(gone), spans, sha(bytes(c for c, g in zip(b, gone) if not g)))
    return out


def brute_words(rows, window):
    first = {}
    split = {d: split_words(t) for d, t in rows}
    for d in sorted(split):
        for s in range(len(split[d]) - window + 1):
            first.setdefault(tuple(split[d][s : s + window]), d)
    out = {}
    for d, w in split.items():
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < d:
                gone[s : s + window] = [True] * window
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode()))
    return out


def run_bytes(df, length):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], sha(bytes(r["kept"]))) for r in dedup_substrings(df, length).collect()}


def run_words(df, window):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], sha(r["kept"].encode())) for r in dedup_word_windows(df, window).collect()}


def every_second_anchor(docs, spec, n_docs):
    """A hot list that holds many anchors, to send them the other way."""
    rows = [r for r in docs.select("_id", "_text").collect()]
    import pyarrow as pa

    table = pa.table({"_id": [r[0] for r in rows], "_text": pa.array([r[1] for r in rows], pa.string())})
    found = [a for *_, a, _, _, _, _ in anchored.listed(anchored.Rows(table), spec, np.zeros(0, np.uint64))]
    return np.unique(np.concatenate(found))[::2]


def test_bytes_against_brute_force(spark):
    rows = odd_rows(1)
    assert run_bytes(make_docs(spark, rows), 20) == brute_bytes(rows, 20)


def test_words_against_brute_force(spark):
    rows = odd_rows(2)
    assert run_words(make_docs(spark, rows), 6) == brute_words(rows, 6)


def test_hot_anchors_only_route(spark, monkeypatch):
    rows = odd_rows(3, n=60)
    monkeypatch.setattr(anchored, "hot_anchors", every_second_anchor)
    assert run_bytes(make_docs(spark, rows), 20) == brute_bytes(rows, 20)
    assert run_words(make_docs(spark, rows), 6) == brute_words(rows, 6)


def test_small_batches_and_steps(spark, monkeypatch):
    rows = odd_rows(5, n=60)
    monkeypatch.setattr(anchored, "BATCH_BYTES", 3000)
    monkeypatch.setattr(anchored, "STEP", 500)
    assert run_bytes(make_docs(spark, rows), 20) == brute_bytes(rows, 20)
    assert run_words(make_docs(spark, rows), 6) == brute_words(rows, 6)


def test_empty_table_null_id_and_shared_id(spark):
    assert run_bytes(make_docs(spark, []), 20) == {}
    assert run_words(make_docs(spark, []), 6) == {}
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(None, text), (3, text), (7, "alpha " + text), (7, "beta " + text)], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 99, r["n_removed"]) for r in dedup_word_windows(df, 6).collect())
    assert got == [(3, 0), (7, 10), (7, 10), (99, 10)]
    df = spark.createDataFrame([(1, text), (1, text), (None, "x" + text)], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 99, r["n_removed"]) for r in dedup_substrings(df, 20).collect())
    assert got == [(1, 0), (1, len(text)), (99, len(text))]
