import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from flatlake.llm import importance as I
from llm_helpers import make_docs, odd_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grams_of(text, most):
    ws = WORD.findall(lower(text))
    return [" ".join(ws[i : i + k]) for k in range(1, most + 1) for i in range(len(ws) - k + 1)]


def brute(rows, target, most=1, buckets=10000, percent=10, least=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, grams_of(text, most)))
    for text in target:
        t.update(map(bucket, grams_of(text, most)))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    out = []
    for i, text in rows:
        fs = grams_of(text, most)
        weight = sum(gain(bucket(f)) for f in fs)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(WORD.findall(lower(text))), len(fs), weight, score, None])
    open_ = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for k, r in enumerate(open_[: percent * len(open_) // 100], 1):
        r[5] = k
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("most,buckets,percent,least", [(1, 10000, 10, 20), (3, 500, 35, 5)])
def test_against_brute_force(spark, most, buckets, percent, least):
    rows = odd_rows(3, words_of=60) + [(None, "a b C1 " * 30), (None, "a b C1 " * 30), (7, "é " * 50), (7, "x-y_z " * 40), (None, None)]
    target = ["a é x1", None, "", "D cc D", "new words here"]
    items = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(target)], "item_id int, text string, doc_id string")
    out = I.importance_sample(make_docs(spark, rows, 5), items, grams=most, buckets=buckets, percent=percent, least_words=least)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, target, most, buckets, percent, least)


def test_small_dictionary_gives_the_same_payloads():
    rnd = random.Random(5)
    text = " ".join(rnd.choice(["alpha", "b", "Ünï", "x" * 90, "word", "9"]) + rnd.choice(["", ".", "--", "\n"]) for _ in range(3000)).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 0, 700, len(text), len(text)])
    want = None
    for words, piece in ((1 << 16, 1 << 22), (2, 64), (0, 1)):
        dictionary = I.Dictionary(words)
        old, I.PIECE = I.PIECE, piece
        try:
            got = [I.scanned(dictionary, data, offsets) for _ in range(3)]
        finally:
            I.PIECE = old
        for payload, first in got:
            want = payload.tolist() if want is None else want
            assert payload.tolist() == want and first.tolist() == got[0][1].tolist()
        assert len(dictionary.known) <= words and "x" * 90 not in dictionary.known
    words_of = [w.encode() for part in (text[:700], text[700:]) for w in WORD.findall(lower(part.decode("utf-8", "ignore")))]
    assert want[:50] == [len(w) << 32 | zlib.crc32(w) for w in words_of][:50]


def test_composed_checksums():
    rnd = random.Random(2)
    parts = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 7, 300, 70000]))) for _ in range(40)]
    x, y = parts[:20], parts[20:]
    crc = lambda p: np.array([zlib.crc32(b) for b in p], np.uint32)
    got = I.composed(crc(x), crc(y), np.array([len(b) for b in y], np.int64))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(x, y)]


def test_empty_tables(spark):
    docs = make_docs(spark, [], 1)
    items = spark.createDataFrame([], "item_id int, text string")
    assert I.importance_sample(docs, items).count() == 0
    one = make_docs(spark, [(1, "w " * 25)], 1)
    assert tuple(I.importance_sample(one, items, percent=100).first())[-1] == 1
