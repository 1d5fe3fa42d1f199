import hashlib
import random
from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from flatlake.llm import alignment as A
from flatlake.llm.bpe_stream import byte_alphabet
from llm_helpers import make_docs, odd_rows

BPE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
BPE.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


ALPHABET = byte_alphabet()


@cache
def bytes_a(i):
    return bytes(ALPHABET[c] for c in BPE.id_to_token(i))


@cache
def bytes_b(i):
    name = PIECES.id_to_piece(i)
    return bytes([int(name[3:5], 16)]) if PIECES.is_byte(i) else name.replace("▁", " ").encode()


def groups_of(text):
    if not text:
        return []
    a = BPE.encode(" " + text, add_special_tokens=False).ids
    b = PIECES.encode(text)
    want = (" " + text).encode()
    if b"".join(map(bytes_a, a)) != want or b"".join(map(bytes_b, b)) != want:
        return []
    ends = []
    for ids, size in ((a, bytes_a), (b, bytes_b)):
        ends.append(np.cumsum([len(size(i)) for i in ids]).tolist())
    both = sorted(set(ends[0]) & set(ends[1]))
    out, start = [], 0
    for e in both:
        out.append(tuple([i for i, at in zip(ids, at_) if start < at <= e] for ids, at_ in ((a, ends[0]), (b, ends[1]))))
        start = e
    return out


def brute(rows):
    groups = [(i, groups_of(t)) for i, t in rows]
    docs = defaultdict(int)
    for _, gs in groups:
        for pair in {(x, y) for a, b in gs for x in a for y in b}:
            docs[pair] += 1
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for i, gs in groups:
        links = [(x, y) for a, b in gs for x in a for y in b]
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        out.append((
            i, sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(links), sum(docs[p] == best[p[0]] for p in links),
            sum(docs[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if gs else "",
        ))
    return sorted(out, key=str)


ROWS = odd_rows(11, n=60, alphabet=("the", "naïve", "tokenization", "x1", "中文字", "😀", "  ", "don't", "<s>", "<0x41>", "<|endoftext|>", "RNA123"), words_of=25) + [
    (None, "no id at all"), (None, None), (4, "shared id"), (4, "shared id"), (500, "a ▁ mark"), (501, " "), (502, "   lead and trail   "),
    (503, "\n\nlines\n \n"), (504, "ꙮ" * 40), (505, "aaaaaaaaaaaaaaaaaaaaaaa" * 20), (506, "\x00\x01 control"), (507, "word " * 900), (508, "=" * 300 + "--" * 77),
]


@pytest.mark.parametrize("sent,fold,cut", [(1 << 18, 1 << 21, 1 << 22), (0, 500, 1000)])
def test_against_both_libraries(spark, monkeypatch, sent, fold, cut):
    monkeypatch.setattr(A, "FOLD", fold)
    monkeypatch.setattr(A, "SLICE", cut)
    got = A.alignment(make_docs(spark, ROWS, 4), sent_pairs=sent)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(ROWS)


def test_segments_encode_like_whole_texts(monkeypatch):
    pieces = A.Pieces(PIECES.serialized_model_proto())
    assert pieces.split
    rnd = random.Random(3)
    bits = [" ", "  ", "a", "the", "12", "é", "中", "ꙮ", "\n", "\t", "<0x0A>", "</s>", "▁", "ing", ".", "　"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(2000)]
    want = [PIECES.encode(t) for t in texts]
    assert [x.tolist() for x in pieces.encode_all([" " + t for t in texts])] == want
    monkeypatch.setattr(A, "KEEP", 50)
    small = A.Pieces(PIECES.serialized_model_proto())
    for i in range(0, 2000, 20):
        assert [x.tolist() for x in small.encode_all([" " + t for t in texts[i : i + 20]])] == want[i : i + 20] and len(small.kept) <= 50


def test_identity_map_prefers_plain_pieces():
    assert A.identity_map([b"a", b"", b"zz", b" x"], [b"a", b"a", b" x"], [True, False, False]).tolist() == [1, -1, -1, 2]


def test_pairs_of_a_large_group_are_formed_in_parts(monkeypatch):
    rnd = np.random.RandomState(1)
    ga, gb = np.sort(rnd.randint(0, 4, 60)), np.sort(rnd.randint(0, 4, 50))
    a, b = rnd.randint(0, 9, 60), rnd.randint(0, 7, 50)
    (ka, na), (kb, nb) = A.folded(ga * 10 + a, np.ones(60, np.int64)), A.folded(gb * 10 + b, np.ones(50, np.int64))
    doc = np.array([0, 0, 1, 2])
    whole = A.crossed(ka // 10, ka % 10, na, kb // 10, kb % 10, nb, doc, 10, 10)
    want = defaultdict(int)
    for g, x in zip(ga, a):
        for h, y in zip(gb, b):
            if g == h:
                want[(doc[g] * 10 + x) * 10 + y] += 1
    assert dict(zip(whole[0].tolist(), whole[1].tolist())) == {int(k): v for k, v in want.items()}
    monkeypatch.setattr(A, "FOLD", 3)
    parts = A.crossed(ka // 10, ka % 10, na, kb // 10, kb % 10, nb, doc, 10, 10)
    assert all((x == y).all() for x, y in zip(whole, parts))


def test_frequent_pairs_stay_under_the_bound(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([1] * 50 + [2] * 20 + [9, 9, 100, 1000])], "pair bigint, n bigint")
    for bound in (0, 1, 2, 4, 30, 100):
        least = A.frequent(counts, bound)
        assert counts.filter(f"n >= {least}").count() <= bound
    assert A.frequent(counts, 100) == 1 and A.frequent(counts.limit(0), 5) == 1


def test_empty_table(spark):
    assert A.alignment(make_docs(spark, [], 1)).count() == 0


def test_bytes_of_all_texts_are_compared_together(monkeypatch):
    monkeypatch.setattr(A, "KEEP", 40)
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as fh:
        here = A.Aligner(A.tokenizer_text(None), fh.read())
    plain = ["", "a", " ", "x  y", "Zoë ran\nhome", "▁mark", "tab\tand \x00 nul", "q" * 200 + " r", "ﬁne", "ten ten ten"] + [f"w{i} v{i}" for i in range(60)]
    for texts in (plain, plain[:9], [], [""]):
        spaced = [" " + t if t else "" for t in texts]
        ids = here.b.encode_all(spaced)
        assert [x.tolist() for x in ids] == [PIECES.encode(t) if t else [] for t in texts]
        assert here.spelled(spaced, ids) == [b"".join(map(bytes_b, x.tolist())) == t.encode() for t, x in zip(spaced, ids)]
        assert len(here.b.kept) <= 40 and all(len(s) <= A.KEEP_CHARS for s in here.b.kept)
