import json
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from flatlake.llm import bpe_stream as B
from llm_helpers import make_docs, odd_rows

SPEC = B.tokenizer_text()
MERGES = B.Merges(SPEC)
KEPT = B.Kept(MERGES)
REFERENCE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
REFERENCE.no_truncation()
REFERENCE.no_padding()
BITS = ["e", "t", " ", "  ", "\n", "\t", "é", "中", "😀", "'s", "'ll", "'", "<|endoftext|>", "<|endo", "12", "=-", " ", "\x00", "́", "the", " tion", "\x85"]
TEXTS = st.lists(st.sampled_from(BITS) | st.text(max_size=4), max_size=40).map("".join)


def reference(text):
    return REFERENCE.encode(text, add_special_tokens=False).ids


def in_pieces(encoder, text, cuts):
    out, i = [], 0
    for c in cuts:
        out += encoder.feed(text[i : i + c]).tolist()
        i += c
    return out + encoder.feed(text[i:]).tolist() + encoder.finish().tolist()


@settings(max_examples=400, deadline=None)
@given(TEXTS, st.lists(st.integers(0, 9), max_size=20))
def test_pieces_of_any_size(text, cuts):
    want = reference(text)
    assert B.Encoder(MERGES, KEPT).encode(text).tolist() == want
    assert in_pieces(B.Encoder(MERGES, KEPT), text, cuts) == want
    assert B.Decoder(MERGES).decode(want) == REFERENCE.decode(want, skip_special_tokens=False) == text


def test_special_strings_as_plain_text():
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in ("<|endoftext|>", "a <|endoftext|><|endoftext|> b", " <|endoftext|"):
        assert B.Encoder(MERGES, KEPT, specials=False).encode(text).tolist() == other.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("letters", ["a", "ab", "tionher", "etaoinshrdlu", "0123456789", " ", " \t", "\n ", "=-", "-", "中文é"])
def test_runs_of_any_length(letters):
    rnd = random.Random(len(letters))
    for tail in ("", "a", " b", "<|endoftext|>", " "):
        text = "x " + "".join(rnd.choice(letters) for _ in range(9000)) + tail
        want = reference(text)
        assert in_pieces(B.Encoder(MERGES, KEPT), text, [997] * 9) == want
        encoder = B.Encoder(MERGES, KEPT)
        most = 0
        for i in range(0, len(text), 100):
            encoder.feed(text[i : i + 100])
            most = max(most, len(encoder.held) + len(encoder.tail))
        # constant memory: an open run is held as a window, not whole
        assert most <= B.OPEN + 100 + MERGES.window + encoder.hold


def test_lookahead_of_random_merge_lists():
    """Tokens with the computed number of bytes behind them never change, and fewer bytes are not enough for some list."""
    rnd = random.Random(4)
    tight = 0
    alphabet = [c for c, b in B.byte_alphabet().items() if b in b"ab"]
    others = {c: i for i, c in enumerate(B.byte_alphabet())}
    for _ in range(30):
        vocab, merges = dict(others), []
        parts = list(alphabet)
        while len(merges) < 6:
            x, y = rnd.choice(parts), rnd.choice(parts)
            if x + y not in vocab and len(x + y) < 9:
                vocab[x + y] = len(vocab)
                merges.append([x, y])
                parts.append(x + y)
        m = B.Merges(json.dumps({"model": {"vocab": vocab, "merges": merges}}))
        seen = 0
        for _ in range(50):
            text = "".join(rnd.choice("ab") for _ in range(30)).encode()
            ends = lambda ids: {sum(len(m.bytes[t]) for t in ids[: k + 1]): t for k, t in enumerate(ids)}
            whole = ends(m.merged(text))
            for n in range(1, 30):
                for end, token in ends(m.merged(text[:n])).items():
                    if whole.get(end) != token:
                        seen = max(seen, n - end + 1)
        assert seen <= m.lookahead
        tight += seen == m.lookahead
    assert tight > 0


def test_window_by_window_is_whole():
    rnd = random.Random(8)
    for letters in (b"ab", b"tionher", bytes(range(256))):
        data = bytes(rnd.choice(letters) for _ in range(5000))
        assert MERGES.whole(data) == B.packed(MERGES.merged(data))


def test_words_together(monkeypatch):
    rnd = random.Random(10)
    words = [b"".join(rnd.choice([b"e", b"t", b"th", b"in", b" ", b"\0", "é".encode(), bytes([rnd.randrange(256)])]) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    assert MERGES.together(words) == [B.packed(MERGES.merged(w)) for w in words]
    assert MERGES.together([]) == []
    monkeypatch.setattr(B, "KEEP", 40)
    encoder = B.Encoder(MERGES, B.Kept(MERGES))
    texts = ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 60))) for _ in range(300)] + ["x" * 5000, "", "a" * 70000]
    for size in (1, 7, 303):
        got = [ids.tolist() for i in range(0, len(texts), size) for ids in encoder.encode_all(texts[i : i + size])]
        assert got == [reference(t) for t in texts] and len(encoder.kept) <= 40


def test_broken_bytes_decode_like_the_library():
    rnd = random.Random(9)
    for _ in range(300):
        ids = [rnd.choice([rnd.randrange(50257), MERGES.of_byte[rnd.randrange(256)], 50256]) for _ in range(rnd.randint(0, 12))]
        want = REFERENCE.decode(ids, skip_special_tokens=False)
        decoder = B.Decoder(MERGES)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.feed([], True) == want == B.Decoder(MERGES).decode(ids)


def test_tables(spark):
    rows = odd_rows(6) + [(None, "null id <|endoftext|>"), (3, "shared id"), (3, "shared id"), (9, "z" * 70000 + " " * 70000 + "é" * 9000)]
    tokens = B.encoded(make_docs(spark, rows, 4))
    out = B.decoded(tokens)
    assert out.columns == ["doc_id", "ids", "text"]
    want = [(i, reference(t or ""), t or "") for i, t in rows]
    assert sorted(((r.doc_id, r.ids, r.text) for r in out.collect()), key=str) == sorted(want, key=str)
    assert B.decoded(B.encoded(make_docs(spark, [], 1))).count() == 0
    odd = spark.createDataFrame([(1, None, "x"), (2, [], "y")], "k int, t array<int>, text string")
    assert [tuple(r) for r in B.decoded(odd, id_col="k", ids_col="t").orderBy("k").collect()] == [(1, None, ""), (2, [], "")]
    with pytest.raises(Exception, match="not in the vocabulary"):
        B.decoded(spark.createDataFrame([(1, [50257])], "doc_id int, ids array<int>")).collect()
