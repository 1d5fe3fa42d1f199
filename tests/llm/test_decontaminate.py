import random

import numpy as np
import pytest

from flatlake.llm import decontaminate as d

from llm_helpers import make_docs


def plain_alignment(passage, item):
    best = 0
    h = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i, x in enumerate(item, 1):
        for j, y in enumerate(passage, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
            best = max(best, h[i][j])
    return best


def test_alignment_scores():
    rnd = random.Random(3)
    for _ in range(300):
        p = np.array([rnd.randrange(4) for _ in range(rnd.randint(0, 30))])
        q = np.array([rnd.randrange(4) for _ in range(rnd.randint(0, 12))])
        score, start, stop = d.smith_waterman(p, q)
        assert score == plain_alignment(p.tolist(), q.tolist())
        if score:
            assert 0 <= start < stop <= len(p)
            assert plain_alignment(p[start:stop].tolist(), q.tolist()) == score


def corpus(seed=4):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)] + ["of", "the"] * 200
    text = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.randint(20, 50)).capitalize() + ".") for i in range(20)]
    docs, truth = [], {}
    for i in range(160):
        t = text(rnd.randint(0, 200))
        if i % 4 == 1:
            item, words = rnd.choice(items)[0], None
            words = items[item][1].split()
            if i % 8 == 1:
                words = [w if rnd.random() > 0.12 else rnd.choice(vocab) for w in words]
            t = f"{t} {' '.join(words)} {text(30)}"
            truth[i] = item
        docs.append((i, t))
    return docs + [(500, None), (501, ""), (502, items[3][1].upper()), (502, items[3][1])], items, {**truth, 502: 3}


def test_finds_copies_and_edited_copies_only(spark):
    docs, items, truth = corpus()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items] + [(99, None, "x"), (98, "two words", "x")], "item_id bigint, text string, id string")
    out = {r["doc_id"]: r for r in d.verdicts(make_docs(spark, docs), bench).collect()}
    assert {k for k, r in out.items() if r["contaminated"]} == set(truth)
    assert all(out[k]["item_id"] == item and out[k]["n_items"] == 1 and not out[k]["kept"] for k, item in truth.items())
    for k in [k for k in truth if k % 8 == 5]:
        assert out[k]["score"] == 1.0


def test_every_item_part_has_a_seed_and_hot_items_are_found(spark):
    docs, items, _ = corpus(5)
    hot = [(1000 + i, f"x{i} y{i} {items[0][1]} z{i}") for i in range(60)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["id"], r["item"]) for r in d.contaminated(make_docs(spark, docs + hot), bench).collect()}
    assert {(i, 0) for i, _ in hot} <= found


def edited_copies(intact, seed=7):
    """Copies of items with every fourth word replaced at each phase, and with 4 of 15 words; an intact copy beside them or not."""
    rnd = random.Random(seed)
    text = lambda p, n: [f"{p}{rnd.randrange(5000)}" for _ in range(n)]
    items = [(i, text("w", 40 if i < 6 else 15)) for i in range(12)]
    docs = []
    for i, words in items:
        for phase in range(4):
            at = set(range(phase, 40, 4)) if i < 6 else set(rnd.sample(range(15), 4))
            copy = [f"e{len(docs)}x{k}" if k in at else w for k, w in enumerate(words)]
            docs.append((len(docs), " ".join(text("v", 30) + copy + text("v", 30))))
        if intact:
            docs.append((len(docs), " ".join(text("v", 5) + words)))
    return docs, [(i, " ".join(w)) for i, w in items]


def brute_found(docs, items, least=0.55):
    out = {}
    for i, t in docs:
        for item, words in items:
            score = plain_alignment(t.split(), words.split()) / (2 * len(words.split()))
            if score >= least:
                out[i, item] = score
    return out


@pytest.mark.parametrize("intact", [False, True])
def test_edited_copies_against_plain_alignment(spark, intact):
    docs, items = edited_copies(intact)
    want = brute_found(docs, items)
    assert len(want) >= 30
    found = d.contaminated(make_docs(spark, docs), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r["id"], r["item"]): r["score"] for r in found} == pytest.approx(want)


def test_empty_sides(spark):
    docs, items, _ = corpus(6)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert d.verdicts(make_docs(spark, []), bench).collect() == []
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert all(r["kept"] for r in d.verdicts(make_docs(spark, docs[:5]), none).collect())


def test_reach_without_seeds_against_all_patterns():
    """The bound against every choice of kept and replaced words."""
    rnd = random.Random(1)
    for _ in range(60):
        n = rnd.randint(1, 11)
        seeds = np.array([rnd.random() < 0.6 for _ in range(max(0, n - 2))], bool)
        best = 0
        for mask in range(1 << n):
            kept = [mask >> i & 1 for i in range(n)]
            if any(seeds[p] and all(kept[p : p + 3]) for p in range(n - 2)):
                continue
            score = top = 0
            for k in kept:
                score = max(0, score + (2 if k else -1))
                top = max(top, score)
            best = max(best, top)
        assert d.reach_without(seeds, n) == best


def test_common_grams_are_no_seeds_and_rare_ones_suffice():
    rnd = random.Random(2)
    for n in (15, 40, 64, 65, 200):
        counts = np.array([rnd.choice([0, 1, 3, 5000, 9000]) for _ in range(n - 2)])
        seeds = d.rare_seeds(counts, n, 0.55)
        assert not seeds[counts == 0].any()
        blocked = seeds | (counts == 0)
        everything = d.reach_without(np.ones(n - 2, bool), n)
        if n <= d.STRETCH:
            assert d.reach_without(blocked, n) <= max(everything, int(np.ceil(1.1 * n)) - 1)
        run = 0
        for b in blocked:
            run = 0 if b else run + 1
            assert run < d.RUN - 2
    one = np.full(38, 2)
    one[20] = 10**6
    assert not d.rare_seeds(one, 40, 0.55)[20] and d.rare_seeds(one, 40, 0.55).sum() >= 20


def test_a_phrase_of_every_document_adds_no_candidate(spark):
    rnd = random.Random(8)
    word = lambda p: f"{p}{rnd.randrange(10**6)}"
    item = [word("i") for _ in range(18)] + ["as", "we", "know"] + [word("i") for _ in range(19)]
    docs = [(i, " ".join([word("d") for _ in range(20)] + ["As we know,"] + [word("d") for _ in range(20)])) for i in range(200)]
    docs += [(900, " ".join(item)), (901, " ".join([word("d") for _ in range(30)] + item[5:18] + [word("d") for _ in range(9)])), (902, " ".join(item[5:17]))]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    df = make_docs(spark, docs)
    grams = d.item_grams(bench.select("item_id", "text")).persist()
    narrow = df.select("doc_id", "text")
    counts = d.found_grams(narrow, d.bitmap_of(grams)).groupBy("gram").count().withColumnRenamed("count", "n")
    seeds = d.chosen(grams, counts, 0.55)
    assert 18 not in {r["pos"] for r in seeds.collect()}
    found = {r["id"]: (round(r["score"], 3), r["stop"] - r["start"]) for r in d.contaminated(df, bench).collect()}
    assert found == {900: (1.0, 40), 901: (0.325, 13)}
