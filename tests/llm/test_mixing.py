import math
from collections import defaultdict

import pytest

from flatlake.llm.mixing import crossing, exponent, mixed


def stats(spark, shares, budget_share=1.0):
    return spark.createDataFrame([(p, p / budget_share) for p in shares], "p double, reach double")


def weights(shares, a):
    w = [p**a for p in shares]
    return [x / sum(w) for x in w]


def entropy(w):
    return -sum(x * math.log(x) for x in w) / math.log(len(w))


def test_exponent_meets_entropy(spark):
    shares = [0.5, 0.3, 0.15, 0.05]
    df = stats(spark, shares)
    a = crossing(df, "entropy >= 0.95D")
    assert entropy(weights(shares, a)) >= 0.95 > entropy(weights(shares, a + 2e-6))
    assert crossing(df, "entropy >= 0.1D") == 1.0
    assert crossing(df, "entropy >= 2.0D") == 0.0


def test_exponent_keeps_the_repetition_limit(spark):
    shares = [0.7, 0.29, 0.01]
    df = stats(spark, shares)
    a = exponent(df, 0.999, 3.0)
    most = max(w / p for w, p in zip(weights(shares, a), shares))
    assert most <= 3.0 and max(w / p for w, p in zip(weights(shares, a - 4e-6), shares)) > 3.0


def rows(n=600):
    out = []
    for i in range(n):
        source = "big" if i % 3 else f"s{i % 9}"
        out.append((i, " ".join(["w"] * (i % 7)), source, "x", 1))
    return out + [(n, None, "big", "x", 1), (n + 1, "a b", None, "x", 1), (5, "w w w w w", "big", "x", 1), (None, "a b c", "big", "x", 1), (n + 2, "", "void", "x", 1)]


@pytest.mark.parametrize("budget", [None, 5000, 300])
def test_quotas_epochs_and_blocks(spark, budget):
    data = rows()
    df = spark.createDataFrame(data, "doc_id bigint, text string, source string, epoch string, tokens int").repartition(3)
    out = mixed(df, least_entropy=0.9, most_repetition=3.0, budget=budget, block=200).collect()
    tokens = defaultdict(int)
    for _, t, s, *_ in data:
        tokens[s or ""] += len((t or "").split())
    total = sum(tokens.values())
    budget = budget or total
    live = {s: n for s, n in tokens.items() if n}
    got, times = defaultdict(int), defaultdict(lambda: defaultdict(int))
    for r in out:
        got[r["source"]] += r["n_tokens"]
        times[r["source"]][r["epoch"]] += 1
    shares = [n / total for n in live.values()]
    df2 = spark.createDataFrame([(n / total, n / budget) for n in live.values()], "p double, reach double")
    a = exponent(df2, 0.9, 3.0)
    assert set(got) <= set(live)
    for s, w in zip(live, weights(shares, a)):
        quota = math.floor(w * budget)
        assert quota - 7 < got[s] <= quota  # within the longest document of the quota
        assert w * budget / live[s] <= max(3.0, budget / total) + 1e-9
        n_docs = sum(1 for _, t, x, *_ in data if (x or "") == s)
        full = quota // live[s]
        assert all(times[s][e] == n_docs for e in range(full))
    by_block = defaultdict(lambda: defaultdict(int))
    for r in out:
        by_block[r["block"]][r["source"]] += r["n_tokens"]
    blocks = max(1, -(-budget // 200))
    assert set(by_block) <= set(range(blocks))
    for s, w in zip(live, weights(shares, a)):
        for b in range(blocks - 1):
            assert abs(by_block[b][s] - w * budget / blocks) <= 14  # two documents


def test_permutations_differ_and_empty(spark):
    df = spark.createDataFrame([(i, "a b c", "s") for i in range(50)], "doc_id bigint, text string, source string")
    out = mixed(df, budget=300, most_repetition=10.0).collect()
    orders = {e: [r["doc_id"] for r in sorted((r for r in out if r["epoch"] == e), key=lambda r: r["order_key"])] for e in (0, 1)}
    assert sorted(orders[0]) == sorted(orders[1]) == list(range(50)) and orders[0] != orders[1]
    assert mixed(df.limit(0)).collect() == []
