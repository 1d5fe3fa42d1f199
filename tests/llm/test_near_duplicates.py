import random
from math import comb

import pytest

from flatlake.llm import line_dedup, linking, minhash_bayes
from flatlake.llm.line_dedup import dedup_lines, line_classes, similar
from flatlake.llm.linking import components
from flatlake.llm.minhash_bayes import least_matches, near_duplicates

from llm_helpers import make_docs, odd_rows, split_words


def groups_of(sets, linked):
    """Component of every key by comparing every pair that shares an element."""
    parent = {k: k for k in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = {}
    for k in sorted(sets):
        common = {}
        for e in sets[k]:
            for j in having.setdefault(e, []):
                common[j] = common.get(j, 0) + 1
            having[e].append(k)
        for j, n in common.items():
            if linked(n, len(sets[k]) + len(sets[j]) - n):
                a, b = root(k), root(j)
                parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in sets}


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = split_words(low)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def edited_rows(seed, families=8, copies=12):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(families):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(30, 160))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, 5)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((i, rnd.choice([str, str.upper])(" ".join(w))))
            i += 1
    rnd.shuffle(rows)
    return rows + [(i, None), (i + 1, ""), (i + 2, "two words"), (i + 3, "Two  words"), (i + 4, "words two")]


@pytest.mark.parametrize("k, percent, few", [(3, 85, 16), (3, 85, 2), (5, 80, 3)])
def test_documents_against_brute_force(spark, monkeypatch, k, percent, few):
    monkeypatch.setattr(minhash_bayes, "FEW", few)
    monkeypatch.setattr(minhash_bayes, "CENTRE_SAMPLE", 5)
    rows = edited_rows(k)
    sets = {d: shingles(t, k) for d, t in rows}
    want = groups_of(sets, lambda n, u: 100 * n >= percent * u)
    got = near_duplicates(make_docs(spark, rows), k, percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {d: (len(sets[d]), want[d], want[d] == d) for d in sets}


def test_documents_empty_null_and_shared_ids(spark):
    assert near_duplicates(make_docs(spark, [])).collect() == []
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, text), (2, text), (5, "other words here now"), (5, text)], "doc_id bigint, text string")
    got = sorted((r["doc_id"] or 99, r["component_id"], r["kept"]) for r in near_duplicates(df).collect())
    assert got == [(2, 2, True), (5, 2, False), (5, 5, True), (99, 2, False)] or got == [(2, 2, True), (5, 2, False), (5, 2, False), (99, 2, False)]


def test_posterior_bounds():
    for look, m in enumerate(least_matches(0.85, 1e-4), 1):
        tail = lambda x, n=20 * look: sum(comb(n + 1, i) * 0.85**i * 0.15 ** (n + 1 - i) for i in range(x + 1))
        assert tail(m) >= 1e-4 and (m == 0 or tail(m - 1) < 1e-4)


def test_components_of_paths_stars_and_cycles(spark):
    rnd = random.Random(9)
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    edges += [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: root(x) for x in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def line_rows():
    rnd = random.Random(7)
    vocab = ["alpha", "beta", "gamma", "delta", "of", "the", "über", "a"]
    base = [" ".join(rnd.choice(vocab) + str(rnd.randrange(30)) for _ in range(rnd.randint(1, 40))) for _ in range(40)]
    rows = []
    for i in range(90):
        out = []
        for _ in range(rnd.randint(0, 4)):
            line = rnd.choice(base)
            for _ in range(rnd.randint(0, max(1, len(line) // 70))):
                p = rnd.randrange(len(line))
                line = line[:p] + rnd.choice(["x", "yy", ""]) + line[p + 1 :]
            out.append(line)
        rows.append((i, "\n".join(out + rnd.choice([[], [""], ["  "]]))))
    return rows + [(90, None), (91, ""), (92, "ab"), (93, "ab\nab\nabc")]


def brute_lines(rows, similarity=0.8):
    first, places = {}, []
    for d, t in sorted(rows):
        for n, line in enumerate((t or "").split("\n")):
            if split_words(line):
                places.append((d, n, line))
                first.setdefault(line, (d, n))
    sets = {first[x]: {x[i : i + 5] for i in range(len(x) - 4)} or {x} for x in first}
    group = groups_of(sets, lambda n, u: n >= similarity * u)
    return {(d, n): group[first[x]] for d, n, x in places}


def test_lines_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(linking, "SMALL", 3)
    monkeypatch.setattr(linking, "PIVOTS", 2)
    rows = line_rows()
    want = brute_lines(rows)
    df = make_docs(spark, rows)
    got = {(r["id"], r["line_no"]): ((r["class_id"], r["class_line"]), r["kept"]) for r in line_classes(df).collect()}
    assert got == {k: (v, k == v) for k, v in want.items()}
    texts = {r["doc_id"]: (r["text"], r["n_lines_removed"]) for r in dedup_lines(df).collect()}
    for d, t in rows:
        lines = None if t is None else t.split("\n")
        kept = None if t is None else "\n".join(x for n, x in enumerate(lines) if want.get((d, n), (d, n)) == (d, n))
        assert texts[d][0] == kept
    assert dedup_lines(df).columns == [*df.columns, "n_lines_removed"]


def test_lines_of_empty_table_and_odd_rows(spark):
    assert line_classes(make_docs(spark, [])).collect() == []
    rows = [r for r in odd_rows(4, n=20)]
    want = brute_lines(rows)
    got = {(r["id"], r["line_no"]): (r["class_id"], r["class_line"]) for r in line_classes(make_docs(spark, rows)).collect()}
    assert got == want


def linked_pairs(spark, pairs):
    """For each pair of lines, whether both are of one class; every pair is checked against brute force as well."""
    rows = [(2 * i + j, line) for i, pair in enumerate(pairs) for j, line in enumerate(pair)]
    want = brute_lines(rows)
    got = {(r["id"], r["line_no"]): (r["class_id"], r["class_line"]) for r in line_classes(make_docs(spark, rows)).collect()}
    assert got == want
    return [got[2 * i, 0] == got[2 * i + 1, 0] for i in range(len(pairs))]


def test_long_lines_without_white_space(spark):
    rnd = random.Random(11)
    scripts = ["".join(chr(c) for c in range(0x4E00, 0x5200)), "".join(chr(c) for c in range(0x0E01, 0x0E2F)), "ABCDEFGHabcdefgh0123456789+/"]
    pairs = []
    for letters in scripts:
        for n in (170, 359, 1200):
            line = "".join(rnd.choice(letters) for _ in range(n))
            pairs += [(line, "#" + line[1:]), (line[::-1], line[::-1][:7] + "##" + line[::-1][9:])]
    assert linked_pairs(spark, pairs) == [True] * len(pairs)


def test_repeated_content_of_different_length(spark):
    sentence = "The quick brown fox jumps over the lazy dog while seven wizards brew a potion for the old king today."
    pairs = [("-" * 100, "-" * 170), ("=*" * 30, "=*" * 400), (sentence, f"{sentence} {sentence}"), ("多言語の区切り線 " * 8, "多言語の区切り線 " * 60)]
    assert len(sentence) < 110 < 160 < 2 * len(sentence)
    assert linked_pairs(spark, pairs) == [True] * len(pairs)


def test_pairs_compared_in_a_large_family(spark, monkeypatch):
    """Copies that differ from all others by more than the similarity allows are not compared with each member of the family."""
    monkeypatch.setattr(linking, "SMALL", 40)
    rnd = random.Random(5)
    syllables = ["th", "an", "er", "on", "re", "ti", "ed", "sh", "ing", "tion", "ou", "ble", "ly", "and "]
    text = lambda n: "".join(rnd.choice(syllables) for _ in range(n))
    base = [text(3) for _ in range(50)]
    rows = []
    for i in range(600):
        words = list(base)
        for _ in range(rnd.choice([1, 2, 8, 9, 10])):
            words[rnd.randrange(50)] = text(3)
        rows.append((i, " ".join(words)))
    compared, whole = [], line_dedup.linked_components

    def counting(members, sketches, likely, verify, *more):
        def count(pairs):
            compared.append(pairs.count())
            return verify(pairs)

        return whole(members, sketches, likely, count, *more)

    monkeypatch.setattr(line_dedup, "linked_components", counting)
    got = {(r["id"], r["line_no"]): (r["class_id"], r["class_line"]) for r in line_classes(make_docs(spark, rows)).collect()}
    assert got == brute_lines(rows)
    assert sum(compared) < 10 * len(rows)


def test_unlike_short_lines_share_few_bands(spark, monkeypatch):
    """One common shingle does not make a band: unlike lines of few syllables stay out of each other's buckets."""
    rnd = random.Random(8)
    syllables = ["th", "an", "er", "on", "re", "ti", "ed", "sh", "ing", "tion", "ou", "ble"]
    rows = [(i, " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(6)) + " of the") for i in range(800)]
    shared, whole = [], line_dedup.linked_components

    def counting(members, *more):
        shared.append(sum(r["count"] for r in members.groupBy("key").count().filter("count > 1").collect()))
        return whole(members, *more)

    monkeypatch.setattr(line_dedup, "linked_components", counting)
    got = {(r["id"], r["line_no"]): (r["class_id"], r["class_line"]) for r in line_classes(make_docs(spark, rows)).collect()}
    assert got == brute_lines(rows)
    assert shared[0] < len(rows)


def test_fine_sketches_of_many_pairs(spark, monkeypatch):
    """The same classes, whether pairs go through the fine sketches first or not, and no more of them to the texts."""
    rows, compared, whole = line_rows(), [], line_dedup.linked_components
    want = brute_lines(rows)

    def counting(members, sketches, likely, verify, *more):
        def count(pairs):
            compared[-1] += pairs.count()
            return verify(pairs)

        compared.append(0)
        return whole(members, sketches, likely, count, *more)

    monkeypatch.setattr(line_dedup, "linked_components", counting)
    for most in (1000, 0):
        monkeypatch.setattr(linking, "PAIRS_PER_ID", most)
        assert {(r["id"], r["line_no"]): (r["class_id"], r["class_line"]) for r in line_classes(make_docs(spark, rows)).collect()} == want
    assert compared[1] <= compared[0]


def test_every_band_takes_minima_of_all_rows():
    bands = line_dedup._bands()
    assert len(bands) == 24 and all(sorted(j // line_dedup.COLUMNS for j in b) == list(range(line_dedup.ROWS)) for b in bands)
    assert all(sum(j in b for b in bands) == line_dedup.SHIFTS for j in range(line_dedup.MINIMA))
    assert max(len(set(a) & set(b)) for i, a in enumerate(bands) for b in bands[:i]) <= 2
    assert len(set(line_dedup._constants())) == line_dedup.MINIMA and all(-(1 << 31) <= c < 1 << 31 for c in line_dedup._constants())


def test_bit_limits_grow_with_the_sketch():
    limits = line_dedup.bit_limits(0.8)
    assert limits == sorted(limits) and limits[0] <= 1 and 60 < limits[512] < 128
    assert line_dedup.bit_limits(1.0)[-1] <= 1


def test_line_plan_has_no_python(spark):
    df = make_docs(spark, [(1, "a line of text"), (2, "a line of text")])
    plan = dedup_lines(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("similarity", [0.5, 0.8, 1.0])
def test_similar_lines_by_their_texts(spark, similarity):
    texts = ["", "abcd", "abcde", "abcdef", "abcdefghij", "abcdefghiX", "x" * 40, "x" * 41, "Übermäßig lange Zeile", "Übermäßig lange Zeiler", "a b c d e f g h", "a b c d e f g i"]
    sets = [{t[i : i + 5] for i in range(max(1, len(t) - 4))} for t in texts]
    rows = [(i, j, texts[i], texts[j], len(sets[i]), len(sets[j])) for i in range(len(texts)) for j in range(i)]
    df = spark.createDataFrame(rows, "i int, j int, x string, y string, nx int, ny int")
    found = df.filter(similar(df.x, df.y, df.nx, df.ny, similarity)).select("i", "j").collect()
    want = [(i, j) for i, j, *_ in rows if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])]
    assert sorted(map(tuple, found)) == sorted(want)
