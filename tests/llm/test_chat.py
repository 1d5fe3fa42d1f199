import hashlib
import random

from flatlake.llm.chat_windows import TURN_COST, count_words, escape, format_conversations, read_turns, turn_text, unescape, window_digests


def test_escapes_read_back():
    rnd = random.Random(1)
    for _ in range(5000):
        s = "".join(rnd.choice(["\\", "#", "###", "</turn>", "</", "n", "\n", "a", "é"]) for _ in range(rnd.randint(0, 8)))
        assert unescape(escape(s)) == s
        both = turn_text(s, s + "x")[0] + turn_text("u", s)[0]
        assert [(r, t) for r, t, _, _ in read_turns(both)] == [(s, s + "x"), ("u", s)]


def conversations(seed=2):
    rnd = random.Random(seed)
    rows = []
    for c in [None, -3, *range(25)]:
        n = rnd.choice([1, 2, 5, 40])
        for t in range(n):
            role = "system" if t == 0 and rnd.random() < 0.5 else rnd.choice(["user", "assistant", "###", None])
            text = rnd.choice([None, "", " ".join(rnd.choice(["a", "</turn>", "\\n", "###", "é\n"]) for _ in range(rnd.randint(0, 60)))])
            rows.append((c, t, role, text, "x"))
    return rows + [(7, 0, "user", "same turn", "y"), (7, 0, "user", "same turn", "y")]


def test_round_trip_and_mask(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, window string").repartition(4)
    windows = format_conversations(df, budget=80, history=25, history_turns=2)
    got = {r["conv_id"]: r for r in window_digests(windows).collect()}
    want = {}
    for c, t, role, text, _ in rows:
        want.setdefault(c, []).append((t, role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        all_turns = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(learnt))
        assert r["turns_sha256"] == hashlib.sha256(all_turns.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learnt.encode()).hexdigest()


def test_windows_hold_budget_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, i, "user" if i % 2 else "assistant", f"t{i} " * 10) for i in range(1, 30)] + [(1, 30, "assistant", "long " * 300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = sorted(format_conversations(df, budget=60, history=30, history_turns=2).collect(), key=lambda r: r["window"])
    assert len(out) > 5
    seen = []
    for w in out:
        turns = list(read_turns(w["formatted"]))
        assert w["n_tokens"] == sum(TURN_COST + count_words(t) for _, t, _, _ in turns)
        assert w["n_tokens"] <= 60 or len(turns) - w["n_repeated"] == 1
        assert turns[0][:2] == ("system", "be kind")
        assert w["n_repeated"] <= 3
        assert [(s["start"], s["stop"]) for s in w["loss"]] == [(a, b) for i, (r, _, a, b) in enumerate(turns) if r == "assistant" and i >= w["n_repeated"]]
        assert [t[:2] for t in turns[1 : w["n_repeated"]]] == seen[len(seen) - w["n_repeated"] + 1 :] or w["n_repeated"] == 0
        seen += [t[:2] for t in turns[w["n_repeated"] :]]
    assert seen == [(r, t) for _, _, r, t in rows]


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert window_digests(format_conversations(df)).collect() == []
