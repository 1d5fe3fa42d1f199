import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def split_words(text):
    return WORD.findall(text or "")


def make_docs(spark, rows, parts=3):
    """(doc_id, text) rows with further columns whose names the operators use inside."""
    full = [(d, t, "x", 1, b"b", 2.0, "k", "c") for d, t in rows]
    schema = "doc_id bigint, text string, id string, n int, payload binary, score double, key string, component string"
    return spark.createDataFrame(full, schema).repartition(parts)


def odd_rows(seed=1, n=120, alphabet=("a", "b", "é", "cc", "D", "x1"), words_of=40):
    """Random texts with shared passages, copies, nulls, empty, blank and one long text."""
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, words_of))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = rnd.choice([" ", "\n", "\t"]).join(rnd.choice(base)[: rnd.randint(0, 300)] for _ in range(rnd.randint(0, 4)))
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, rows[5][1]), (n + 4, rows[5][1])]
    rows.append((n + 5, " ".join(rnd.choice(base) for _ in range(400))))
    return rows
