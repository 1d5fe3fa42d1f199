import re
import textwrap

import duckdb
import pandas as pd
import pytest

from flatlake.llm.licenses import BREAK, RULES, SENTENCES, known_sentences, licence_scan, licence_sql, normalised, op4_licence_sentences

from llm_helpers import make_docs


def brute(text):
    known = known_sentences(SENTENCES)
    parts = [p for p in (normalised(x) for x in re.split(BREAK, text or "")) if p]
    ids = [known[p] for p in parts if p in known]
    seq, names = list(ids), []
    for name, row in RULES:
        i, hit = 0, False
        while i <= len(seq) - len(row):
            if seq[i : i + len(row)] == row:
                seq[i : i + len(row)] = [None]
                hit = True
            i += 1
        if hit and name not in names:
            names.append(name)
    return len(parts), ids, names


def texts():
    one = {i: s[0] for i, s in SENTENCES.items()}
    mit = "\n".join(one[i] for i in ("mit-notice", "mit-grant", "mit-keep", "as-is-software"))
    out = [mit, mit.upper(), mit.replace(" ", "  ").replace(",", " ,"), None, "", "!!! ...", "plain text. nothing known", *one.values()]
    out += ["\n".join(one[i] for i in row) for _, row in RULES]
    out += [f"{one['mit-notice']} {one['cc0-notice']}\n{mit}\n{one['mit-notice']}", "\n".join([one["bsd-allowed"], one["bsd-source"], "unknown here.", one["bsd-binary"]])]
    return out + ["long text without a licence. " * 3000 + one["gpl3-notice"]]


def test_against_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r["doc_id"]: (r["n_sentences"], r["sentence_ids"], r["licences"]) for r in licence_scan(make_docs(spark, rows)).collect()}
    assert got == {d: brute(t) for d, t in rows}
    assert got[0][2] == ["MIT"]


def test_against_sql(spark, tmp_path):
    documents = pd.DataFrame({"doc_id": range(len(texts())), "text": texts()})
    documents.to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.register("documents", documents)
    want = sorted(con.execute(licence_sql()).fetchall())
    assert sorted(map(tuple, op4_licence_sentences(spark, str(tmp_path)).collect())) == want


def wrapped_rules():
    """The text of every rule, wrapped at several widths behind several comment leaders."""
    out = []
    for name, row in RULES:
        parts = [SENTENCES[i][0] for i in row]
        for width, leader, gap in [(76, "", "\n"), (72, "# ", "\n#\n"), (60, " * ", "\r\n *\r\n"), (40, "// ", "\n"), (70, ";; ", "\n;;\n")]:
            end = "\r\n" if "\r" in gap else "\n"
            text = gap.join(end.join(textwrap.wrap(p, width, initial_indent=leader, subsequent_indent=leader)) for p in parts)
            out.append((row, f"Some Heading{end}{text}{end}some code here"))
    return out


def test_wrapped_texts(spark):
    cases = wrapped_rules()
    got = {r["doc_id"]: r for r in licence_scan(make_docs(spark, [(i, t) for i, (_, t) in enumerate(cases)])).collect()}
    for i, (row, text) in enumerate(cases):
        assert got[i]["sentence_ids"] == row, text
        assert got[i]["n_sentences"] == brute(text)[0]
    one = {i: s[0] for i, s in SENTENCES.items()}
    apart = [one["isc-grant"].replace("purpose with", "purpose\n\nwith"), "x " + one["isc-grant"], one["isc-grant"].replace(" with", ". with")]
    assert [r["sentence_ids"] for r in licence_scan(make_docs(spark, list(enumerate(apart)))).collect()] == [[]] * 3


def test_odd_rows_and_plan(spark):
    df = make_docs(spark, [(None, "MIT License"), (1, "MIT License"), (1, "MIT License")])
    assert [r["licences"] for r in licence_scan(df).collect()] == [["MIT"]] * 3
    assert licence_scan(make_docs(spark, [])).collect() == []
    plan = licence_scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_sentence_has_one_identifier():
    with pytest.raises(ValueError):
        known_sentences({"a": ["Same text."], "b": ["same  TEXT"]})
