"""Licence recognition by sentences: known sentences to identifiers, identifier sequences to ordered rules.

A text is cut into sentences, each normalised (lower case, everything but a-z
and 0-9 a blank), and looked up among the known sentences; a known sentence may
also run over several lines, with comment leaders or not.  The identifiers
found, in text order, form a sequence; rules are tried in order and each takes
the places where its identifiers stand in a row, so a full licence text is not
reported again as its parts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known sentences (fixed values: wording of public licences and of common notices), by identifier.
SENTENCES: dict[str, list[str]] = {
    "mit-notice": ["Released under the MIT License.", "Licensed under the MIT License.", "This project is licensed under the MIT License.", "MIT License"],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "mit-keep": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "as-is-software": [
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ],
    "apache2-notice": [
        "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\");", "Released under the Apache License, Version 2.0.",
        "This project is licensed under the Apache License, Version 2.0.",
    ],
    "apache2-comply": ["you may not use this file except in compliance with the License.", "You may not use this file except in compliance with the License."],
    "apache2-copy": ["You may obtain a copy of the License at"],
    "apache2-limits": ["See the License for the specific language governing permissions and limitations under the License."],
    "gpl3-notice": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.",
        "This program is licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License, version 3.",
    ],
    "gpl2-notice": ["This work is licensed under the GNU General Public License, version 2.", "Licensed under the GNU General Public License, version 2."],
    "lgpl3-notice": ["Licensed under the GNU Lesser General Public License, version 3."],
    "agpl3-notice": ["Licensed under the GNU Affero General Public License, version 3."],
    "gpl-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "gpl-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"],
    "gpl-details": ["See the GNU General Public License for more details."],
    "gpl-received": ["You should have received a copy of the GNU General Public License along with this program."],
    "bsd-allowed": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "bsd-names": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "bsd3-notice": ["Licensed under the BSD 3-Clause License.", "Released under the BSD 3-Clause License."],
    "bsd2-notice": ["Licensed under the BSD 2-Clause License.", "Released under the BSD 2-Clause License."],
    "mpl2-notice": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0."],
    "isc-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "unlicense-free": ["This is free and unencumbered software released into the public domain."],
    "cc-by-notice": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-sa-notice": ["Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc-by-nc-notice": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-nd-notice": ["Licensed under CC BY-ND 4.0.", "This work is licensed under CC BY-ND 4.0."],
    "cc0-notice": ["Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0."],
    "all-rights-reserved": ["All rights reserved."],
}

#: Rules in the order they are tried: licence and the identifiers that must stand in a row.
RULES: list[tuple[str, list[str]]] = [
    ("MIT", ["mit-notice", "mit-grant", "mit-keep", "as-is-software"]),
    ("MIT", ["mit-grant", "mit-keep", "as-is-software"]),
    ("BSD-3-Clause", ["bsd-allowed", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-allowed", "bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache2-notice", "apache2-comply", "apache2-copy", "apache2-limits"]),
    ("Apache-2.0", ["apache2-notice", "apache2-comply"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-details", "gpl-received"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-grant"]),
    ("Apache-2.0", ["apache2-notice"]),
    ("GPL-3.0", ["gpl3-notice"]),
    ("GPL-2.0", ["gpl2-notice"]),
    ("LGPL-3.0", ["lgpl3-notice"]),
    ("AGPL-3.0", ["agpl3-notice"]),
    ("BSD-3-Clause", ["bsd3-notice"]),
    ("BSD-2-Clause", ["bsd2-notice"]),
    ("MPL-2.0", ["mpl2-notice"]),
    ("ISC", ["isc-grant", "as-is-software"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense-free"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-notice"]),
    ("CC0-1.0", ["cc0-notice"]),
    ("LicenseRef-all-rights-reserved", ["all-rights-reserved"]),
]

#: Sentences end at ., ! or ? (any number) or : or ; before white space, and at line ends.
BREAK = r"[.!?:;]+[ \t\r\f]+|[\r\n]+"


def normalised(sentence: str) -> str:
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def known_sentences(sentences: dict[str, list[str]]) -> dict[str, str]:
    """Normalised sentence -> identifier; a known text of several sentences must be given as several."""
    out: dict[str, str] = {}
    for ident, texts in sentences.items():
        for text in texts:
            parts = [p for p in map(normalised, re.split(BREAK, text)) if p]
            if len(parts) != 1:
                # a break inside: the longest part stands for the sentence
                parts = [max(parts, key=len)]
            if out.setdefault(parts[0], ident) != ident:
                raise ValueError(f"one sentence, two identifiers: {text!r}")
    return out


def _marked(text: Column) -> Column:
    """Normalised text with a mark for every break: S for a single line end, H for a sentence end or blank line.

    Lower case leaves the capitals free for marks.
    """
    steps = [
        (r"(^|[\r\n])[ \t\f]*[.!?:;]+[ \t\f]+", "$1"),  # comment leaders that look like sentence ends
        (r"[.!?:;]+[ \t\r\f]+|[.!?:;]+(?=[\r\n])", "H"),
        (r"\r\n|[\r\n]", "S"),
        (r"[^a-z0-9HS]+", " "),
        (r" ?S ?", "S"),
        (r"[ HS]*H[ HS]*|S{2,}", "H"),
    ]
    text = F.lower(text)
    for pattern, mark in steps:
        text = F.regexp_replace(text, pattern, mark)
    return F.trim(text)


def _found(marked: Column, known: dict[str, str]) -> Column:
    """Identifiers of the known sentences between two breaks, in text order; single line ends inside count as blanks."""
    if not known:
        return F.array().cast("array<string>")
    pattern = "|".join(k.replace(" ", "[ S]") for k in sorted(known, key=len, reverse=True))
    lookup = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    places = F.regexp_extract_all(marked, F.lit(f"(?<![^HS])(?:{pattern})(?![^HS])"), F.lit(0))
    return F.transform(places, lambda s: F.element_at(lookup, F.translate(s, "S", " ")))


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def licence_scan(
    docs: DataFrame, sentences: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of *docs*: ``id_col``, ``n_sentences``, ``sentence_ids`` (array, text order), ``licences`` (array, rule order).

    Column expressions only; a row never leaves its task.  The known sentences
    are a fixed table inside the plan (parameters, not data).

    Defined cases: a null or empty text has no sentences; sentences without a
    letter a-z or digit are not counted; a line end ends a sentence for
    ``n_sentences``, but a known sentence is also found over single line ends if it
    begins and ends with a line or sentence; every occurrence of a known sentence
    counts in ``sentence_ids``, a licence is listed once; rows are judged one by one,
    repeated or not; null ids pass through; an empty table gives an empty
    result; other columns are ignored.
    """
    known = known_sentences(SENTENCES if sentences is None else sentences)
    rules = RULES if rules is None else rules
    marked = docs.select(F.col(id_col).cast("bigint").alias(id_col), _marked(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("marked"))
    found = marked.select(
        id_col, F.size(F.filter(F.split("marked", "[HS]", -1), lambda s: s != "")).cast("bigint").alias("n_sentences"), _found(F.col("marked"), known).alias("sentence_ids"),
    )
    return found.select(id_col, "n_sentences", "sentence_ids", F.when(F.size("sentence_ids") > 0, _matched(rules)).otherwise(F.array().cast("array<string>")).alias("licences"))


def _matched(rules: list[tuple[str, list[str]]]) -> Column:
    """Fold of the ordered rules over the sequence: each takes its places and adds its licence."""
    table = F.array(*(F.struct(F.lit(name).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("row")) for name, ids in rules))
    start = F.struct(F.concat(F.lit(""), F.array_join(F.transform("sentence_ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")).alias("rest"), F.array().cast("array<string>").alias("names"))

    def take(state, rule):
        hit = F.contains(state["rest"], rule["row"])
        return F.struct(
            F.when(hit, F.replace(state["rest"], rule["row"], F.lit("|"))).otherwise(state["rest"]).alias("rest"),
            F.when(hit, F.array_union(state["names"], F.array(rule["name"]))).otherwise(state["names"]).alias("names"),
        )

    return F.aggregate(table, start, take, lambda state: state["names"])


def op4_licence_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = licence_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


def licence_sql() -> str:
    """The same in DuckDB: a join of sentences with the known ones, then one step per rule."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    known = ", ".join(f"({q(s)}, {q(i)})" for s, i in known_sentences(SENTENCES).items())
    steps, rest, names = [], "rest0", []
    for k, (name, ids) in enumerate(RULES, 1):
        row = q("".join(f"<{i}>" for i in ids))
        steps.append(f"s{k} AS (SELECT *, contains(rest{k - 1}, {row}) AS h{k}, replace(rest{k - 1}, {row}, '|') AS rest{k} FROM s{k - 1})")
        names.append(name)
    first = {}
    for k, name in enumerate(names, 1):
        first.setdefault(name, []).append(k)
    # a licence stands where its first matching rule does
    listed = "list_filter([" + ", ".join(
        f"CASE WHEN h{k} AND NOT ({' OR '.join(f'h{j}' for j in first[n] if j < k) or 'false'}) THEN {q(n)} END" for k, n in enumerate(names, 1)
    ) + "], lambda x: x IS NOT NULL)"
    return f"""
WITH known(sentence, ident) AS (VALUES {known}),
parts AS (SELECT doc_id, list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), {q(BREAK)}), lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS clean, row_number() OVER () AS rn FROM documents),
one AS (SELECT rn, unnest(clean) AS sentence, generate_subscripts(clean, 1) AS pos FROM parts),
ids AS (SELECT rn, string_agg(ident, ',' ORDER BY pos) AS ids, string_agg('<' || ident || '>', '' ORDER BY pos) AS row FROM one JOIN known USING (sentence) GROUP BY rn),
s0 AS (SELECT doc_id, len(clean) AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(row, '') AS rest0 FROM parts LEFT JOIN ids USING (rn)),
{", ".join(steps)}
SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, sentence_ids, array_to_string({listed}, ',') AS licences FROM s{len(RULES)}
"""


SQL = {"op4_licence_sentences": licence_sql()}
