"""License scans against the same rules with Python's regular expressions."""

from __future__ import annotations

import random
import re

from sheetspark.llm.license_rules import (
    BASE, BASE_CERTAINTY, CERTAINTY, FAMILIES, GATES, GRANTS, MENTIONS, RULES,
)
from sheetspark.llm.license_scan import find_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(doc_id, text):
    text = text or ""
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    places = {
        label: [i for i in range(len(w)) if tuple(w[i : i + len(phrase)]) == phrase]
        for label, phrase in BASE.items()
    }
    every = sorted(i for x in places.values() for i in x)
    own = sorted(label for label, x in places.items() if x)
    found = set()
    joined = " ".join(w)
    for rule in RULES:
        for m in re.finditer(f"(?<![^ ])(?:{rule.regex})(?![^ ])", joined):
            start = joined[: m.start()].count(" ")
            found.add((start, start + m[0].count(" ") + 1, rule.priority, rule.label))
    kept = [
        d
        for d in found
        if not any(
            e[0] <= d[0]
            and e[1] >= d[1]
            and (e[2] < d[2] or e[2] == d[2] and e[1] - e[0] > d[1] - d[0])
            for e in found
        )
    ]
    sure = max([0.0, BASE_CERTAINTY * bool(own), *(CERTAINTY[d[2]] for d in kept)])
    labels = sorted({*own, *(d[3] for d in kept)})
    return (
        doc_id, len(w), len(every), every[0] if every else None, every[-1] if every else None,
        ",".join(own), ",".join(labels), sure,
    )


def got(df):
    return sorted((tuple(r) for r in find_licenses(df).collect()), key=str)


PARTS = [
    "MIT License", "the", "Apache License, Version 2.0", "GNU General Public License", "v3", "3",
    "licensed under the terms of the", "released under", "(", ")", ".", "é", "GPL", "2.0", "LGPL",
    "BSD", "3-clause BSD license", "SPDX-License-Identifier: MIT", "Creative Commons Attribution",
    "ShareAlike", "4.0", "public domain", "in the public domain", "All rights reserved", "license",
    "Copyright (c) 2024", "Mozilla Public License", "version", "Lesser General Public License",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "word", "\n",
    "dedicated to the public domain", "MIT MIT license license", "licence",
]


def test_rules(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(PARTS, k=rng.randint(1, 14)))) for i in range(600)]
    want = sorted((plain(*r) for r in rows), key=str)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == want
    assert len({r[6] for r in want}) > 100


def test_there_are_hundreds_of_rules():
    assert len(RULES) > 300
    assert all(re.search(re.escape(r.keyword[:3]), r.regex) for r in RULES)


def test_rules_that_need_no_common_word(spark):
    texts = {
        "Distributed under the terms of the GNU GPL v3": ("gpl-3.0", 0.9),
        "Released under MIT": ("mit", 0.8), "Apache 2.0": ("apache-2.0", 0.9),
        "see LGPL-2.1.": ("lgpl-2.1", 0.9), "MPL 2.0": ("mpl-2.0", 0.9),
        "covered under the W3C": ("w3c", 0.8), "Offered under\nEclipse\tPublic": ("epl", 0.8),
        "Common Development and Distribution Public License 1.0": ("cddl-1.0", 0.9),
        "Common Development and Distribution 1.1": ("cddl-1.1", 0.9),
        "A commit to submit": ("", 0.0),
    }
    rows = list(enumerate(texts))
    found = got(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [(r[6], r[7]) for r in found] == list(texts.values())
    assert found == [plain(*r) for r in rows]


def matches(tree):
    """All texts that a parsed pattern of literals, branches and optional parts matches."""
    texts = [""]
    for op, arg in tree:
        match str(op):
            case "LITERAL":
                more = [chr(arg)]
            case "BRANCH":
                more = [x for branch in arg[1] for x in matches(branch)]
            case "SUBPATTERN":
                more = matches(arg[-1])
            case "MAX_REPEAT":
                more = [x * n for n in range(arg[0], arg[1] + 1) for x in matches(arg[2])]
            case "IN":
                more = [chr(x[1] if str(x[0]) == "LITERAL" else x[1][0]) for x in arg]
        texts = [t + m for t in texts for m in more]
    return texts


def test_keywords_and_gates_are_part_of_every_match():
    named = [(keyword, name) for keyword, name, _ in FAMILIES.values()]
    for keyword, regex in named + [x[1:] for x in (*GRANTS, *MENTIONS)]:
        assert all(keyword in m for m in matches(re._parser.parse(regex)))
        assert any(g in keyword for g in GATES)
    assert all(any(g in " ".join(phrase) for g in GATES) for phrase in BASE.values())


def test_edges(spark):
    line = "Released under the MIT License."
    rows = [
        (1, None, 1), (2, "", 2), (None, line, 3), (3, line, 4), (3, line, 4), (3, "GPL licence", 5),
        (4, (line + " word " * 50) * 300, 6), (5, "no words of that kind", 7),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    assert got(df) == sorted((plain(*r[:2]) for r in rows), key=str)
    assert find_licenses(df.limit(0)).count() == 0
