"""Decontamination against every window of every text."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from sheetspark.llm import decontaminate
from sheetspark.llm.decontaminate import contamination, without_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(documents, items):
    windows = {}
    for item_id, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in documents:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        found = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def fixture(rng):
    vocabulary = ["a", "b", "É", "été", "x1", "The", "of", "日本"]
    items = [
        (i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 14, 30]))))
        for i in range(40)
    ]
    items = [(i, t) for i, t in items if len(t.split()) not in (1, 3)] + [(90, "b b x1"), (91, None)]
    documents = []
    for i in range(150):
        parts = rng.choices(vocabulary, k=rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1]
            w = w.split() if w else []
            cut = w[rng.randint(0, 3) : len(w) - rng.randint(0, 3)]
            at = rng.randint(0, len(parts))
            parts[at:at] = [c.upper() if c.isascii() else c for c in cut]
        documents.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    return documents, items


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_windows(spark, broadcast):
    documents, items = fixture(random.Random(9))
    got = contamination(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        broadcast,
    )
    want = plain(documents, items)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert 0 < sum(r[5] for r in want) < len(want)


def test_edges(spark):
    passage = "one two three four five six seven eight nine ten"
    documents = [
        (1, None, 1), (2, "", 2), (None, passage, 3), (3, passage, 4), (3, passage, 4),
        (3, "other " * 20_000 + passage + " and " + passage, 5), (4, "one two three four", 6),
    ]
    items = [(1, passage, "x"), (1, passage + " eleven", "y"), (None, passage, "z"), (2, None, "")]
    df = spark.createDataFrame(documents, "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    want = plain([r[:2] for r in documents], [r[:2] for r in items])
    assert sorted((tuple(r) for r in contamination(df, bench).collect()), key=str) == want
    assert [r.n_hit for r in contamination(df, bench.limit(0)).collect()] == [0] * 7
    assert contamination(df.limit(0), bench).count() == 0


def test_a_stem_of_many_items_and_documents(spark, monkeypatch):
    stem = "a stem that very many items and documents share"
    n = 200
    items = [(i, f"{stem} i{i} end") for i in range(n)]
    documents = [(i, f"before d{i} {stem} d{i} end") for i in range(n)]
    documents += [(n + i, f"x {stem} i{i} y") for i in range(3)]
    rows = []

    def counted(df, label):
        out = decontaminate_stored(df, label)
        rows.append(out.count())
        return out

    decontaminate_stored = decontaminate.stored
    monkeypatch.setattr(decontaminate, "stored", counted)
    docs = spark.createDataFrame(documents, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contamination(docs, bench)
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(documents, items)
    # A document has a handful of windows about the stem, however many items have it.
    assert max(rows) < 20 * n
    kept = {r.doc_id for r in without_contaminated(docs, bench).collect()}
    assert kept == set(range(n))


def test_windows_of_many_items(spark):
    passage = "one two three four five six seven eight nine ten"
    items = [(i, passage) for i in range(30)] + [(50 + i, f"{passage} {i} more") for i in range(9)]
    documents = [(i, f"{passage} {i % 9} more" if i % 2 else passage) for i in range(60)]
    documents += [(99, "one two")]
    got = contamination(
        spark.createDataFrame(documents, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(documents, items)
