"""Near-duplicates against all pairs of full sets, and components against union-find."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from sheetspark.llm.common import text_bytes
from sheetspark.llm.components import components
from sheetspark.llm.near_duplicates import near_duplicates
from sheetspark.llm import near_duplicates as near_module
from sheetspark.llm import shingles

SPACES = " \t\n\r\x0b\x0c"


def plain_set(text, n):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def plain(rows, n=3, percent=85):
    sets = [plain_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j]:
                same = len(a & sets[j])
                if 100 * same >= percent * (len(a) + len(sets[j]) - same):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 2**62), doc_id)
    return sorted(
        (doc_id, len(sets[i]), least[find(i)], doc_id == least[find(i)])
        for i, (doc_id, _) in enumerate(rows)
    )


def families(rng, many, words=120):
    """Texts with copies of copies at all distances, boilerplate and truncated copies."""
    vocabulary = [f"w{i}" for i in range(400)]
    boiler = rng.choices(vocabulary, k=words)
    texts = []
    for _ in range(many):
        base = rng.choices(vocabulary, k=rng.randint(words // 2, words))
        if rng.random() < 0.3:
            base = boiler[: rng.randint(words // 2, words)] + base[: words // 3]
        texts.append(base)
        for _ in range(rng.randint(0, 14)):
            copy = list(rng.choice(texts[-3:]))
            for _ in range(rng.randint(0, 8)):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 2)] = rng.choices(vocabulary[:40], k=rng.randint(0, 2))
            if rng.random() < 0.3:
                copy = copy[: int(len(copy) * rng.uniform(0.8, 1))]
            texts.append(copy or ["w"])
    return [" ".join(w.upper() if rng.random() < 0.05 else w for w in t) for t in texts]


@pytest.mark.parametrize("shingle,percent,wide", [(3, 85, 32), (5, 80, 3)])
def test_all_links_are_found(spark, shingle, percent, wide, monkeypatch):
    monkeypatch.setattr(near_module, "WIDE", wide)
    texts = families(random.Random(2), 60)
    rows = [(7 * i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in near_duplicates(df, shingle, percent).collect())
    want = plain(rows, shingle, percent)
    assert got == want
    assert 20 < sum(not r[3] for r in want) < len(want)


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(60_000))
    rows = [
        (5, "a b c d", 1), (3, "A  b\nc\td", 2), (9, None, 3), (8, "", 4), (7, " \n ", 5),
        (2, "one", 6), (4, "ONE", 7), (6, "one two", 8), (11, "a b c d", 9), (11, "a b c d", 9),
        (12, long, 1), (13, long + " tail", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int")
    got = sorted(tuple(r) for r in near_duplicates(df, 3, 85).collect())
    assert got == plain([r[:2] for r in rows])
    # A null id sorts first; rows that repeat an id with other texts are documents too.
    rows = [(None, "a b c d"), (1, "a b c d"), (1, "e f g h"), (2, "E f g h"), (1, "x y z q")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in near_duplicates(df, 3, 85).collect()]
    assert sorted(got, key=str) == sorted(
        [(None, 2, None, True), (1, 2, None, False), (1, 2, 1, True), (2, 2, 1, False), (1, 2, 1, True)],
        key=str,
    )
    assert near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(500)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df, "test").collect()}
    assert got == {i: find(i) for i in root}


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices("aB é\n\t日", k=rng.randint(0, 40))) for _ in range(200)]
    flat, offsets = text_bytes(pa.array(texts, pa.string()))
    whole = shingles.word_hashes(flat, offsets)
    monkeypatch.setattr(shingles, "BLOCK", 7)
    cut = shingles.word_hashes(flat, offsets)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))
    assert whole[1].tolist() == [len(t.encode().split()) for t in texts]
    words = [w.lower() for t in texts for w in t.encode().split()]
    assert len(set(words)) == len(set(whole[0].tolist()))
    assert len({(w, h) for w, h in zip(words, whole[0].tolist())}) == len(set(words))


def test_a_family_cut_to_many_lengths_is_not_paired_up(spark, monkeypatch):
    """Beginnings of one text, each the nearer to another the nearer in length: few pairs are left."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    rows = [(i, " ".join(words[: rng.randint(600, 3000)])) for i in range(400)]
    counts = {}
    keep = near_module.stored

    def counted(df, label):
        table = keep(df, label)
        if label in ("near-turn", "near-rest"):
            counts[label] = counts.get(label, 0) + table.count()
        return table

    monkeypatch.setattr(near_module, "stored", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(tuple(r) for r in near_duplicates(df, 3, 85).collect())
    lengths = {i: len(t.split(" ")) - 2 for i, t in rows}
    order = sorted(lengths, key=lengths.get)
    component, start = {}, 0
    for k in range(1, len(order) + 1):
        if k == len(order) or 100 * lengths[order[k - 1]] < 85 * lengths[order[k]]:
            least = min(order[start:k])
            component |= {i: least for i in order[start:k]}
            start = k
    assert got == sorted((i, n, component[i], i == component[i]) for i, n in lengths.items())
    assert counts["near-turn"] <= 2 * 2 * near_module.SECONDS * len(rows)
    assert counts["near-rest"] <= 10 * len(rows)
