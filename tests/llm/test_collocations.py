"""Collocations against counts in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from sheetspark.llm import collocations as module
from sheetspark.llm.collocations import _score, collocations

SCHEMA = "doc_id long, text string, lang string, n int, word string, block int"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least=100, longest=5, percent=100, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            sizes[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    found = []
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        gone = set()
        for x in candidates:
            for m in range(2, len(x)):
                for i in range(len(x) - m + 1):
                    if 100 * f[x] >= percent * f[x[i : i + m]]:
                        gone.add(x[i : i + m])
        scored = []
        for p in set(candidates) - gone:
            n = sizes[lang]
            cuts = [(1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(found)


def same(df, **how):
    want = plain([(r.text, r.lang) for r in df.collect()], **how)
    assert sorted(tuple(r) for r in collocations(df, **how).collect()) == want
    return want


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 4_000)
    monkeypatch.setattr(module, "SLICE", 900)
    monkeypatch.setattr(module, "BUDGET", 300)
    monkeypatch.setattr(module, "PART", 150)


def test_documents(spark):
    assert same(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), least=20)


def test_long_prefixes(spark, small):
    """Few words, all over the budget of a prefix: nodes are counted in many groups."""
    rng = random.Random(1)
    rows = [
        (i, " ".join(rng.choices("aBcde", k=rng.randint(0, 60))) + rng.choice([".", "", "\x0b q"]),
         rng.choice(["en", "fr", None]), 0, "w", 1)
        for i in range(400)
    ]
    want = same(spark.createDataFrame(rows, SCHEMA).repartition(6), least=30)
    assert {len(r[2].split(" ")) for r in want} == {2, 3}


def test_hot_passage_and_rare_words(spark, small):
    rng = random.Random(2)
    hot = "once upon a time there was one Very hot passage of a few words upon a time"
    rows = [
        (i, f"{hot} w{rng.randint(0, 10**6)} {rng.choice('xyz')}", "en", 0, "w", 1) for i in range(300)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    same(df, least=100)
    same(df, least=10, longest=3, percent=60, top=4)


def test_edges(spark, small):
    """Nulls, empty and very long texts, odd signs, repeated rows, no rows at all."""
    long = "to be or not to be " * 3_000
    odd = "a\x01 b \x00c\xa0d e  f\tg ÀÉ àé İ <|x|> 10.000" * 40
    rows = [(1, None, None, 1, None, None), (None, "", "", 1, "x", 2), (3, long, "en", 1, "x", 2),
            (3, long, "en", 1, "x", 2), (4, odd, "", 1, "x", 2), (5, "...", "de", 1, "x", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert same(df, least=30)
    assert same(df.where("doc_id = 4"), least=40) is not None
    assert same(df.where("doc_id = 1")) == []
    assert same(df.limit(0)) == []


def test_large_numbers(spark):
    """Products beyond 64 bits, floored exactly."""
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        n = rng.randint(10**12, 10**16)
        left, right = rng.randint(10**6, n), rng.randint(10**6, n)
        a = rng.randint(100, min(left, right))
        rows.append((a, n, left, right, str(1000 * a * n // (left * right))))
    df = spark.createDataFrame(rows, "a long, n long, l long, r long, want string")
    wrong = df.where(_score(df.a, df.n, df.l, df.r).cast("string") != df.want)
    assert wrong.count() == 0


@pytest.fixture
def sent(monkeypatch):
    """What is dealt out: the suffixes of all blocks."""
    frames, nodes = [], module._nodes

    def seen(suffixes, *rest):
        frames.append(suffixes)
        return nodes(suffixes, *rest)

    monkeypatch.setattr(module, "_nodes", seen)
    return frames


def test_only_suffixes_of_frequent_pairs_are_dealt_out(spark, small, sent):
    """Frequent words in changing order: no pair is frequent but one, and few share its bucket."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = [
        (i, " ".join(rng.sample(words, 20)) + ". new york.", "en", 0, "w", 1) for i in range(300)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r[2] for r in same(df, least=90)] == ["new york"]
    assert 300 <= sum(int(module._flat(r.rows).reshape(7, -1)[0].sum()) for r in sent[0].collect()) < 600


def test_pairs_that_share_a_bucket(spark, small, monkeypatch):
    """Buckets so few that none is rare: longer suffixes, the same phrases."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    monkeypatch.setattr(module, "LOAD", 10**9)
    assert same(df, least=10)
