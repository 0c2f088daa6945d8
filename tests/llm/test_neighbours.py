"""Nearest neighbours against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from sheetspark.llm import neighbours as nn

SCHEMA = "vec_id long, embedding array<float>, score double"


def plain(rows, every=50, k=5):
    """(query_id, rank, vec_id, score) by all pairs; rows of (vec_id, vector)."""
    rows = sorted({(i, tuple(float(np.float32(x)) for x in v)) for i, v in rows}, key=str)
    out = []
    ids = np.array([i if i is not None else -(2**63) for i, _ in rows], dtype=np.int64)
    matrix = np.array([v for _, v in rows])
    for i, v in rows:
        if i is None or i % every:
            continue
        score = nn.cosines(np.repeat(np.array([v]), len(rows), axis=0), matrix)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        for rank, j in enumerate(order, 1):
            out.append((i, rank, rows[j][0], score[j]))
    return sorted(out, key=str)


def got(df, **how):
    return sorted((tuple(r) for r in nn.nearest_neighbours(df, **how).collect()), key=str)


def recall(found, wanted):
    """By scores, so that equal neighbours are as good as one another."""
    least = {}
    for i, _, _, score in wanted:
        least[i] = min(least.get(i, 2.0), score)
    return sum(s >= least[i] - 1e-12 for i, _, _, s in found) / len(wanted)


def test_small_table_is_exact(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert got(df) == plain(rows)


@pytest.mark.parametrize("clusters", [0, 12])
def test_recall(spark, monkeypatch, clusters):
    """Many blocks; a random cloud, and clusters of which one has a third of all vectors."""
    monkeypatch.setattr(nn, "BLOCK", 100)
    monkeypatch.setattr(nn, "SAMPLE", 1_000)
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(4_000, 24))
    if clusters:
        centres = rng.normal(size=(clusters, 24)) * 3
        which = np.where(rng.random(4_000) < 0.33, 0, rng.integers(0, clusters, 4_000))
        vectors = centres[which] + 0.1 * vectors
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, 0.0) for r in rows], SCHEMA)
    found, wanted = got(df, every=20), plain(rows, every=20)
    assert len(found) == len(wanted)
    assert recall(found, wanted) >= 0.9
    score = {(i, j): s for i, _, j, s in found}
    for (i, j), s in list(score.items())[:200]:
        a, b = (np.array([rows[x][1]], dtype=np.float64) for x in (i, j))
        assert s == nn.cosines(a, b)[0]


def test_edges(spark):
    rng = random.Random(1)
    base = [rng.uniform(-1, 1) for _ in range(4)]
    hot = [1.0, 2.0, -3.0, 0.5]
    rows = [(i, hot) for i in range(0, 300)]  # equal vectors, queries among them
    rows += [(300 + i, [x + 0.01 * i for x in base]) for i in range(200)]
    rows += [(1000, hot), (1000, hot), (1050, [2 * x for x in hot]), (None, hot), (1100, [1e30] * 4)]
    odd = [
        (2000, None), (2050, [0.0] * 4), (2100, [1.0, None, 0.0, 1.0]), (2150, [math.nan] * 4),
        (2200, [math.inf, 0.0, 0.0, 1.0]), (2250, []), (2300, [1.0, 2.0]),
    ]
    df = spark.createDataFrame([(*r, 1.0) for r in rows + odd], SCHEMA)
    found, wanted = got(df), plain(rows)
    assert found == wanted
    few = spark.createDataFrame([(0, base, 1.0), (1, hot, 1.0), (50, hot, 1.0)], SCHEMA)
    assert got(few) == plain([(0, base), (1, hot), (50, hot)])
    assert got(spark.createDataFrame([(0, hot, 1.0)], SCHEMA)) == []
    assert got(df.limit(0)) == []
