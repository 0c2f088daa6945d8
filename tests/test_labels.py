"""Slices of labelled sheets against slices of Python lists."""

from __future__ import annotations

import random

import pytest

from sheetspark.operators import labels
from sheetspark.runtime import fresh_path

SCHEMA = "k long, v string"


def stored(spark, df):
    path = fresh_path(spark, "labelled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sheet_of(spark, values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], SCHEMA)
    return stored(spark, labels.labelled(df, "k", **options))


def in_order(df):
    found = sorted((r["__place"], r["v"]) for r in df.collect())
    assert len({p for p, _ in found}) == len(found)
    assert all(0 <= p < 1 << labels.BITS for p, _ in found)
    return [v for _, v in found]


@pytest.mark.parametrize("spacing", [None, 1, 3])
def test_slices(spark, spacing):
    rng = random.Random(spacing or 0)
    want = [f"v{i}" for i in range(30)]
    df = sheet_of(spark, want, spacing=spacing)
    for turn, (start, stop, n) in enumerate([(3, 5, 9), (0, 0, 4), (None, None, 7), (-3, 2, 2), (2, 6, 0), (99, None, 3)]):
        new = [f"t{turn}x{i}" for i in range(n)]
        rows = [(i, v) for i, v in enumerate(new)]
        rng.shuffle(rows)
        batch = spark.createDataFrame(rows, "i long, v string")
        df = stored(spark, labels.splice(df, batch, "i", start, stop))
        want[start:stop] = new
        assert in_order(df) == want


def test_only_the_rows_around_move(spark):
    want = [f"v{i}" for i in range(4_000)]
    df = sheet_of(spark, want, spacing=64)
    batch = spark.createDataFrame([(i, f"n{i}") for i in range(200)], "i long, v string")
    change = labels.plan_splice(df, batch, "i", 2_000, 2_001)
    assert change.removed == 1 and 0 < change.moved < 200
    assert change.written.count() == 200 + change.moved
    want[2_000:2_001] = [f"n{i}" for i in range(200)]
    assert in_order(change.sheet()) == want
    # The next rows at the same place find room.
    again = labels.plan_splice(stored(spark, change.sheet()), batch.limit(1), "i", 2_000, 2_000)
    assert (again.moved, again.removed, again.written.count()) == (0, 0, 1)


def test_edges(spark):
    empty = sheet_of(spark, [])
    batch = spark.createDataFrame([(2, "b"), (1, "a")], "i long, v string")
    df = labels.insert_rows(empty, batch, "i", 5)
    assert in_order(df) == ["a", "b"]
    assert {r["k"] for r in df.collect()} == {None}
    assert in_order(labels.splice(stored(spark, df), batch.limit(0), "i")) == []
    with pytest.raises(KeyError):
        labels.splice(empty, batch.withColumnRenamed("v", "w"), "i")
    with pytest.raises(ValueError):
        sheet_of(spark, ["a"], spacing=1 << labels.BITS)
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "i long, v string")
    with pytest.raises(Exception, match="several rows have the key"):
        labels.splice(empty, twice, "i").collect()
