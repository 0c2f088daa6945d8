"""Positions and slices against Python lists."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheetspark.operators import columns, edit, order
from sheetspark.operators.order import Positions
from sheetspark.sources.load import from_rows

ANIMALS = "alligator bee falcon lion monkey parrot shark whale zebra".split()


@pytest.fixture(scope="module")
def animals(spark):
    shuffled = random.Random(3).sample(ANIMALS, len(ANIMALS))
    return from_rows(spark, [{"animal": a} for a in shuffled])


def listed(df):
    return [r.animal for r in df.collect()]


def test_head_and_tail_examples(animals):
    assert listed(order.head(animals, "animal", 3)) == ANIMALS[:3]
    assert listed(order.head(animals, "animal")) == ANIMALS[:5]
    assert sorted(listed(order.head(animals, "animal", -3))) == ANIMALS[:6]
    assert listed(order.tail(animals, "animal")) == ANIMALS[-5:]
    assert listed(order.tail(animals, "animal", 3)) == ANIMALS[-3:]
    assert sorted(listed(order.tail(animals, "animal", -2))) == ANIMALS[2:]
    assert listed(order.tail(animals, "animal", 0)) == []
    assert listed(order.head(animals, "animal", 0)) == []
    assert listed(order.head(animals, "animal", -100)) == []
    assert sorted(listed(order.tail(animals, "animal", 100))) == ANIMALS


def test_rows_by_position(animals):
    for i in (0, 4, -1, -9):
        assert listed(order.row_at(animals, "animal", i)) == [ANIMALS[i]]
    for i in (9, -10):
        with pytest.raises(IndexError):
            order.row_at(animals, "animal", i)


@pytest.fixture(scope="module")
def numbered(spark):
    """Two thousand rows whose leading key is skewed, repeated and sometimes null."""
    rng = random.Random(11)
    rows = [
        (
            rng.choice([None, "a", "a", "a", 'q"\\', "é", "z" * 40]),
            rng.choice([None, -0.5, 0.0, 1e300, 2.25]),
            dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rng.randrange(10**9)),
            i,
        )
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "s string, f double, t timestamp_ntz, i bigint")
    return df.repartition(8, "i").cache()


@pytest.mark.parametrize("keys", [["i"], ["s", "i"], ["f", "i"], ["t", "i"], ["s", "f", "t", "i"]])
def test_every_row_has_its_rank(numbered, keys):
    positions = Positions(numbered, keys, range_rows=50)
    assert len(positions.starts) > 30
    ranked = positions.rows(0, positions.count).select("i", "pos").collect()
    expected = [r.i for r in numbered.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).collect()]
    assert [r.i for r in sorted(ranked, key=lambda r: r.pos)] == expected
    for start, stop in [(0, 1), (40, 90), (200, 330), (700, 1500), (1990, 2000)]:
        some = positions.rows(start, stop).select("i", "pos").collect()
        assert {r.pos: r.i for r in some} == dict(enumerate(expected[start:stop], start))


def test_ranges_stay_small_for_a_hot_key(numbered):
    """A leading key that holds a large part of the rows is split by the keys after it."""
    starts = Positions(numbered, ["s", "i"], range_rows=50).starts
    assert max(b - a for a, b in zip(starts, starts[1:])) < 300


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.one_of(st.none(), st.integers(-2500, 2500)),
    st.one_of(st.none(), st.integers(-2500, 2500)),
    st.one_of(st.none(), st.integers(-9, 9).filter(bool)),
)
def test_slices_equal_python(spark, start, stop, step):
    if not hasattr(test_slices_equal_python, "positions"):
        frame = spark.range(2000).select((F.col("id") * 7 % 2003).alias("k")).cache()
        test_slices_equal_python.expected = sorted(r.k for r in frame.collect())
        test_slices_equal_python.positions = Positions(frame, "k", range_rows=100)
    rows = test_slices_equal_python.positions.slice(start, stop, step).collect()
    got = [r.k for r in sorted(rows, key=lambda r: r.pos, reverse=(step or 1) < 0)]
    assert got == test_slices_equal_python.expected[start:stop:step]


def test_slice_prunes_the_scan(spark, tmp_path, plan):
    spark.range(100_000).select("id", F.lit("x").alias("wide")).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    some = Positions(stored, "id", range_rows=1000).rows(5000, 5100)
    text = plan(some)
    assert "GreaterThanOrEqual(id," in text and "LessThanOrEqual(id," in text
    assert some.count() == 100
    assert "SinglePartition" not in text


def test_deep_pages_use_ranges(numbered, plan, monkeypatch):
    expected = [r.i for r in numbered.orderBy("i").collect()]
    got = order.page(numbered, "i", offset=1500, limit=20, columns="i")
    assert [r.i for r in got.collect()] == expected[1500:1520]
    assert "TakeOrderedAndProject" in plan(got)
    monkeypatch.setattr(order, "TOP_K", 100)
    monkeypatch.setattr(order, "RANGE_ROWS", 50)
    by = ["s", "t"]
    expected = [r.i for r in order.order_by(numbered, by, "i").collect()]
    got = order.page(numbered, "i", "s|t", offset=1500, limit=20, columns="i,t")
    assert [r.i for r in got.collect()] == expected[1500:1520]
    assert "TakeOrdered" not in plan(got) and "Window" not in plan(got)


@pytest.mark.parametrize("keys", [["i"], ["s", "i"], ["f", "i"], ["t", "i"], ["s", "f", "t", "i"]])
def test_consecutive_rows_are_a_filter(numbered, keys, plan):
    positions = Positions(numbered, keys, range_rows=50)
    ordered = numbered.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    expected = [r.i for r in ordered.collect()]
    for start, stop in [(0, 2000), (0, 1), (7, 300), (1999, 2000), (399, 401), (5, 5), (-3, 9999)]:
        rows = positions.span(start, stop)
        assert sorted(r.i for r in rows.collect()) == sorted(expected[max(start, 0) : stop])
        assert "Exchange" not in plan(rows) or "InMemory" in plan(rows)
        rest = positions.without(start, stop)
        outside = expected[: max(start, 0)] + expected[max(start, stop) :]
        assert sorted(r.i for r in rest.collect()) == sorted(outside)


def test_order_and_sort(spark):
    rows = [{"a": a, "r": {"b": b}, "k": i} for i, (a, b) in enumerate([(1, 2), (None, 1), (1, 1), (0, None)])]
    df = from_rows(spark, rows)
    assert [r.k for r in order.order_by(df, "a|r.b", "k").collect()] == [1, 3, 2, 0]
    assert [r.k for r in order.sort(df, "-a,r.b").collect()] == [2, 0, 3, 1]
    assert [r.k for r in order.sort(df, ["r.b:desc", "a"]).collect()] == [0, 1, 2, 3]


def test_empty_sheet(spark):
    empty = spark.range(0)
    assert order.slice_rows(empty, "id", None, None, -1).count() == 0
    assert order.head(empty, "id", -3).count() == 0
    assert edit.assign_keys(empty, "id").count() == 0


def test_downsample_example(spark):
    df = from_rows(spark, [{"filename": f"{i:04}.txt"} for i in range(10)])
    kept = order.slice_rows(df, "filename", None, None, 2)
    assert sorted(r.filename for r in kept.collect()) == [f"{i:04}.txt" for i in range(0, 10, 2)]


def test_edits_by_position(spark):
    df = from_rows(spark, [{"filename": f"{n}.jpg", "k": i} for i, n in enumerate("abc")])

    def names(result):
        return [r.filename for r in result.orderBy("k").collect()]

    def rows(*new):
        return from_rows(spark, [{"filename": f"{n}.jpg", "o": i} for i, n in enumerate(new)])

    assert names(edit.set_row(df, "k", "k", 0, {"filename": "d.jpg"})) == ["d.jpg", "b.jpg", "c.jpg"]
    assert names(edit.set_row(df, "k", "k", -1, {"filename": None})) == ["a.jpg", "b.jpg", None]
    replaced = edit.replace_slice(df, "k", "k", rows("d", "e"), "o", 0, 2)
    assert names(replaced) == ["d.jpg", "e.jpg", "c.jpg"]
    backwards = edit.replace_slice(df, "k", "k", rows("x", "y", "z"), "o", None, None, -1)
    assert names(backwards) == ["z.jpg", "y.jpg", "x.jpg"]
    assert names(edit.delete_slice(df, "k", "k", 0, 1)) == ["b.jpg", "c.jpg"]
    assert names(edit.delete_slice(df, "k", "k", 0, 2)) == ["c.jpg"]
    with pytest.raises(ValueError):
        edit.replace_slice(df, "k", "k", rows("d"), "o", 0, 2)
    with pytest.raises(IndexError):
        edit.set_row(df, "k", "k", 3, {"filename": "q"})


def test_append_numbers_on(spark):
    first = edit.assign_keys(from_rows(spark, [{"n": 5}, {"n": 3}]), "n")
    again = edit.append(first, from_rows(spark, [{"n": 9}, {"n": 1}, {"n": 2}]), "n")
    assert [(r["__record_key"][-2:], r.n) for r in again.orderBy("__record_key").collect()] == [
        ("00", 3),
        ("01", 5),
        ("02", 1),
        ("03", 2),
        ("04", 9),
    ]


def test_updates(spark):
    df = from_rows(spark, [{"k": i, "a": i * 10, "b": f"b{i}"} for i in range(4)])
    some = spark.createDataFrame(
        [(0, 99, None, ["a"]), (1, None, None, ["a", "b"]), (2, 5, "n", []), (9, 1, "q", ["a", "b"])],
        "k bigint, a bigint, b string, set array<string>",
    )
    result = {r.k: (r.a, r.b) for r in edit.update_by_key(df, some, "k").collect()}
    assert result == {0: (99, "b0"), 1: (None, None), 2: (20, "b2"), 3: (30, "b3")}
    plain = edit.update_by_key(df, some.select("k", "a"), "k")
    assert {r.k: r.a for r in plain.collect()} == {0: 99, 1: None, 2: 5, 3: 30}
    with pytest.raises(KeyError):
        edit.update_by_key(df, some.withColumnRenamed("b", "c"), "k")


def test_several_updates_of_one_key(spark):
    df = from_rows(spark, [{"k": i, "a": i * 10, "b": f"b{i}"} for i in range(3)])
    many = spark.createDataFrame(
        [(0, 1, "x", ["a", "b"], 5), (0, None, "y", ["a"], 9), (0, 7, "z", ["b"], 2), (1, 8, "q", [], 3)],
        "k bigint, a bigint, b string, set array<string>, seq bigint",
    )
    result = {r.k: (r.a, r.b) for r in edit.update_by_key(df, many, "k", "seq").collect()}
    assert result == {0: (None, "x"), 1: (10, "b1"), 2: (20, "b2")}
    with pytest.raises(Exception, match="several rows for k 0"):
        edit.update_by_key(df, many.drop("seq"), "k").collect()
    with pytest.raises(Exception, match="several rows for k 0"):
        columns.attach_column(df, "c", many.select("k", F.col("b").alias("c")), "k").collect()
    twice = many.select("k").where("k = 0")
    assert sorted(r.k for r in edit.delete_by_key(df, twice, "k").collect()) == [1, 2]
