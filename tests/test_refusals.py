"""Data that must not be lost, miscounted or let through."""

from __future__ import annotations

import datetime as dt
import re

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sheetspark import schema as schemas
from sheetspark.functions.criteria import CriteriaError
from sheetspark.operators import columns, files, order
from sheetspark.operators.query import apply, query, search, select
from sheetspark.sources import load
from sheetspark.sources.sheets import write_bucketed


def test_inferred_schema_has_the_fields_of_all_rows(spark):
    df = load.from_rows(spark, [{"a": 1}, {"a": 2, "b": 3, "c": {"x": 1}}, {"c": {"y": "z"}}])
    assert df.columns == ["a", "b", "c"]
    rows = [r.asDict(recursive=True) for r in df.collect()]
    assert rows[0] == {"a": 1, "b": None, "c": None}
    assert rows[1] == {"a": 2, "b": 3, "c": {"x": 1, "y": None}}
    assert rows[2] == {"a": None, "b": None, "c": {"x": None, "y": "z"}}


def test_nanoseconds_are_kept_or_refused(spark):
    whole = pa.table({"t": pa.array([1_000], pa.timestamp("ns")), "d": pa.array([2_000], pa.duration("ns"))})
    row = load.from_arrow(spark, whole).first()
    assert row.d == dt.timedelta(microseconds=2)
    assert row.t.microsecond == 1
    for kind in (pa.timestamp("ns"), pa.list_(pa.timestamp("ns")), pa.struct([("x", pa.timestamp("ns"))])):
        value = {"list": [1], "struct": {"x": 1}}.get(str(kind).split("<")[0], 1)
        with pytest.raises(ValueError, match="finer"):
            load.from_arrow(spark, pa.table({"t": pa.array([value], kind)}))
    with pytest.raises(ValueError, match="finer"):
        load.from_pandas(spark, pd.DataFrame({"t": pd.to_datetime([1], unit="ns")}))


def test_ties_are_refused(spark, monkeypatch):
    monkeypatch.setattr(order, "RANGE_ROWS", 8)
    df = spark.range(20).select((F.col("id") % 5).alias("k"), "id")
    for read in (
        lambda: order.head(df, "k", -1),
        lambda: order.Positions(df, "k").without(0, 1),
        lambda: order.slice_rows(df, "k", 2, 9),
        lambda: order.tail(df, "k", -3),
    ):
        with pytest.raises(Exception, match="several rows have the key"):
            read().collect()
    assert order.head(df, ["k", "id"], -1).count() == 19


def test_one_order_for_every_n(spark, monkeypatch):
    monkeypatch.setattr(order, "TOP_K", 50)
    monkeypatch.setattr(order, "RANGE_ROWS", 40)
    df = spark.range(300).select((F.col("id") * 7 % 300).alias("k")).repartition(7)
    for n in (50, 51, 250, -5, -290):
        assert [r.k for r in order.head(df, "k", n).collect()] == list(range(300))[:n]
        assert [r.k for r in order.tail(df, "k", n).collect()] == list(range(300))[-n:]
    placed = order.numbered(df.orderBy(F.desc("k"))).collect()
    assert sorted((r.pos, r.k) for r in placed) == [(i, 299 - i) for i in range(300)]


def test_integer_powers_are_exact(spark):
    rows = [(3, 39), (94906267, 2), (-7, 22), (0, 0), (1, 100), (-1, 101), (2, 62), (5, None)]
    df = spark.createDataFrame(rows, "b long, e long")
    got = [r.p for r in select(df, [{"p": lambda x: x["b"] ** x["e"]}]).collect()]
    assert got == [None if e is None else b**e for b, e in rows]
    over = spark.createDataFrame([(2, 63)], "b long, e long")
    with pytest.raises(Exception, match="overflow"):
        select(over, [{"p": lambda x: x["b"] ** x["e"]}]).collect()


def test_late_moments_keep_their_microseconds(spark):
    moments = [dt.datetime(2300, 1, 1, 0, 0, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    epoch = dt.datetime(1970, 1, 1)
    micros = [(m - epoch) // dt.timedelta(microseconds=1) for m in moments]
    assert [r.t for r in columns.as_integers(df, "t", "us").collect()] == micros
    assert [r.t for r in columns.as_integers(df, "t", "ms").collect()] == [m // 1000 for m in micros]


@pytest.fixture
def scored(spark):
    schema = "n long, s array<long>, r array<struct<v:long,tags:array<string>>>"
    rows = [
        (1, [1, 2], [(3, ["a", "b"]), (4, [])]),
        (2, [], [(5, ["c"])]),
        (3, None, None),
    ]
    return spark.createDataFrame(rows, schema)


def values(df, expr):
    found = search(df, {"select": ["$.n", {"out": expr}]}).collect()
    return [r.out for r in sorted(found, key=lambda r: r.n)]


def test_reductions_take_an_element_expression(scored):
    assert values(scored, {"$sum": ["$.s", {"$mult": ["$.", 10]}]}) == [30, 0, None]
    assert values(scored, {"$max": ["$.r", {"$add": ["$.v", 1]}]}) == [5, 6, None]
    assert values(scored, {"$sum": ["$.r", {"$size": ["$.tags"]}]}) == [2, 1, None]
    assert values(scored, {"$sum": ["$.s"]}) == values(scored, {"$sum": "$.s"}) == [3, 0, None]
    for wrong in (
        {"$max": ["$.r"]},
        {"$size": ["$.s", "$."]},
        {"$sum": ["$.s", "$.", "$."]},
        {"$sum": ["$.n", {"$mult": ["$.", 2]}]},
        {"$any_match": ["$.s"]},
    ):
        with pytest.raises(CriteriaError):
            values(scored, wrong)


def test_array_predicates_nest(scored):
    inner = {"$any_match": ["$.tags", {"$eq": ["$.", "b"]}]}
    found = search(scored, {"where": {"$any_match": ["$.r", inner]}, "select": ["$.n"]})
    assert [r.n for r in found.collect()] == [1]
    both = {"$and": [{"$gt": ["$.v", 3]}, {"$any_match": ["$.tags", {"$eq": ["$.", "c"]}]}]}
    found = search(scored, {"where": {"$any_match": ["$.r", both]}, "select": ["$.n"]})
    assert [r.n for r in found.collect()] == [2]


def test_declarations_hold_on_load(spark, tmp_path):
    schema = schemas.record(kind=schemas.enum(["cat", "dog"]))
    bad = [{"kind": "cat"}, {"kind": "cow"}]
    with pytest.raises(Exception, match="undeclared value in kind"):
        load.from_rows(spark, bad, schema).collect()
    assert load.from_rows(spark, bad, schema, check=False).count() == 2
    spark.createDataFrame([("cat",), ("cow",)], "kind string").write.parquet(str(tmp_path / "t"))
    with pytest.raises(Exception, match="undeclared value in kind"):
        load.read_table(spark, str(tmp_path / "t"), schema).collect()
    unchecked = load.read_table(spark, str(tmp_path / "t"), schema, check=False)
    assert unchecked.count() == 2
    with pytest.raises(Exception, match="undeclared value in kind"):
        write_bucketed(unchecked, "bad_kinds", "kind", 2, str(tmp_path / "b"))


def test_new_column_can_be_required_to_be_complete(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string")
    good = spark.createDataFrame([(1, 10), (2, 20)], "k long, y long")
    rows = columns.attach_column(df, "y", good, "k", complete=True).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 10), (2, "b", 20)]
    for extra, message in (([(1, 10)], "no value for k 2"), ([(1, 1), (2, 2), (3, 3)], "no row for k 3")):
        values = spark.createDataFrame(extra, "k long, y long")
        with pytest.raises(Exception, match=message):
            columns.attach_column(df, "y", values, "k", complete=True).collect()
    assert columns.attach_column(df, "y", good.where("k = 1"), "k").count() == 2


def test_flattened_names_do_not_collide(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        columns.flatten(df)
    assert columns.flatten(df, ".").columns == ["a.b", "a_b"]


def test_copies_refuse_what_is_not_known(spark):
    rows = [("k1", "home", "s1"), ("k2", None, "s1"), ("k3", "home", None), ("k4", "away", "s1")]
    df = spark.createDataFrame(rows, "key string, w string, s string")
    problem = files.copy_problem(F.col("w"), F.col("s"), "home", "s1")
    got = [r.p for r in df.select(problem.alias("p")).collect()]
    assert got == [None, "other workspace", "other storage", "other workspace"]
    twice = spark.createDataFrame([("k1", "a"), ("k1", "b")], "key string, new_key string")
    with pytest.raises(Exception, match="several rows for key k1"):
        files.map_references(df, "key", twice).collect()


def test_query_helpers_still_agree(scored):
    assert query(scored, lambda x: (x["s"] == 2).any()).count() == 1
    assert apply(scored, lambda x: x["s"].sum()).count() == 3


@pytest.fixture
def stored(spark, tmp_path):
    """A stored history: c1 <- c2 on main, each with one edit."""
    from sheetspark.operators import versions
    from sheetspark.sources import history

    cols = "struct<v:long>"
    ops = spark.createDataFrame(
        [("c1", "s", 0, "add", 1, (10,), ["v"]), ("c2", "s", 1, "add", 2, (20,), ["v"])],
        f"commit_id string, sheet string, seq long, op string, record_key long, cols {cols}, set array<string>",
    )
    commits = spark.createDataFrame(
        [("c1", None, "main", "one", dt.datetime(2024, 1, 1)), ("c2", "c1", "main", "two", dt.datetime(2024, 1, 2))],
        "commit_id string, parent_id string, branch string, title string, committed_at timestamp_ntz",
    )
    refs = spark.createDataFrame([("main", "branch", "c2"), ("v1", "tag", "c1")], "name string, kind string, commit_id string")
    root = str(tmp_path / "history")
    history.create_history(ops, commits, refs, root)
    return versions, history, root, ops


def test_stored_commits(spark, stored, plan):
    versions, history, root, ops = stored
    draft = ops.where("commit_id = 'c1'").withColumn("record_key", F.lit(3)).drop("commit_id")
    when = F.lit("2024-01-03").cast("timestamp_ntz")
    history.commit_stored(spark, root, draft, "main", "c3", "three", when)
    df = history.read_stored_revision(spark, root, "main", "s")
    assert sorted((r.record_key, r.v) for r in df.collect()) == [(1, 10), (2, 20), (3, 10)]
    tagged = history.read_stored_revision(spark, root, "v1", "s")
    assert [(r.record_key, r.v) for r in tagged.collect()] == [(1, 10)]
    assert re.search(r"PartitionFilters: \[[^]]*commit_id", plan(tagged))
    last = {r.commit_id: r.last_seq for r in history.read_commits(spark, root).collect()}
    assert last == {"c1": 0, "c2": 1, "c3": 2}
    for branch, commit_id in (("none", "c4"), ("v1", "c4"), ("main", "c3")):
        with pytest.raises(ValueError):
            history.commit_stored(spark, root, draft, branch, commit_id, "no", when)
    with pytest.raises(ValueError, match="without any"):
        history.commit_stored(spark, root, draft.limit(0), "main", "c4", "no", when)


def test_drafts_by_number(spark, stored):
    versions, history, root, ops = stored
    drafts = spark.createDataFrame(
        [(1, "OPEN", "c1"), (2, "CLOSED", "c1"), (3, "COMMITTED", "c1")],
        "number int, state string, parent_id string",
    )
    edits = ops.where("commit_id = 'c2'").withColumn("number", F.lit(1)).drop("commit_id")
    read = lambda n: versions.read_draft(
        history.read_ops(spark, root), history.read_commits(spark, root), drafts, edits, n, "s"
    )
    assert sorted(r.record_key for r in read(1).collect()) == [1, 2]
    for number, error in ((2, ValueError), (3, ValueError), (4, LookupError)):
        with pytest.raises(error):
            read(number)
