"""Stored typed sheets: conflicts, broken-off commits, schema edits, snapshots and ancestors."""

from __future__ import annotations

import random
import re

import pytest

from sheetspark import schema as schemas
from sheetspark.operators import lineage
from sheetspark.sources.repository import (
    AddColumn,
    Conflict,
    CreateSheet,
    DeleteSheet,
    DropColumn,
    Edits,
    RenameColumn,
    Repository,
    RetypeColumn,
)

WHEN = "2024-01-01"
SCHEMA = schemas.record(a="int64", b="string")


@pytest.fixture
def repo(spark, tmp_path):
    found = Repository(spark, str(tmp_path / "data"))
    found.create_branch("main")
    return found


@pytest.fixture
def edits(spark):
    def make(rows, columns="a bigint, b string", sheet="s"):
        """Rows of (key, op, set, values ...), in order."""
        rows = [(key, op, i, given, *values) for i, (key, op, given, *values) in enumerate(rows)]
        frame = spark.createDataFrame(
            rows, f"record_key string, op string, seq bigint, `set` array<string>, {columns}"
        )
        return Edits(sheet, frame)

    return make


def state(df):
    return {r.record_key: tuple(r)[1:] for r in df.collect()}


def add(key, *values):
    return (key, "add", None, *values)


def test_of_two_commits_on_one_head_one_is_refused(repo, edits):
    repo.commit("main", "c1", "", WHEN, [CreateSheet("s", SCHEMA), edits([add("k", 1, "x")])])
    mine = repo.prepare("main", "mine", "", WHEN, [edits([("k", "update", ["a"], 2, None)])])
    theirs = repo.prepare("main", "theirs", "", WHEN, [edits([("k", "update", ["b"], None, "y")])])
    repo.publish(theirs)
    with pytest.raises(Conflict):
        repo.publish(mine)
    assert state(repo.read("main", "s")) == {"k": (1, "y")}
    assert [r.commit_id for r in repo.unfinished().collect()] == ["mine"]
    with pytest.raises(LookupError):
        repo.read("mine", "s")
    repo.commit("main", "mine", "", WHEN, [edits([("k", "update", ["a"], 2, None)])])
    assert state(repo.read("main", "s")) == {"k": (2, "y")}
    assert {r.commit_id: r.distance for r in repo.chain("main").collect()} == {
        "mine": 0, "theirs": 1, "c1": 2,
    }
    with pytest.raises(ValueError, match="exists"):
        repo.commit("main", "mine", "", WHEN, [edits([add("k", 1, "x")])])


def test_a_commit_that_broke_off_is_replaced_by_its_retry(repo, edits):
    repo.commit("main", "c1", "", WHEN, [CreateSheet("s", SCHEMA)])
    assert repo.read("main", "s").columns == ["record_key", "a", "b"]
    assert state(repo.read("main", "s")) == {}
    repo.prepare("main", "c2", "", WHEN, [edits([add("lost", 1, "x"), add("k", 1, "x")])])
    assert state(repo.read("main", "s")) == {}
    repo.commit("main", "c2", "", WHEN, [edits([add("k", 5, "z")])])
    assert state(repo.read("main", "s")) == {"k": (5, "z")}
    assert repo.unfinished().isEmpty()


def test_branches_with_schemas_of_their_own(repo, edits):
    repo.commit("main", "c1", "", WHEN, [CreateSheet("s", SCHEMA), edits([add("k", 7, "1.5")])])
    repo.create_branch("dev", at="main")
    with pytest.raises(Conflict):
        repo.create_branch("dev")
    repo.commit("dev", "d1", "", WHEN, [RenameColumn("s", "a", "n"), DropColumn("s", "b")])
    repo.commit("main", "c2", "", WHEN, [
        RetypeColumn("s", "b", "float64"), AddColumn("s", 1, "n", "string"),
        edits([("k", "update", ["n"], 0, "new", 0.0)], "a bigint, n string, b double"),
    ])
    assert repo.schema("c1", "s") == SCHEMA
    assert repo.read("dev", "s").dtypes == [("record_key", "string"), ("n", "bigint")]
    assert state(repo.read("dev", "s")) == {"k": (7,)}
    assert repo.read("main", "s").columns == ["record_key", "a", "n", "b"]
    assert state(repo.read("main", "s")) == {"k": (7, "new", 1.5)}
    assert state(repo.read("c1", "s")) == {"k": (7, "1.5")}


def test_values_that_a_type_cannot_hold_and_columns_that_return(repo, edits):
    repo.commit("main", "c1", "", WHEN, [
        CreateSheet("s", SCHEMA), edits([add("k1", 1, "12"), add("k2", 2, "no number")]),
        RetypeColumn("s", "b", "int32"), DropColumn("s", "a"), AddColumn("s", -1, "a", "int64"),
        edits([("k1", "update", ["a"], 5, 0)], "a bigint, b int"),
    ])
    assert repo.read("main", "s").columns == ["record_key", "a", "b"]
    assert state(repo.read("main", "s")) == {"k1": (5, 12), "k2": (None, None)}


def test_replaced_and_deleted_sheets(repo, edits):
    repo.commit("main", "c1", "", WHEN, [
        CreateSheet("s", SCHEMA), edits([add("old", 1, "x")]), CreateSheet("t", SCHEMA),
        edits([add("t", 3, "t")], sheet="t"),
    ])
    repo.store_snapshot("main", "s")
    repo.commit("main", "c2", "", WHEN, [
        DeleteSheet("t"), CreateSheet("s", schemas.record(z="string")), edits([add("new", "q")], "z string"),
    ])
    assert {r.sheet for r in repo.sheets("c1").collect()} == {"s", "t"}
    assert {r.sheet for r in repo.sheets("main").collect()} == {"s"}
    assert state(repo.read("main", "s")) == {"new": ("q",)}
    assert state(repo.read("c1", "s")) == {"old": (1, "x")}
    with pytest.raises(LookupError, match="does not exist"):
        repo.read("main", "t")
    with pytest.raises(LookupError, match="does not exist"):
        repo.commit("main", "c3", "", WHEN, [edits([add("k", 1, "x")], sheet="t")])


def test_refusals(repo, edits, spark):
    repo.commit("main", "c1", "", WHEN, [CreateSheet("s", SCHEMA)])
    with pytest.raises(ValueError, match="without any"):
        repo.commit("main", "c2", "", WHEN, [])
    with pytest.raises(ValueError, match="folder"):
        repo.commit("main", "a/b", "", WHEN, [DeleteSheet("s")])
    with pytest.raises(LookupError, match="branch"):
        repo.commit("nowhere", "c2", "", WHEN, [DeleteSheet("s")])
    with pytest.raises(KeyError):
        repo.commit("main", "c2", "", WHEN, [edits([add("k", 1)], "unknown int")])
    with pytest.raises(KeyError):
        repo.commit("main", "c2", "", WHEN, [RenameColumn("s", "unknown", "x")])
    with pytest.raises(Exception, match="no column q"):
        repo.commit("main", "c2", "", WHEN, [edits([("k", "update", ["q"], 1, "x")])])
    repo.commit("main", "007", "", WHEN, [edits([add("k", 1, "x")])])
    assert state(repo.read("007", "s")) == {"k": (1, "x")}


def test_a_snapshot_spares_the_log_behind_it(repo, edits, plan):
    repo.commit("main", "c0", "", WHEN, [CreateSheet("s", SCHEMA)])
    for i in range(1, 5):
        rows = [add(f"k{i}", i, "x"), ("k1", "update", ["a"], 10 * i, None)]
        repo.commit("main", f"c{i}", "", WHEN, [edits(rows)])
    plain = state(repo.read("main", "s"))
    repo.store_snapshot("c1", "s")
    repo.store_snapshot("c3", "s")
    rows = repo.read("main", "s")
    assert state(rows) == plain == {"k1": (40, "x"), "k2": (2, "x"), "k3": (3, "x"), "k4": (4, "x")}
    filters = "".join(re.findall(r"PartitionFilters: \[[^\]]*\]", plan(rows)))
    assert set(re.findall(r"\bc\d\b", filters)) == {"c3", "c4"}  # the snapshot and the edits since
    repo.commit("main", "c5", "", WHEN, [RetypeColumn("s", "a", "string"), edits([add("k5", "v", "y")], "a string, b string")])
    assert state(repo.read("main", "s"))["k1"] == ("40", "x")
    assert state(repo.read("c2", "s")) == {"k1": (20, "x"), "k2": (2, "x")}


@pytest.fixture(scope="module")
def tree(spark):
    rng = random.Random(6)
    parents = {"n0": None}
    for i in range(1, 70):
        parents[f"n{i}"] = f"n{rng.randrange(max(0, i - 4), i)}"
    return parents, spark.createDataFrame(list(parents.items()), "commit_id string, parent_id string")


def line(parents, at):
    found = []
    while at is not None:
        found.append(at)
        at = parents[at]
    return found


def test_ancestor_index(spark, tree):
    parents, commits = tree
    index = lineage.ancestor_index(commits)
    rows = {r.commit_id: (r.depth, list(r.skips)) for r in index.collect()}
    for name in parents:
        above = line(parents, name)
        assert rows[name] == (len(above) - 1, [above[1 << k] for k in range(8) if 1 << k < len(above)])
        if parents[name] is not None:
            entry = (parents[name], *rows[parents[name]])
            assert lineage.next_entry(entry, lambda c: rows[c][1]) == rows[name]
    got = {r.commit_id: r.distance for r in lineage.chain(index, "n69").collect()}
    assert got == {c: i for i, c in enumerate(line(parents, "n69"))}
    assert lineage.chain(index, "unknown").isEmpty()


def test_ancestors_of_many(spark, tree):
    parents, commits = tree
    index, rng = lineage.ancestor_index(commits), random.Random(7)
    pairs = [(f"n{rng.randrange(70)}", f"n{rng.randrange(70)}") for _ in range(200)]
    pairs += [("n0", None), (None, "n1"), ("unknown", "n3"), ("n3", "unknown"), ("n5", "n5")]
    asked = spark.createDataFrame(pairs + pairs[:9], "ancestor_id string, commit_id string")
    got = lineage.is_ancestor(asked, index).collect()
    assert len(got) == len(pairs) + 9
    for r in got:
        assert r.is_ancestor == (r.commit_id in parents and r.ancestor_id in line(parents, r.commit_id))
    steps = [(f"n{rng.randrange(70)}", rng.randrange(-1, 40)) for _ in range(150)]
    asked = spark.createDataFrame(steps, "commit_id string, distance int")
    for r in lineage.ancestor_at(asked, index).collect():
        above = line(parents, r.commit_id)
        assert r.ancestor_id == (above[r.distance] if 0 <= r.distance < len(above) else None)


def test_circles_are_refused_when_the_index_is_made(spark):
    rows = [("a", "b"), ("b", "c"), ("c", "a"), ("d", None)]
    with pytest.raises(ValueError, match="circle"):
        lineage.ancestor_index(spark.createDataFrame(rows, "commit_id string, parent_id string"))
