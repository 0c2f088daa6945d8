"""Folds against a replay of the edits one by one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sheetspark import schema as schemas
from sheetspark.operators import versions
from sheetspark.sources.sheets import append_edits

COLS = schemas.record(a="int64", b="string")
SCHEMA = (
    "commit_id string, sheet string, seq bigint, op string, record_key string, "
    "cols struct<a:bigint,b:string>, set array<string>"
)


def random_log(rng, size, keys, first_seq=0, commits=("c0",)):
    log = []
    for i in range(size):
        op = rng.choice(["add", "update", "update", "delete"])
        cols = (rng.choice([None, rng.randrange(100)]), rng.choice([None, "x", "y"]))
        supplied = rng.sample(["a", "b"], rng.randrange(3)) if op == "update" else None
        commit = commits[i * len(commits) // size]
        log.append((commit, "s", first_seq + i, op, f"k{rng.randrange(keys)}", cols, supplied))
    return log


def replay(log, rows=()):
    state = {k: dict(v) for k, v in dict(rows).items()}
    for _, _, _, op, key, cols, supplied in sorted(log, key=lambda r: r[2]):
        values = dict(zip(("a", "b"), cols))
        if op == "add":
            state[key] = values
        elif op == "delete":
            state.pop(key, None)
        elif key in state:
            state[key].update({c: values[c] for c in supplied})
    return state


def as_state(df):
    return {r.record_key: {"a": r.a, "b": r.b} for r in df.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_fold_and_overlay_equal_replay(spark, seed):
    rng = random.Random(seed)
    log = random_log(rng, 1500, 120)
    shuffled = spark.createDataFrame(rng.sample(log, len(log)), SCHEMA).repartition(5)
    assert as_state(versions.fold(shuffled)) == replay(log)
    before, after = log[:700], log[700:]
    parent = versions.fold(spark.createDataFrame(before, SCHEMA))
    laid = versions.overlay(parent, spark.createDataFrame(after, SCHEMA))
    assert as_state(laid) == replay(log)


def test_special_sequences(spark):
    def run(*ops):
        log = [("c", "s", i, op, "k", cols, supplied) for i, (op, cols, supplied) in enumerate(ops)]
        return as_state(versions.fold(spark.createDataFrame(log, SCHEMA)))

    add = ("add", (1, "x"), None)
    assert run(add, ("update", (None, "n"), ["a"])) == {"k": {"a": None, "b": "x"}}
    assert run(("update", (5, "n"), ["a"])) == {}
    assert run(add, ("delete", (None, None), None), ("update", (5, "q"), ["a"])) == {}
    assert run(add, ("delete", (None, None), None), ("add", (None, "z"), None)) == {
        "k": {"a": None, "b": "z"}
    }
    assert run(("update", (7, "u"), ["a", "b"]), ("add", (None, None), None)) == {
        "k": {"a": None, "b": None}
    }


def test_a_hot_key_is_combined_before_the_shuffle(spark, plan):
    """A third of the edits touch one key: at most one row per task and key is shuffled."""
    log = spark.range(30_000).select(
        F.lit("c").alias("commit_id"),
        F.lit("s").alias("sheet"),
        F.col("id").alias("seq"),
        F.when(F.col("id") % 11 == 0, "add").otherwise("update").alias("op"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("record_key"),
        F.struct(F.col("id").alias("a"), F.col("id").cast("string").alias("b")).alias("cols"),
        F.array(F.lit("a")).alias("set"),
    )
    folded = versions.fold(log)
    text = plan(folded)
    assert text.count("Exchange hashpartitioning(record_key") == 1
    assert "partial_max_by" in text
    hot = folded.where(F.col("record_key") == "hot").first()
    assert hot.a == 29_997


def chain(spark, length, fork_at=None):
    rows = [(f"m{i}", f"m{i - 1}" if i else None) for i in range(length)]
    if fork_at is not None:
        rows += [(f"d{i}", f"d{i - 1}" if i else f"m{fork_at}") for i in range(5)]
    return spark.createDataFrame(
        [(c, p, "main", f"title {c}") for c, p in rows],
        "commit_id string, parent_id string, branch string, title string",
    ).withColumn("committed_at", F.lit("2024-01-01").cast("timestamp_ntz"))


@pytest.mark.parametrize("few", [0, 50_000])
@pytest.mark.parametrize("length", [1, 2, 3, 7, 8, 150])
def test_ancestors_of_long_chains(spark, length, few, monkeypatch):
    monkeypatch.setattr(versions, "FEW_COMMITS", few)
    commits = chain(spark, length)
    found = versions.ancestors(commits, f"m{length - 1}").collect()
    assert {r.commit_id: r.distance for r in found} == {f"m{i}": length - 1 - i for i in range(length)}
    assert len(found) == length


def test_ancestors_of_a_fork(spark):
    commits = chain(spark, 20, fork_at=6)
    history = [r.commit_id for r in versions.history(commits, "d2").collect()]
    assert history == ["d2", "d1", "d0", *[f"m{i}" for i in range(6, -1, -1)]]
    assert versions.ancestors(commits, "nothing").count() == 0


def test_snapshots_follow_the_chain(spark):
    rng = random.Random(9)
    names = tuple(f"m{i}" for i in range(10)) + tuple(f"d{i}" for i in range(5))
    log = random_log(rng, 900, 60, commits=names)
    ops, commits = spark.createDataFrame(log, SCHEMA), chain(spark, 10, fork_at=4)
    on_dev = {"m0", "m1", "m2", "m3", "m4", "d0", "d1", "d2"}
    expected = replay([r for r in log if r[0] in on_dev])
    assert as_state(versions.snapshot(ops, commits, "d2", "s")) == expected
    stored = versions.snapshot(ops, commits, "m3", "s")
    assert as_state(versions.snapshot_from(stored, "m3", ops, commits, "d2")) == expected
    assert versions.snapshot(ops, commits, "d2").columns == ["sheet", "record_key", "a", "b"]


def test_a_stored_log_is_pruned_to_the_chain(spark, tmp_path, plan, monkeypatch):
    rng = random.Random(4)
    log = random_log(rng, 300, 40, commits=tuple(f"m{i}" for i in range(6)))
    ops, commits = spark.createDataFrame(log, SCHEMA), chain(spark, 6)
    append_edits(ops.where("commit_id < 'm3'"), str(tmp_path / "log"))
    append_edits(ops.where("commit_id >= 'm3'"), str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    refs = spark.createDataFrame([("v", "tag", "m3")], "name string, kind string, commit_id string")
    rows = versions.read_revision(stored, commits, refs, "v", "s")
    expected = replay([r for r in log if r[0] <= "m3"])
    assert as_state(rows) == expected
    assert "PartitionFilters: [commit_id" in plan(rows)
    assert "Join" not in plan(rows)
    monkeypatch.setattr(versions, "LITERAL_CHAIN", 2)
    joined = versions.read_revision(stored, commits, refs, "v", "s")
    assert "Join" in plan(joined) and as_state(joined) == expected


def test_revisions(spark):
    commits = chain(spark, 4)
    refs = spark.createDataFrame(
        [("main", "branch", "m3"), ("both", "tag", "m0"), ("both", "branch", "m1"), ("v1", "tag", "m2"), ("m0", "tag", "m3")],
        "name string, kind string, commit_id string",
    )
    for revision, commit in {"main": "m3", "both": "m1", "v1": "m2", "m2": "m2", "m0": "m0"}.items():
        assert versions.resolve(commits, refs, revision) == commit
    with pytest.raises(LookupError):
        versions.resolve(commits, refs, "missing")
    heads = spark.createDataFrame(
        [("main", "branch", "m1"), ("v1", "tag", "m2")], "name string, kind string, commit_id string"
    )
    stale = versions.stale_heads(heads, refs).collect()
    assert [(r.name, r.commit_id, r.current_commit_id) for r in stale] == [("main", "m1", "m3")]


def test_commit(spark):
    commits = chain(spark, 2)
    refs = spark.createDataFrame(
        [("main", "branch", "m1"), ("dev", "branch", "m0"), ("v1", "tag", "m0")],
        "name string, kind string, commit_id string",
    )
    ops = spark.createDataFrame([("m0", "s", 0, "add", "k0", (1, "x"), None)], SCHEMA)
    draft = spark.createDataFrame([(None, "s", 0, "add", "k1", (2, "y"), None)], SCHEMA)
    at = F.lit("2024-02-02").cast("timestamp_ntz")
    new = versions.commit(commits, refs, ops, draft, "dev", "n0", "commit-4", at)
    new_commits, new_refs, new_ops = new
    row = new_commits.where(F.col("commit_id") == "n0").first()
    assert (row.parent_id, row.branch, row.title) == ("m0", "dev", "commit-4")
    assert {(r.name, r.kind): r.commit_id for r in new_refs.collect()} == {
        ("main", "branch"): "m1",
        ("dev", "branch"): "n0",
        ("v1", "tag"): "m0",
    }
    assert sorted(as_state(versions.snapshot(new_ops, new_commits, "n0", "s"))) == ["k0", "k1"]
    with pytest.raises(ValueError, match="not a branch"):
        versions.commit(commits, refs, ops, draft, "v1", "n1", "t", at)
    with pytest.raises(ValueError, match="without any modifications"):
        versions.commit(commits, refs, ops, draft.limit(0), "main", "n1", "t", at)


def test_sheet_sets(spark):
    log = [("a", 0, "create"), ("b", 1, "create"), ("a", 2, "delete"), ("a", 3, "create"), ("b", 4, "delete"), ("c", 5, "delete")]
    df = spark.createDataFrame(log, "sheet string, seq bigint, op string")
    assert [tuple(r) for r in versions.sheet_set(df).collect()] == [("a", 3)]


def test_listings(spark):
    drafts = spark.createDataFrame(
        [(1, "OPEN", "main"), (2, "COMMITTED", "main"), (3, "CLOSED", "dev"), (4, "OPEN", "dev")],
        "number bigint, state string, branch string",
    )
    assert [r.number for r in versions.list_drafts(drafts).collect()] == [4, 1]
    assert [r.number for r in versions.list_drafts(drafts, "ALL", "main").collect()] == [2, 1]
    with pytest.raises(ValueError):
        versions.list_drafts(drafts, "LOST")
    searches = spark.createDataFrame(
        [("s1", "c1", None, "train"), ("s2", None, 3, "train"), ("s3", "c1", None, "test")],
        "id string, commit_id string, draft_number bigint, sheet string",
    )
    assert [r.id for r in versions.list_searches(searches, commit_id="c1", sort=[F.col("id").desc()]).collect()] == ["s3", "s1"]
    assert [r.id for r in versions.list_searches(searches, draft_number=3, sheet="train").collect()] == ["s2"]


SHEET_OPS = "commit_id string, sheet string, seq bigint, op string"


def replay_sheets(log, sheet_log):
    """All sheets from edits and sheet operations, one by one in order of ``seq``."""
    sheets = {}
    for row in sorted([*log, *sheet_log], key=lambda r: r[2]):
        name = row[1]
        if row[3] == "create":
            sheets[name] = []
        elif len(row) == 4:
            sheets.pop(name, None)
        elif name in sheets:
            sheets[name].append(row)
    return {name: replay(edits) for name, edits in sheets.items()}


@pytest.fixture(scope="module")
def replaced(spark):
    """A log of three commits over four sheets that are created, replaced and deleted at any time."""
    rng = random.Random(8)
    commits = ("m0", "m1", "m2")
    log, sheet_log = [], []
    for i in range(900):
        commit, sheet = commits[i * 3 // 900], f"s{rng.randrange(4)}"
        if rng.random() < 0.02 or i < 3:
            sheet_log.append((commit, sheet, i, rng.choice(["create", "create", "delete"])))
            continue
        op = rng.choice(["add", "add", "update", "delete"])
        cols = (rng.choice([None, rng.randrange(100)]), rng.choice([None, "x", "y"]))
        supplied = rng.sample(["a", "b"], rng.randrange(3)) if op == "update" else None
        log.append((commit, sheet, i, op, f"k{rng.randrange(30)}", cols, supplied))
    return log, sheet_log


def at_commit(rows, commit):
    return [r for r in rows if r[0] <= commit]


@pytest.mark.parametrize("commit", ["m0", "m1", "m2"])
def test_replaced_sheets_equal_replay(spark, replaced, commit):
    log, sheet_log = replaced
    ops, sheet_ops = spark.createDataFrame(log, SCHEMA), spark.createDataFrame(sheet_log, SHEET_OPS)
    commits = chain(spark, 3)
    want = replay_sheets(at_commit(log, commit), at_commit(sheet_log, commit))
    rows = versions.snapshot(ops, commits, commit, sheet_ops=sheet_ops).collect()
    got = {name: {} for name in want}
    for r in rows:
        got[r.sheet][r.record_key] = {"a": r.a, "b": r.b}
    assert got == want
    counts = versions.record_counts(ops, commits, commit, sheet_ops).collect()
    assert {r.sheet: r.record_count for r in counts} == {s: len(v) for s, v in want.items()}
    one = versions.snapshot(ops, commits, commit, "s1", sheet_ops)
    assert as_state(one) == want.get("s1", {})


@pytest.mark.parametrize("sheet", ["s0", "s1", "s2", "s3", "unknown"])
def test_stored_snapshot_of_a_replaced_sheet(spark, replaced, sheet):
    log, sheet_log = replaced
    ops = spark.createDataFrame([r for r in log if r[1] == sheet], SCHEMA)
    sheet_ops = spark.createDataFrame([r for r in sheet_log if r[1] == sheet], SHEET_OPS)
    commits = chain(spark, 3)
    stored = versions.snapshot(ops, commits, "m0", sheet, sheet_ops).drop("sheet")
    rows = versions.snapshot_from(stored, "m0", ops, commits, "m2", sheet_ops)
    assert as_state(rows) == replay_sheets(log, sheet_log).get(sheet, {})


def test_a_draft_that_replaces_or_deletes_a_sheet(spark):
    commits, add = chain(spark, 1), ("add", "k1", (1, "x"), None)
    ops = spark.createDataFrame([("m0", "s", 1, *add)], SCHEMA)
    sheet_ops = spark.createDataFrame([("m0", "s", 0, "create")], SHEET_OPS)
    drafts = spark.createDataFrame([(5, "OPEN", "m0")], "number int, state string, parent_id string")
    edits = spark.createDataFrame(
        [(5, "d", "s", 0, "add", "old", (7, "o"), None), (5, "d", "s", 2, "add", "k2", (2, "y"), None)],
        "number int, " + SCHEMA,
    )

    def rows(*own):
        own = spark.createDataFrame(
            [(5, "s", seq, op) for seq, op in own], "number int, sheet string, seq bigint, op string"
        )
        return sorted(as_state(versions.read_draft(ops, commits, drafts, edits, 5, "s", sheet_ops, own)))

    assert rows() == ["k1", "k2", "old"]
    assert rows((1, "create")) == ["k2"]
    assert rows((1, "create"), (3, "delete")) == []


def test_a_hot_sheet_needs_no_shuffle_for_its_lifetime(spark, plan):
    ops = spark.range(1000).select(
        F.lit("m0").alias("commit_id"),
        F.when(F.col("id") % 50 > 0, "hot").otherwise(F.col("id").cast("string")).alias("sheet"),
        F.col("id").alias("seq"),
        F.lit("add").alias("op"), F.col("id").cast("string").alias("record_key"),
        F.struct(F.col("id").alias("a"), F.lit("x").alias("b")).alias("cols"),
        F.lit(None).cast("array<string>").alias("set"),
    )
    sheet_ops = spark.createDataFrame([("m0", "hot", 499, "create")], SHEET_OPS)
    alive = versions.within_lifetimes(ops, sheet_ops)
    assert "BroadcastHashJoin" in plan(alive)
    assert alive.count() == 490


@pytest.mark.parametrize("few", [0, 50_000])
def test_a_circle_of_commits_is_refused(spark, few, monkeypatch):
    monkeypatch.setattr(versions, "FEW_COMMITS", few)
    rows = [("m0", "m2"), ("m1", "m0"), ("m2", "m1")]
    commits = spark.createDataFrame(rows, "commit_id string, parent_id string")
    with pytest.raises(ValueError, match="circle"):
        versions.ancestors(commits, "m1").collect()
