"""Versioned sheets as folds over plain change tables.

``ops(commit_id, sheet, seq, op, record_key, cols, set)``
    One row per edit: ``op`` is add, update or delete, ``cols`` a record of the
    sheet's columns, ``set`` the names an update supplies.  ``seq`` is unique and
    grows along the history of a sheet.
``commits(commit_id, parent_id, branch, title, committed_at)``
``refs(name, kind, commit_id)``
    ``kind`` is branch or tag.
``sheet_ops(commit_id, sheet, seq, op)``
    Optional: ``op`` is create or delete, in one count of ``seq`` with the edits.  With it, a sheet
    has only the edits since it was last created, and a deleted or unknown sheet has no rows.

An add sets every column, so it also replaces a row that is there.  A deleted row
that is added again starts from nulls.  An update of a row that is not there does
nothing.  Since an add outranks every earlier edit of its key, the last value of
each column is the one with the largest ``seq`` among the edits that set it, and
one grouped aggregation with map-side combine folds any number of edits per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.functions.accessor import find_field
from sheetspark.runtime import ensure_checkpoints

JUMP_GROWTH = 4
FEW_COMMITS = 50_000  # links, of two ids each, that the driver may read and walk
FEW_REFS = 50_000  # branches and tags that are broadcast once counted
LITERAL_CHAIN = 2_000  # commits in a chain that may become literals in a plan

def _sheet_columns(ops: DataFrame) -> T.StructType:
    return ops.schema["cols"].dataType


def _sets(name: str) -> Column:
    """The ``seq`` of an edit that sets the column, null for any other edit."""
    supplied = (F.col("op") == "update") & F.array_contains("set", name)
    return F.when((F.col("op") == "add") | supplied, F.col("seq"))


def _last_edits(ops: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key: the last add and delete, and per column its last value and whether it has one."""
    aggregates = [
        F.max(F.when(F.col("op") == "add", F.col("seq"))).alias("__added"),
        F.max(F.when(F.col("op") == "delete", F.col("seq"))).alias("__deleted"),
    ]
    for name in columns:
        # max_by keeps an explicit null; it ignores edits that do not set the column.
        value = F.col("cols").getField(name)
        aggregates.append(F.max_by(value, _sets(name)).alias(f"__new_{name}"))
        aggregates.append(F.max(_sets(name)).isNotNull().alias(f"__set_{name}"))
    return ops.groupBy(*keys).agg(*aggregates)


def _alive() -> Column:
    added, deleted = F.col("__added"), F.col("__deleted")
    return added.isNotNull() & (deleted.isNull() | (added > deleted))


def fold(ops: DataFrame, by_sheet: bool = False) -> DataFrame:
    """The rows that a log of edits, starting from nothing, leaves."""
    keys = ["sheet", "record_key"] if by_sheet else ["record_key"]
    names = _sheet_columns(ops).names
    return (
        _last_edits(ops, keys, names)
        .where(_alive())
        .select(*keys, *[F.col(f"__new_{n}").alias(n) for n in names])
    )


def overlay(snapshot: DataFrame, ops: DataFrame) -> DataFrame:
    """Apply the ordered edits of a draft to the snapshot of its parent.

    A key the draft adds owes nothing to the snapshot, so those rows come from
    the edits alone; the snapshot needs one left join, and no full outer join.
    """
    names = _sheet_columns(ops).names
    edits = _last_edits(ops, ["record_key"], names)
    joined = snapshot.join(edits.withColumn("__hit", F.lit(True)), "record_key", "left")
    kept = joined.where(F.col("__added").isNull() & F.col("__deleted").isNull()).select(
        "record_key",
        *[
            F.when(F.col(f"__set_{n}"), F.col(f"__new_{n}")).otherwise(F.col(n)).alias(n)
            for n in names
        ],
    )
    added = edits.where(_alive()).select(
        "record_key", *[F.col(f"__new_{n}").alias(n) for n in names]
    )
    return kept.unionByName(added)


def ancestors(commits: DataFrame, commit_id: str) -> DataFrame:
    """A commit and its ancestors with their ``distance`` from it.

    Links that are few, which reading one more than :data:`FEW_COMMITS` shows, are walked where
    they have been read.  More of them are followed by joins, see :func:`_followed`.
    """
    links = commits.select("commit_id", "parent_id")
    few = links.limit(FEW_COMMITS + 1).collect()
    if len(few) > FEW_COMMITS:
        return _followed(links, commit_id)
    parents = {r["commit_id"]: r["parent_id"] for r in few}
    chain, at = [], commit_id
    while at in parents:
        chain.append((at, len(chain)))
        if len(chain) > len(parents):
            raise ValueError(f"the history of {commit_id!r} runs in a circle")
        at = parents[at]
    schema = T.StructType([commits.schema["commit_id"], T.StructField("distance", T.LongType())])
    return commits.sparkSession.createDataFrame(chain, schema)


def _followed(links: DataFrame, commit_id: str) -> DataFrame:
    """The ancestors over jump pointers that grow fourfold each round.

    A chain of a million commits takes ten rounds of small joins rather than a million recursion
    steps.  A round ends with one checkpoint of the commits found and the pointers; rounds end
    when one finds nothing new.
    """
    ensure_checkpoints(links.sparkSession)
    start = links.where(F.col("commit_id") == commit_id).select(
        "commit_id", F.lit(0).cast("bigint").alias("distance"), F.lit(None).alias("target")
    )
    # A jump leads from a commit to its ancestor at the distance of the round.
    first = links.where(F.col("parent_id").isNotNull()).select(
        "commit_id", F.lit(None).cast("bigint").alias("distance"), F.col("parent_id").alias("target")
    )
    state = start.unionByName(first).checkpoint()
    stride, known, total = 1, 0, links.count()
    while True:
        found = state.where("target IS NULL").drop("target")
        jumps = state.where("target IS NOT NULL").drop("distance")
        count = found.count()
        if count == known:
            return found
        if count > total:
            raise ValueError(f"the history of {commit_id!r} runs in a circle")
        known = count
        onward = jumps.select(F.col("commit_id").alias("target"), F.col("target").alias("__next"))
        longer, reached = jumps, found
        for times in range(1, JUMP_GROWTH):
            steps = found.join(longer, "commit_id").select(
                F.col("target").alias("commit_id"),
                (F.col("distance") + times * stride).alias("distance"),
            )
            reached = reached.unionByName(steps)
            longer = longer.join(onward, "target").select(
                "commit_id", F.col("__next").alias("target")
            )
        stride *= JUMP_GROWTH
        state = (
            reached.withColumn("target", F.lit(None))
            .unionByName(longer.withColumn("distance", F.lit(None).cast("bigint")))
            .checkpoint()
        )


def history(commits: DataFrame, commit_id: str) -> DataFrame:
    """The commits of a revision, newest first."""
    return (
        commits.join(ancestors(commits, commit_id), "commit_id")
        .withColumnRenamed("distance", "age")
        .orderBy("age")
    )


def resolve(commits: DataFrame, refs: DataFrame, revision: str) -> str:
    """The commit that a commit id, a branch or a tag stands for, tried in that order."""
    direct = commits.where(F.col("commit_id") == revision).select(
        "commit_id", F.lit(0).alias("rank")
    )
    rank = F.when(F.col("kind") == "branch", 1).otherwise(2)
    named = refs.where(F.col("name") == revision).select("commit_id", rank.alias("rank"))
    best = direct.unionByName(named).agg(F.min_by("commit_id", "rank").alias("commit_id")).first()
    if best["commit_id"] is None:
        raise LookupError(f"revision {revision!r} does not exist")
    return best["commit_id"]


def resolve_all(revisions: DataFrame, commits: DataFrame, refs: DataFrame) -> DataFrame:
    """``revision -> commit_id`` for many revisions; null if there is no such revision.

    The distinct revisions are resolved, so a popular one costs a single lookup.
    """
    asked = revisions.select("revision").distinct()
    ids = commits.select(F.col("commit_id").alias("revision"), F.col("commit_id").alias("by_id"))
    names = refs.groupBy(F.col("name").alias("revision")).agg(
        F.min_by("commit_id", F.when(F.col("kind") == "branch", 0).otherwise(1)).alias("by_name")
    )
    return (
        asked.join(ids, "revision", "left")
        .join(names, "revision", "left")
        .select("revision", F.coalesce("by_id", "by_name").alias("commit_id"))
    )


def ops_until(ops: DataFrame, commits: DataFrame, commit_id: str) -> DataFrame:
    """The edits on the ancestor chain of a commit."""
    return edits_of(ops, ancestors(commits, commit_id))


def edits_of(ops: DataFrame, chain: DataFrame) -> DataFrame:
    """The edits of some commits, each listed once.

    A chain that is counted to be short becomes a literal list, so that a log
    partitioned by commit is pruned and no edit is shuffled.  A longer one is an
    inner join: Catalyst pushes a semi join into a union of logs, where a commit
    id that is a literal on one side would leave no key to join on.
    """
    ids = chain.select("commit_id").limit(LITERAL_CHAIN + 1).collect()
    if len(ids) <= LITERAL_CHAIN:
        return ops.where(F.col("commit_id").isin([r["commit_id"] for r in ids]))
    return ops.join(chain.select("commit_id"), "commit_id").select(*ops.columns)


def within_lifetimes(ops: DataFrame, sheet_ops: DataFrame) -> DataFrame:
    """The edits of sheets that exist, made since they were last created.

    One sheet may have most of the edits: the sheets are broadcast if they are counted to be few.
    """
    live = _few(sheet_set(sheet_ops).withColumnRenamed("created_seq", "__since"))
    return ops.join(live, "sheet").where(F.col("seq") > F.col("__since")).select(*ops.columns)


def read_revision(
    ops: DataFrame,
    commits: DataFrame,
    refs: DataFrame,
    revision: str,
    sheet: str,
    sheet_ops: DataFrame | None = None,
) -> DataFrame:
    """The rows of a sheet at a commit id, branch or tag."""
    return snapshot(ops, commits, resolve(commits, refs, revision), sheet, sheet_ops)


def snapshot(
    ops: DataFrame,
    commits: DataFrame,
    commit_id: str,
    sheet: str | None = None,
    sheet_ops: DataFrame | None = None,
) -> DataFrame:
    """The rows of a sheet, or of every sheet, at a commit."""
    chain = ancestors(commits, commit_id)
    if sheet is not None:
        ops = ops.where(F.col("sheet") == sheet)
    edits = edits_of(ops, chain)
    if sheet_ops is not None:
        if sheet is not None:
            sheet_ops = sheet_ops.where(F.col("sheet") == sheet)
        edits = within_lifetimes(edits, edits_of(sheet_ops, chain))
    return fold(edits, by_sheet=sheet is None)


def record_counts(
    ops: DataFrame, commits: DataFrame, commit_id: str, sheet_ops: DataFrame | None = None
) -> DataFrame:
    """``sheet, record_count`` at a commit; with ``sheet_ops`` also the sheets without a row."""
    rows = snapshot(ops, commits, commit_id, sheet_ops=sheet_ops)
    counts = rows.groupBy("sheet").agg(F.count(F.lit(1)).alias("record_count"))
    if sheet_ops is None:
        return counts
    sheets = sheet_set(edits_of(sheet_ops, ancestors(commits, commit_id))).select("sheet")
    found = F.coalesce("record_count", F.lit(0).cast("bigint")).alias("record_count")
    return sheets.join(counts, "sheet", "left").select("sheet", found)


def snapshot_from(
    stored: DataFrame,
    stored_at: str,
    ops: DataFrame,
    commits: DataFrame,
    commit_id: str,
    sheet_ops: DataFrame | None = None,
) -> DataFrame:
    """The rows at a commit from the stored snapshot of an ancestor and the edits since.

    ``ops`` and ``sheet_ops`` are those of the stored sheet.  If it was created again since, the
    stored rows are void, and if it was deleted last, there are none.
    """
    chain = ancestors(commits, commit_id)
    at = chain.where(F.col("commit_id") == stored_at).first()
    if at is None:
        raise LookupError(f"{stored_at!r} is not an ancestor of {commit_id!r}")
    since = chain.where(F.col("distance") < at["distance"])
    edits = edits_of(ops, since)
    if sheet_ops is not None:
        last = last_sheet_op(edits_of(sheet_ops, since))
        if last is not None:
            alive = F.lit(last["op"] == "create")
            return fold(edits.where(alive & (F.col("seq") > last["seq"])))
    return overlay(stored, edits)


def last_sheet_op(sheet_ops: DataFrame):
    """The last create or delete of one sheet, or None."""
    last = F.max_by(F.struct("op", "seq"), "seq").alias("last")
    return sheet_ops.where(F.col("op").isin("create", "delete")).agg(last).first()["last"]


def sheet_set(sheet_ops: DataFrame) -> DataFrame:
    """The sheets that exist after an ordered log of create and delete."""
    last = sheet_ops.groupBy("sheet").agg(
        F.max(F.when(F.col("op") == "create", F.col("seq"))).alias("created"),
        F.max(F.when(F.col("op") == "delete", F.col("seq"))).alias("deleted"),
    )
    live = F.col("created").isNotNull() & (
        F.col("deleted").isNull() | (F.col("created") > F.col("deleted"))
    )
    return last.where(live).select("sheet", F.col("created").alias("created_seq"))


def commit_problems(drafts: DataFrame, ops: DataFrame, refs: DataFrame) -> DataFrame:
    """Why a draft may not be committed: ``number, problem``; no row if it may.

    Very many drafts may be on one branch, so branches that are counted to be few are broadcast.

    ``drafts(number, head)`` names the revision the draft was made on and
    ``ops(number)`` has a row per edit.
    """
    branches = refs.where(F.col("kind") == "branch").select(
        F.col("name").alias("head"), F.lit(True).alias("is_branch")
    )
    counts = ops.groupBy("number").agg(F.count(F.lit(1)).alias("edits"))
    branches = _few(branches.distinct())
    joined = drafts.join(branches, "head", "left").join(counts, "number", "left")
    problem = F.when(F.col("is_branch").isNull(), "HEAD is not a branch").when(
        F.coalesce("edits", F.lit(0)) == 0, "nothing to commit"
    )
    return joined.select("number", problem.alias("problem")).where(F.col("problem").isNotNull())


def commit(
    commits: DataFrame,
    refs: DataFrame,
    ops: DataFrame,
    draft_ops: DataFrame,
    branch: str,
    commit_id: str,
    title: str,
    committed_at: Column,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Commit a draft on a branch: the new commits, refs and ops tables.

    Refuses when the branch does not exist or the draft changes nothing.  Where ``commits`` has
    ``last_seq``, the largest ``seq`` up to a commit, the edits are numbered from there and the
    log is not read; otherwise its largest ``seq`` is looked up.
    """
    head = refs.where((F.col("kind") == "branch") & (F.col("name") == branch)).first()
    if head is None:
        raise ValueError(f"cannot commit to {branch!r}: HEAD is not a branch")
    if draft_ops.isEmpty():
        raise ValueError("cannot commit a draft without any modifications")
    spark = commits.sparkSession
    # The smallest possible frame carries the one new row; every value is a literal.
    row = spark.range(1).select(
        F.lit(commit_id).alias("commit_id"),
        F.lit(head["commit_id"]).cast("string").alias("parent_id"),
        F.lit(branch).alias("branch"),
        F.lit(title).alias("title"),
        committed_at.alias("committed_at"),
    )
    moves = (F.col("kind") == "branch") & (F.col("name") == branch)
    new_refs = refs.withColumn(
        "commit_id", F.when(moves, F.lit(commit_id)).otherwise(F.col("commit_id"))
    )
    counted = "last_seq" in commits.columns
    if counted:
        parent = commits.where(F.col("commit_id") == head["commit_id"]).first()
        base = parent["last_seq"] + 1 if parent else 0
        most = draft_ops.agg(F.max("seq")).first()[0]
        row = row.withColumn("last_seq", F.lit(base + most).cast("bigint"))
    else:
        base = ops.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).cast("bigint")).first()[0]
    new_ops = draft_ops.withColumn("commit_id", F.lit(commit_id)).withColumn(
        "seq", F.col("seq") + F.lit(base)
    )
    return (
        commits.unionByName(row),
        new_refs,
        ops.unionByName(new_ops.select(*ops.columns)),
    )


def open_draft(drafts: DataFrame, number: int) -> dict:
    """The draft of a number; refused if there is none or it is committed or closed."""
    found = drafts.where(F.col("number") == number).first()
    if found is None:
        raise LookupError(f"draft {number} does not exist")
    if found["state"] != "OPEN":
        raise ValueError(f"draft {number} is {found['state'].lower()}")
    return found.asDict()


def read_draft(
    ops: DataFrame,
    commits: DataFrame,
    drafts: DataFrame,
    draft_ops: DataFrame,
    number: int,
    sheet: str,
    sheet_ops: DataFrame | None = None,
    draft_sheet_ops: DataFrame | None = None,
) -> DataFrame:
    """The rows of a sheet in an open draft: its parent's, with the draft's edits over them.

    ``drafts(number, state, parent_id)``, ``draft_ops(number, sheet, seq, ...)`` and
    ``draft_sheet_ops(number, sheet, seq, op)``.  Of a sheet that the draft creates, only the edits
    since count; one that it deletes last has no rows.
    """
    draft = open_draft(drafts, number)
    own = (F.col("number") == number) & (F.col("sheet") == sheet)
    edits = draft_ops.where(own).drop("number")
    if draft_sheet_ops is not None:
        last = last_sheet_op(draft_sheet_ops.where(own))
        if last is not None:
            alive = F.lit(last["op"] == "create")
            return fold(edits.where(alive & (F.col("seq") > last["seq"])))
    return overlay(snapshot(ops, commits, draft["parent_id"], sheet, sheet_ops), edits)


def list_drafts(
    drafts: DataFrame, state: str = "OPEN", branch: str | None = None
) -> DataFrame:
    """Drafts in a state (``ALL`` for any) and on a branch, newest first."""
    # The states of a draft.
    if state not in ("OPEN", "COMMITTED", "CLOSED", "ALL"):
        raise ValueError(f"unknown draft state {state!r}")
    if state != "ALL":
        drafts = drafts.where(F.col("state") == state)
    if branch is not None:
        drafts = drafts.where(F.col("branch") == branch)
    return drafts.orderBy(F.col("number").desc())


def list_searches(
    searches: DataFrame,
    commit_id: str | None = None,
    draft_number: int | None = None,
    sheet: str | None = None,
    sort: Sequence[Column] = (),
) -> DataFrame:
    """Saved searches of a commit, draft or sheet."""
    wanted = {"commit_id": commit_id, "draft_number": draft_number, "sheet": sheet}
    for name, value in wanted.items():
        if value is not None:
            searches = searches.where(F.col(name) == value)
    return searches.orderBy(*sort) if sort else searches


def _few(refs: DataFrame) -> DataFrame:
    """Refs to join with; broadcast if counted to be few, else left to adaptive execution."""
    return F.broadcast(refs) if refs.limit(FEW_REFS + 1).count() <= FEW_REFS else refs


def stale_heads(heads: DataFrame, refs: DataFrame) -> DataFrame:
    """Local heads whose branch or tag has moved on: ``heads(..., name, kind, commit_id)``."""
    current = refs.select("name", "kind", F.col("commit_id").alias("current_commit_id"))
    asked = heads.select("name", "kind").distinct()
    current = _few(current.join(asked, ["name", "kind"], "left_semi"))
    return heads.join(current, ["name", "kind"]).where(
        F.col("commit_id") != F.col("current_commit_id")
    )


def edit_record(schema: T.StructType, **values: Column) -> Column:
    """The ``cols`` record of an edit: the given columns, the others null."""
    for name in values:
        find_field(schema, name)
    return F.struct(
        *[
            values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in schema.fields
        ]
    )
