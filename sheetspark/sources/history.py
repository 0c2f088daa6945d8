"""Stored histories: edits by commit, commits and the moves of refs, all only ever added to.

``<root>/ops/commit_id=<id>/`` has the edits of a commit, ``<root>/commits`` a row per commit with
``last_seq``, the largest ``seq`` up to it, and ``<root>/moves`` a row for every time a branch or
tag was set.  The move is written last: a commit whose writing broke off is on no branch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators import versions
from sheetspark.sources.sheets import append_edits


def create_history(ops: DataFrame, commits: DataFrame, refs: DataFrame, root: str) -> None:
    """Store a history.  ``last_seq`` follows from the largest ``seq`` of each commit's edits,
    which grows along a chain."""
    append_edits(ops, f"{root}/ops")
    largest = ops.groupBy("commit_id").agg(F.max("seq").alias("last_seq"))
    commits.join(largest, "commit_id", "left").select(*commits.columns, "last_seq").write.parquet(
        f"{root}/commits"
    )
    moves = refs.select("name", "kind", "commit_id", F.lit(0).cast("bigint").alias("move"))
    moves.write.parquet(f"{root}/moves")


def read_ops(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/ops")


def read_commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/commits")


def read_refs(spark: SparkSession, root: str) -> DataFrame:
    """Where each branch and tag is now."""
    moves = spark.read.parquet(f"{root}/moves")
    return moves.groupBy("name", "kind").agg(F.max_by("commit_id", "move").alias("commit_id"))


def commit_stored(
    spark: SparkSession,
    root: str,
    draft_ops: DataFrame,
    branch: str,
    commit_id: str,
    title: str,
    committed_at: Column,
) -> None:
    """Commit a draft on a branch of a stored history, by adding to it.

    The log is not read: the head's ``last_seq`` tells where the numbers of the edits go on.
    """
    old_ops, old_commits, old_refs = read_ops(spark, root), read_commits(spark, root), read_refs(spark, root)
    if not old_commits.where(F.col("commit_id") == commit_id).isEmpty():
        raise ValueError(f"commit {commit_id!r} exists")
    nothing = old_ops.where(F.lit(False))
    none_yet = old_commits.where(F.lit(False))
    head = old_refs.where((F.col("kind") == "branch") & (F.col("name") == branch)).first()
    parent = old_commits.where(F.col("commit_id") == (head["commit_id"] if head else None))
    commits, _, ops = versions.commit(
        none_yet.unionByName(parent), old_refs, nothing, draft_ops, branch, commit_id, title, committed_at
    )
    moves = spark.read.parquet(f"{root}/moves")
    number = moves.agg(F.max("move")).first()[0] + 1
    append_edits(ops, f"{root}/ops")
    commits.where(F.col("commit_id") == commit_id).write.mode("append").parquet(f"{root}/commits")
    move = spark.range(1).select(
        F.lit(branch).alias("name"),
        F.lit("branch").alias("kind"),
        F.lit(commit_id).alias("commit_id"),
        F.lit(number).cast("bigint").alias("move"),
    )
    move.write.mode("append").parquet(f"{root}/moves")


def read_stored_revision(spark: SparkSession, root: str, revision: str, sheet: str) -> DataFrame:
    """The rows of a sheet at a commit id, branch or tag; only the chain's folders are read."""
    return versions.read_revision(
        read_ops(spark, root), read_commits(spark, root), read_refs(spark, root), revision, sheet
    )
