"""An index of ancestors: every commit knows its depth and its ancestors at distances of powers of two.

``indexed(commit_id, depth, skips)``: ``skips[k]`` is the ancestor 2**k commits back.  Whether a
commit is an ancestor of another, which one is n commits back, and a whole chain take as many joins
as the depth has binary digits, for one revision or for many.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.runtime import ensure_checkpoints


def ancestor_index(commits: DataFrame) -> DataFrame:
    """``commit_id, depth, skips`` of all commits, from ``commit_id, parent_id``.

    Pointers double each round, so a history of n commits takes log2(n) rounds; a pointer that is left
    after that many belongs to a circle, which is refused.
    """
    ensure_checkpoints(commits.sparkSession)
    links = commits.select("commit_id", "parent_id")
    state = links.select(
        "commit_id",
        F.col("parent_id").alias("far"),
        F.when(F.col("parent_id").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
        F.array_compact(F.array("parent_id")).alias("skips"),
    ).checkpoint()
    for _ in range(state.count().bit_length()):
        if state.where(F.col("far").isNotNull()).isEmpty():
            break
        onward = state.select(
            F.col("commit_id").alias("far"), F.col("far").alias("__far"), F.col("depth").alias("__depth")
        )
        state = (
            state.join(onward, "far", "left")
            .select(
                "commit_id",
                F.col("__far").alias("far"),
                (F.col("depth") + F.coalesce("__depth", F.lit(0))).alias("depth"),
                F.when(F.col("__far").isNull(), F.col("skips"))
                .otherwise(F.array_append("skips", F.col("__far")))
                .alias("skips"),
            )
            .checkpoint()
        )
    if not state.where(F.col("far").isNotNull()).isEmpty():
        raise ValueError("the history runs in a circle")
    return state.select("commit_id", "depth", "skips")


def next_entry(
    parent: tuple[str, int, list[str]] | None, skips_of: Callable[[str], list[str]]
) -> tuple[int, list[str]]:
    """``depth, skips`` of a new commit on a parent (id, depth, skips): one lookup a pointer."""
    if parent is None:
        return 0, []
    commit_id, depth, theirs = parent
    found, at, k = [commit_id], theirs, 0
    while k < len(at):
        found.append(at[k])
        at, k = skips_of(at[k]), k + 1
    return depth + 1, found


def chain(indexed: DataFrame, commit_id: str) -> DataFrame:
    """A commit and its ancestors with their ``distance``: every round adds those 2**k further back."""
    start = indexed.where(F.col("commit_id") == commit_id).select(
        "commit_id", F.lit(0).cast("bigint").alias("distance")
    )
    depth = indexed.where(F.col("commit_id") == commit_id).select("depth").first()
    found = start
    for k in reversed(range((depth["depth"] if depth else 0).bit_length())):
        back = indexed.where(F.size("skips") > k).select("commit_id", F.col("skips")[k].alias("__back"))
        here = F.struct("commit_id", "distance")
        there = F.struct(F.col("__back").alias("commit_id"), (F.col("distance") + (1 << k)).alias("distance"))
        both = F.when(F.col("__back").isNull(), F.array(here)).otherwise(F.array(here, there))
        found = found.join(back, "commit_id", "left").select(F.inline(both))
    return found


def _climbed(rows: DataFrame, indexed: DataFrame, steps: Column) -> DataFrame:
    """``rows`` with ``__at`` moved ``steps`` commits back; null beyond the first commit."""
    most = rows.agg(F.max(steps)).first()[0] or 0
    rows = rows.withColumn("__steps", steps)
    for k in range(int(most).bit_length()):
        back = indexed.select(F.col("commit_id").alias("__at"), F.get("skips", F.lit(k)).alias("__back"))
        due = F.shiftright("__steps", k).bitwiseAND(1) == 1
        rows = rows.join(back, "__at", "left").withColumn(
            "__at", F.when(due, F.col("__back")).otherwise(F.col("__at"))
        )
        rows = rows.drop("__back")
    return rows.drop("__steps")


def ancestor_at(asked: DataFrame, indexed: DataFrame) -> DataFrame:
    """``asked(commit_id, distance)`` with ``ancestor_id``, null if there is none so far back."""
    pairs = asked.select("commit_id", F.col("distance").cast("bigint").alias("distance")).distinct()
    depths = indexed.select("commit_id", "depth")
    known = pairs.join(depths, "commit_id").where(F.col("distance").between(0, F.col("depth")))
    climbed = _climbed(known.withColumn("__at", F.col("commit_id")), indexed, F.col("distance"))
    found = climbed.select("commit_id", "distance", F.col("__at").alias("ancestor_id"))
    return asked.join(found, ["commit_id", "distance"], "left")


def is_ancestor(asked: DataFrame, indexed: DataFrame) -> DataFrame:
    """``asked(ancestor_id, commit_id)`` with ``is_ancestor``; a commit is one of its own.

    False if either is unknown or null.  Distinct pairs are looked up, so popular ones cost one lookup.
    """
    pairs = asked.select("ancestor_id", "commit_id").distinct()
    depths = indexed.select("commit_id", "depth")
    above = depths.select(F.col("commit_id").alias("ancestor_id"), F.col("depth").alias("__above"))
    known = pairs.join(depths, "commit_id").join(above, "ancestor_id")
    known = known.where(F.col("depth") >= F.col("__above")).withColumn("__at", F.col("commit_id"))
    climbed = _climbed(known, indexed, F.col("depth") - F.col("__above"))
    hits = climbed.where(F.col("__at") == F.col("ancestor_id")).select(
        "ancestor_id", "commit_id", F.lit(True).alias("__hit")
    )
    joined = asked.join(hits, ["ancestor_id", "commit_id"], "left")
    return joined.withColumn("is_ancestor", F.coalesce("__hit", F.lit(False))).drop("__hit")
