"""File references of sheets: content keys, classification and copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.operators.checks import one_per_key


def content_key(content: Column, prefix: str = "") -> Column:
    """The storage key of some bytes: equal bytes share a key."""
    return F.concat(F.lit(prefix), F.sha1(content))


def distinct_files(files: DataFrame, key: str = "key", first: str = "path") -> DataFrame:
    """One row per stored object: its key, the first path and how many files share it.

    Aggregated before the shuffle, so a file with a great many copies is no hot key.
    """
    return files.groupBy(key).agg(
        F.min(first).alias(first), F.count(F.lit(1)).alias("n_copies")
    )


def classify(dataset: Column, target: str) -> Column:
    """Where the bytes of a reference are: ``local``, ``same`` data set or ``other``."""
    return F.when(dataset.isNull(), "local").when(dataset == target, "same").otherwise("other")


def copy_problem(
    workspace: Column, storage: Column, target_workspace: str, target_storage: str
) -> Column:
    """Why a reference may not be copied without moving bytes; null if it may.

    A workspace or storage that is not known is not the target's.
    """
    return F.when(~workspace.eqNullSafe(F.lit(target_workspace)), "other workspace").when(
        ~storage.eqNullSafe(F.lit(target_storage)), "other storage"
    )


def copied_key(key: Column, target_prefix: str) -> Column:
    """The key of the same object in the target data set: its prefix changes, its name stays."""
    return F.concat(F.lit(target_prefix), F.regexp_extract(key, r"([^/]*)$", 1))


def copy_references(
    df: DataFrame,
    key: str,
    dataset: str,
    target: str,
    target_prefix: str,
    problem: Column | None = None,
) -> DataFrame:
    """Rewrite the references of other data sets so that they belong to the target.

    No bytes move and nothing is shuffled.  A reference with a problem fails the job.
    """
    other = classify(F.col(dataset), target) == "other"
    copied = copied_key(F.col(key), target_prefix)
    if problem is not None:
        message = F.concat(F.lit("cannot copy "), F.col(key), F.lit(": "), problem)
        copied = F.when(problem.isNull(), copied).otherwise(F.raise_error(message).cast("string"))
    return df.withColumn(key, F.when(other, copied).otherwise(F.col(key))).withColumn(
        dataset, F.when(other, F.lit(target)).otherwise(F.col(dataset))
    )


def map_references(df: DataFrame, key: str, mapping: DataFrame) -> DataFrame:
    """Rewrite keys through ``mapping(key, new_key)``; a key with several rows fails the job.

    Keys that are not in the mapping stay.  Spark broadcasts a mapping that is
    measured to be small; for a larger one, adaptive execution splits a key that
    very many rows refer to.
    """
    renamed = one_per_key(mapping.select(F.col("key").alias(key), "new_key"), key)
    joined = df.join(renamed, key, "left")
    return joined.select(
        *[F.coalesce("new_key", F.col(c)).alias(c) if c == key else c for c in df.columns]
    )
