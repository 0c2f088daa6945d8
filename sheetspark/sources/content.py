"""File contents stored once under the key of their bytes.

``<root>/batches/<name>/`` holds what a put has added, ``<root>/published/<name>`` makes it visible.  A
put that breaks off is not visible at all; its retry adds the same bytes under another name.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators.files import content_key
from sheetspark.sources.claims import claim, exists

STORED = "key string, size bigint, content binary, batch string"


def stored_contents(spark: SparkSession, root: str) -> DataFrame:
    """``key, size, content`` of everything that is published, each key once."""
    if not exists(spark, f"{root}/published"):
        return spark.createDataFrame([], STORED).drop("batch")
    names = spark.read.text(f"{root}/published").select(F.col("value").alias("batch"))
    # Two puts at a time may both have stored some bytes; the first name counts.
    every = spark.read.schema(STORED).parquet(f"{root}/batches").join(names, "batch")
    first = every.groupBy("key").agg(F.min("batch").alias("batch"))
    return every.join(first, ["key", "batch"]).select("key", "size", "content")


def write_contents(spark: SparkSession, root: str, files: DataFrame, prefix: str = "") -> str:
    """Write the bytes of ``files(content)`` that are not stored yet; returns the batch to publish.

    Equal bytes are combined before the shuffle and written once, by the executors; null contents
    have no key and are left out.  Only keys are compared with what is stored.
    """
    known = stored_contents(spark, root).select("key")
    new = (
        files.where(F.col("content").isNotNull())
        .select(content_key(F.col("content"), prefix).alias("key"), "content")
        .join(known, "key", "left_anti")
        .dropDuplicates(["key"])
        .select("key", F.octet_length("content").cast("bigint").alias("size"), "content")
    )
    batch = uuid.uuid4().hex
    new.write.parquet(f"{root}/batches/batch={batch}")
    return batch


def publish_contents(spark: SparkSession, root: str, batch: str) -> None:
    claim(spark, f"{root}/published/{batch}", batch)


def put_contents(spark: SparkSession, root: str, files: DataFrame, prefix: str = "") -> None:
    """Store the bytes of some files: all of them are there afterwards, or none of the new ones."""
    publish_contents(spark, root, write_contents(spark, root, files, prefix))


def missing_keys(spark: SparkSession, root: str, references: DataFrame, key: str = "key") -> DataFrame:
    """References whose bytes are not stored."""
    known = stored_contents(spark, root).select(F.col("key").alias(key))
    return references.join(known, key, "left_anti")
