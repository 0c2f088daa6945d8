"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.runtime import fresh_path

#: Stands for a null id inside an operator, so that null ids join and sort (first) like any other.
NULL_ID = -(2**63)
#: Bytes of an Arrow batch between a task and its Python worker.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id, as a bigint, and the text; a null text is empty."""
    return df.select(
        F.col(key).cast("bigint").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text)
    )


def solid_id(column: Column) -> Column:
    return F.coalesce(column.cast("bigint"), F.lit(NULL_ID))


def plain_id(column: Column) -> Column:
    return F.nullif(column, F.lit(NULL_ID))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of a few megabytes for the jobs inside, so that tasks and workers stay small."""
    before = spark.conf.get(BATCH_SETTING, None)
    spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_SETTING)
        else:
            spark.conf.set(BATCH_SETTING, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Later stages do not recompute it, a lost executor does not lose it, and a join
    with it gets an exchange of its own, which adaptive execution can split.
    """
    path = fresh_path(df.sparkSession, label)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts end to end, and where each text starts (one more at the end)."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    starts = np.frombuffer(column.buffers()[1], dtype=kind)
    starts = starts[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[starts[0] : starts[-1]], starts - starts[0]


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``size`` bytes of text; a longer text is alone."""
    texts = batch.column(batch.schema.get_field_index("text"))
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at, done = 0, 0
    while at < batch.num_rows:
        last = max(int(np.searchsorted(ends, done + size, side="right")), at + 1)
        yield batch.slice(at, last - at)
        at, done = last, int(ends[last - 1])
