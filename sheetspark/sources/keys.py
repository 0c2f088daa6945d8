"""Record keys leased in blocks, so that an append does not look for the largest key of a sheet.

``<root>/<n>`` is the n-th lease: the first number of its block and the number after its last.
Whoever creates the file has the block; two writers at a time get blocks of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators.checks import require_same_schema
from sheetspark.operators.edit import assign_keys
from sheetspark.sources.claims import Conflict, claim, exists


def high_water(spark: SparkSession, root: str) -> tuple[int, int]:
    """The number of the next lease and the first number that is not leased."""
    if not exists(spark, root):
        return 0, 0
    place = F.element_at(F.split(F.input_file_name(), "/"), -1).cast("bigint")
    stop = F.split("value", ",")[1].cast("bigint")
    leases = spark.read.text(root).select(F.struct(place.alias("n"), stop.alias("stop")).alias("lease"))
    last = leases.agg(F.max("lease").alias("last")).first()["last"]
    return (0, 0) if last is None else (last["n"] + 1, last["stop"])


def lease(spark: SparkSession, root: str, size: int, start: int = 0) -> int:
    """The first number of a block of ``size`` that nobody else gets.

    ``start`` is where the first lease begins, for a sheet that has rows already.
    """
    if size < 0:
        raise ValueError("a block cannot have a negative size")
    while True:
        number, first = high_water(spark, root)
        first = max(first, start) if number == 0 else first
        try:
            claim(spark, f"{root}/{number:020}", f"{first},{first + size}")
            return first
        except Conflict:
            continue


def append_leased(
    df: DataFrame,
    batch: DataFrame,
    order: str | Sequence[str],
    root: str,
    start: int = 0,
    key: str = "__record_key",
) -> DataFrame:
    """Append a batch under leased keys; the sheet itself is not read."""
    require_same_schema(df.drop(key).schema, batch.schema)
    first = lease(df.sparkSession, root, batch.count(), start)
    return df.unionByName(assign_keys(batch, order, first, key))
