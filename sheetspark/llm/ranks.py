"""Dense numbers for the rows of a table in some order, without a sort in one task."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.common import stored


def _run_places(change: np.ndarray, first_run: int, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The run of each row, and its place in it, where ``change`` marks the rows that begin one."""
    at = np.arange(len(change))
    begins = np.maximum.accumulate(np.where(change, at, -1))
    places = np.where(begins < 0, at + before, at - begins)
    return first_run + np.cumsum(change), places


def _numbered_runs(df: DataFrame, group: str) -> DataFrame:
    """Number the runs of equal ``group`` in each sorted partition, and the rows of each run."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, runs, size = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(group)
            codes = values.dictionary_encode(null_encoding="encode").indices.to_numpy()
            change = np.concatenate([[False], codes[1:] != codes[:-1]])
            change[0] = runs < 0 or values[0].as_py() != last
            numbers, places = _run_places(change, runs, size)
            last, runs, size = values[-1].as_py(), int(numbers[-1]), int(places[-1]) + 1
            added = [pa.array(np.full(len(places), part, np.int64)), pa.array(numbers), pa.array(places)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *added], [*batch.schema.names, "__part", "__run", "__place"]
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, __part bigint, __run bigint, __place bigint")


def ranked(df: DataFrame, group: str, order: Sequence[str], label: str) -> tuple[DataFrame, int, int]:
    """``df`` with ``tree``, the place of its group among all groups, and ``rank``, its place there.

    Groups ascend with null first, and so do the rows of a group by ``order``, all from 0; rows that
    agree in ``order`` stand in any order.  Also how many groups there are, and a bound that no rank
    reaches.  A group may hold all rows: it is spread over range partitions, whose first and last
    runs, one row a partition, are added up on the driver.
    """
    keys = [group, *order]
    placed = stored(
        _numbered_runs(df.repartitionByRange(*keys).sortWithinPartitions(*keys), group), label
    )
    last = F.struct("__run", "__place")
    rows = placed.groupBy("__part").agg(
        F.max_by(F.struct(F.col(group).alias("g"), "__run", "__place"), last).alias("last"),
        F.min_by(F.struct(F.col(group).alias("g")), last).alias("first"),
        F.max("__place").alias("most"),
    )
    trees, ranks, groups, size, bound, name = [], [], 0, 0, 0, None
    for row in sorted(rows.collect(), key=lambda r: r["__part"]):
        gap = row["__part"] - len(trees)
        trees.extend([0] * (gap + 1))
        ranks.extend([0] * (gap + 1))
        same = groups > 0 and row.first.g == name
        trees[-1] = groups - 1 if same else groups
        ranks[-1] = size if same else 0
        inside = row.last["__place"] + 1
        size = ranks[-1] + inside if row.last["__run"] == 0 else inside
        groups, name = trees[-1] + row.last["__run"] + 1, row.last.g
        bound = max(bound, ranks[-1] + row.most + 1)

    def of_part(values: list[int]):
        return F.get(F.from_json(F.lit(str(values)), "array<bigint>"), F.col("__part").cast("int"))

    found = placed.withColumn("tree", of_part(trees) + F.col("__run")).withColumn(
        "rank",
        F.col("__place") + F.when(F.col("__run") == 0, of_part(ranks)).otherwise(F.lit(0)),
    )
    return found.drop("__part", "__run", "__place"), groups, bound
