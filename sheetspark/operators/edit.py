"""Keyed edits of a sheet.

A record key is unique, so the joins below spread evenly however the data
columns are skewed.  Updates and deletes are small beside the sheet; Spark
broadcasts them when their measured size allows and shuffles otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark import schema as schemas
from sheetspark.operators.checks import one_per_key, require_same_schema
from sheetspark.operators.order import Positions

SET = "set"  # names of the columns an update row supplies


def extend(df: DataFrame, rows: DataFrame, key: str | None = None) -> DataFrame:
    """Append rows of exactly the same schema; duplicates stay.

    With a record key in ``df``, the new rows have none until they are committed.
    """
    if key is not None:
        require_same_schema(df.drop(key).schema, rows.schema)
        rows = rows.withColumn(key, F.lit(None).cast(df.schema[key].dataType))
    else:
        require_same_schema(df.schema, rows.schema)
    return df.unionByName(rows)


def record_key(number: Column) -> Column:
    """A record number as the fixed-width text that sorts like the number."""
    return F.lpad(number.cast("string"), 20, "0")


def assign_keys(
    batch: DataFrame, order: str | Sequence[str], start: int = 0, key: str = "__record_key"
) -> DataFrame:
    """Give a batch consecutive record keys from ``start`` on, in the given order."""
    positions = Positions(batch, order)
    numbered = positions.rows(0, positions.count)
    return numbered.withColumn(key, record_key(F.col("pos") + start)).drop("pos")


def next_number(df: DataFrame, key: str = "__record_key") -> int:
    """The record number after the largest key of a sheet."""
    largest = df.agg(F.max(F.col(key)).alias("key")).first()["key"]
    return 0 if largest is None else int(largest) + 1


def append(
    df: DataFrame, batch: DataFrame, order: str | Sequence[str], key: str = "__record_key"
) -> DataFrame:
    """Append a batch and give its rows the keys after the largest one."""
    require_same_schema(df.drop(key).schema, batch.schema)
    return df.unionByName(assign_keys(batch, order, next_number(df, key), key))


def update_by_key(
    df: DataFrame, updates: DataFrame, key: str, seq: str | None = None
) -> DataFrame:
    """Change the rows that ``updates`` names.

    Only supplied columns change.  They are the columns of ``updates``, or, if it
    has an array column ``set``, the ones that each row lists there: an explicit
    null is then different from a column that is not supplied.  Updates for keys
    the sheet does not have are ignored.

    A key with several update rows fails the job, unless ``seq`` orders them; then
    they are combined before the join, and before they are shuffled.
    """
    columns = [c for c in df.columns if c != key and c in updates.columns]
    unknown = set(updates.columns) - set(df.columns) - {SET, seq}
    if unknown:
        raise KeyError(f"the sheet has no columns {sorted(unknown)}")
    listed = SET in updates.columns and SET not in df.columns

    def supplied(name: str) -> Column:
        return F.array_contains(SET, name) if listed else F.lit(True)

    if seq is None:
        latest = one_per_key(updates.select(key, *columns, *([SET] if listed else [])), key)
        new = [F.col(c).alias(f"__new_{c}") for c in columns]
        given = [supplied(c).alias(f"__set_{c}") for c in columns]
        latest = latest.select(key, *new, *given)
    else:
        order = {c: F.when(supplied(c), F.col(seq)) for c in columns}
        new = [F.max_by(c, order[c]).alias(f"__new_{c}") for c in columns]
        given = [F.max(order[c]).isNotNull().alias(f"__set_{c}") for c in columns]
        latest = updates.groupBy(key).agg(*new, *given)

    def changed(name: str) -> Column:
        value = F.when(F.col(f"__set_{name}"), F.col(f"__new_{name}")).otherwise(F.col(name))
        return value.alias(name, metadata=df.schema[name].metadata)

    joined = df.join(latest, key, "left")
    result = joined.select(*[changed(c) if c in columns else c for c in df.columns])
    require_same_schema(df.schema, result.schema)
    return result


def delete_by_key(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Remove the rows whose key is listed, once or many times."""
    return df.join(keys.select(key).distinct(), key, "left_anti")


def keys_of_slice(
    df: DataFrame,
    order: str | Sequence[str],
    key: str,
    start: int | None = None,
    stop: int | None = None,
    step: int | None = None,
) -> tuple[DataFrame, int]:
    """The record keys of a slice with their place ``ordinal`` in it, and how many there are."""
    names = [order] if isinstance(order, str) else list(order)
    positions = Positions(df.select(*dict.fromkeys([*names, key])), names)
    chosen = range(*slice(start, stop, step).indices(positions.count))
    ordinal = ((F.col("pos") - (chosen.start if chosen else 0)) / chosen.step).cast("bigint")
    rows = positions.slice(start, stop, step).select(key, ordinal.alias("ordinal"))
    return rows, len(chosen)


def replace_slice(
    df: DataFrame,
    order: str | Sequence[str],
    key: str,
    rows: DataFrame,
    rows_order: str | Sequence[str],
    start: int | None = None,
    stop: int | None = None,
    step: int | None = None,
) -> DataFrame:
    """Replace a slice by as many new rows, matched in order; positions become keys first.

    New rows that lack a column leave it as it is, so the same call sets the
    cells of one column.  ``rows_order`` names a column of ``rows`` that is used
    only for the order when the sheet has no column of that name.
    """
    targets, wanted = keys_of_slice(df, order, key, start, stop, step)
    numbered = Positions(rows, rows_order)
    if numbered.count != wanted:
        raise ValueError(f"cannot assign {numbered.count} rows to a slice of {wanted} rows")
    new = numbered.rows(0, wanted).withColumnRenamed("pos", "ordinal")
    supplied = [c for c in rows.columns if c in df.columns and c != key]
    updates = targets.join(new.select("ordinal", *supplied), "ordinal").drop("ordinal")
    return update_by_key(df, updates, key)


def set_row(
    df: DataFrame, order: str | Sequence[str], key: str, index: int, values: dict[str, Any]
) -> DataFrame:
    """Set the given columns of the row at a position."""
    stop = None if index == -1 else index + 1
    targets, found = keys_of_slice(df, order, key, index, stop)
    if not found:
        raise IndexError(f"row {index} is out of range")
    literals = [F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in values.items()]
    return update_by_key(df, targets.select(key, *literals), key)


def delete_slice(
    df: DataFrame,
    order: str | Sequence[str],
    key: str,
    start: int | None = None,
    stop: int | None = None,
    step: int | None = None,
) -> DataFrame:
    """Remove the rows of a slice.

    Consecutive rows are cut out by a filter; scattered ones by an anti join.
    """
    if step in (None, 1, -1):
        positions = Positions(df, order)
        chosen = range(*slice(start, stop, step).indices(positions.count))
        if not chosen:
            return df
        return positions.without(min(chosen[0], chosen[-1]), max(chosen[0], chosen[-1]) + 1)
    targets, _ = keys_of_slice(df, order, key, start, stop, step)
    return delete_by_key(df, targets, key)


def backfill_column(
    df: DataFrame, name: str, declared: Any, values: DataFrame, key: str
) -> DataFrame:
    """Add a declared column, null at first, and fill it from ``values(key, name)``."""
    target = schemas.insert(df.schema, len(df.columns), name, declared)[name]
    added = df.withColumn(name, F.lit(None).cast(target.dataType)).withMetadata(
        name, target.metadata
    )
    return update_by_key(added, values.select(key, F.col(name).cast(target.dataType)), key)
