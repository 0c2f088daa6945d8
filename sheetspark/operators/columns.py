"""Column-level edits of a sheet: add, rename, retype, insert, drop, flatten."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark import schema as schemas
from sheetspark.functions.accessor import column_of, row
from sheetspark.functions.convert import decode_enum, encode_enum, temporal_to_int
from sheetspark.functions.rules import enum_codes
from sheetspark.operators.checks import one_per_key

LITERAL_ENUM = 200  # larger enums are looked up by a join, not by a scan of a literal map


def add_column(df: DataFrame, name: str, function: Callable[[Any], Any] | Column) -> DataFrame:
    """Add a column computed from each row."""
    _absent(df, name)
    result = function(row(df)) if callable(function) else function
    return df.withColumn(name, column_of(result))


def attach_column(
    df: DataFrame, name: str, values: DataFrame, key: str, complete: bool = False
) -> DataFrame:
    """Add a column of outside values, ``values(key, name)``, matched by record key.

    A key with several values fails the job.  So does, if ``complete``, a row without a value
    or a value without a row; :func:`sheetspark.operators.checks.unmatched_keys` lists them.
    """
    _absent(df, name)
    unique = one_per_key(values.select(key, name), key)
    if not complete:
        return df.join(unique, key, "left")
    info = values.schema[name]
    left = df.withColumn("__row", F.lit(True))
    right = unique.withColumn("__value", F.lit(True))
    joined = left.join(right, key, "full")
    problem = F.when(F.col("__row").isNull(), "no row").when(F.col("__value").isNull(), "no value")
    message = F.concat(problem, F.lit(f" for {key} "), F.col(key).cast("string"))
    checked = F.when(problem.isNull(), F.col(name)).otherwise(
        F.raise_error(message).cast(info.dataType)
    )
    return joined.select(*df.columns, checked.alias(name, metadata=info.metadata))


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename a column, or with a dotted path a field of a record, in its place."""
    *parents, last = old.split(".")
    if not parents:
        schemas.rename(df.schema, old, new)
        return df.withColumnRenamed(old, new)
    return _edit_record(df, parents, lambda s: schemas.rename(s, last, new), {last: new})


def astype(df: DataFrame, path: str, declared: Any) -> DataFrame:
    """Cast a column or a record field to a declared type."""
    *parents, last = path.split(".")
    target = schemas.field(last, declared)
    if not parents:
        schemas.astype(df.schema, path, declared)
        cast = F.col(path).cast(target.dataType)
        return df.withColumn(path, cast).withMetadata(path, target.metadata)
    return _edit_record(df, parents, lambda s: schemas.astype(s, last, declared), {})


def insert(
    df: DataFrame, index: int, name: str, declared: Any, value: Column | None = None
) -> DataFrame:
    """Insert a column at a position, null unless a value is given."""
    target = schemas.insert(df.schema, index, name, declared)
    added = (F.lit(None) if value is None else value).cast(target[name].dataType)
    return df.select(
        *[added.alias(n, metadata=target[n].metadata) if n == name else n for n in target.names]
    )


def drop(df: DataFrame, path: str | int) -> DataFrame:
    """Drop a column by name or index, or a record field by dotted path."""
    if isinstance(path, int):
        path = df.columns[path]
    *parents, last = path.split(".")
    if not parents:
        schemas.drop(df.schema, path)
        return df.drop(path)
    return _edit_record(df, parents, lambda s: schemas.drop(s, last), {})


def _edit_record(
    df: DataFrame,
    parents: Sequence[str],
    change: Callable[[T.StructType], T.StructType],
    renamed: dict[str, str],
) -> DataFrame:
    """Rebuild the record at a path with another schema, keeping null records null."""
    record = schemas.type_at(df.schema, ".".join(parents))
    target = change(record)
    before = {renamed.get(f.name, f.name): f.name for f in record.fields}
    source = F.col(".".join(parents))
    rebuilt = F.struct(
        *[
            source.getField(before[f.name]).cast(f.dataType).alias(f.name, metadata=f.metadata)
            for f in target.fields
        ]
    )
    rebuilt = F.when(source.isNotNull(), rebuilt)
    if len(parents) == 1:
        return df.withColumn(parents[0], rebuilt)
    return df.withColumn(parents[0], F.col(parents[0]).withField(".".join(parents[1:]), rebuilt))


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Spread nested records into leaf columns; arrays stay as they are."""

    def leaves(dtype: T.StructType, path: tuple[str, ...]) -> list[Column]:
        found: list[Column] = []
        for f in dtype.fields:
            here = path + (f.name,)
            if isinstance(f.dataType, T.StructType):
                found += leaves(f.dataType, here)
            else:
                found.append(F.col(".".join(here)).alias(separator.join(here)))
        return found

    spread = df.select(*leaves(df.schema, ()))
    lowered = [name.lower() for name in spread.columns]
    twice = sorted({name for name in lowered if lowered.count(name) > 1})
    if twice:
        raise ValueError(f"several leaves would be named {twice}; choose another separator")
    return spread


def explode_items(df: DataFrame, path: str, keep: Sequence[str], index: str = "pos") -> DataFrame:
    """One row per element of an array of records, with its index; other columns as kept.

    The outer form keeps Spark from adding a filter on the array's size, which
    would compute a derived array twice.
    """
    items = df.select(*keep, F.posexplode_outer(F.col(path)).alias(index, "__item"))
    items = items.where(F.col(index).isNotNull())
    if isinstance(schemas.type_at(df.schema, path).elementType, T.StructType):
        return items.select(*keep, index, "__item.*")
    return items.withColumnRenamed("__item", "item")


def with_codes(df: DataFrame, name: str, code: str | None = None) -> DataFrame:
    """Add the integer codes of an enum column."""
    code = code or f"{name}_code"
    values = df.schema[name].metadata["values"]
    if len(values) <= LITERAL_ENUM:
        return df.withColumn(code, encode_enum(F.col(name), values))
    codes = [(v, c) for c, v in enum_codes({"values": values}).items() if v is not None]
    schema = T.StructType([df.schema[name], T.StructField(code, T.IntegerType())])
    # As many rows as the schema declares values, whatever the size of the sheet.
    lookup = df.sparkSession.createDataFrame(codes, schema)
    return df.join(F.broadcast(lookup), name, "left").select(*df.columns, code)


def from_codes(df: DataFrame, code: str, name: str, values: Any) -> DataFrame:
    """Add the enum column that integer codes stand for."""
    info = schemas.field(name, schemas.enum(values)).metadata
    return df.withColumn(name, decode_enum(F.col(code), values)).withMetadata(name, info)


def as_integers(df: DataFrame, name: str, unit: str | None = None) -> DataFrame:
    """Replace a temporal column by integers in its declared unit (days for a date)."""
    f = df.schema[name]
    unit = unit or f.metadata.get("unit", "us")
    return df.withColumn(name, temporal_to_int(F.col(name), f.dataType, unit))


def _absent(df: DataFrame, name: str) -> None:
    if name.lower() in (column.lower() for column in df.columns):
        raise NotImplementedError(f"column {name!r} already exists; replacing it is not supported")
