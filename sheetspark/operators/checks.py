"""Validation: each check gives the violations as rows, or refuses at once."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark import schema as schemas
from sheetspark.functions.rules import enum_codes


def _members(info: Mapping[str, Any]) -> list[Any]:
    return [value for value in enum_codes(info).values() if value is not None]


def undeclared(column: Column, dtype: T.DataType, info: Mapping[str, Any]) -> Column | None:
    """Whether a value breaks its declaration, at any depth; None if nothing is declared.

    An enum must hold a declared value or null, a fixed-length array that many items.
    """
    if info.get("type") == "enum":
        return F.coalesce(~column.isin(_members(info)), F.lit(False))
    broken = []
    if isinstance(dtype, T.StructType):
        parts = [undeclared(column.getField(f.name), f.dataType, f.metadata) for f in dtype.fields]
        broken = [part for part in parts if part is not None]
    elif isinstance(dtype, T.ArrayType):
        items, item_info = dtype.elementType, info.get("items", {})
        if "length" in info:
            broken.append(F.coalesce(length_violation(column, info["length"]), F.lit(False)))
        if undeclared(F.lit(None), items, item_info) is not None:
            found = F.exists(column, lambda item: undeclared(item, items, item_info))
            broken.append(F.coalesce(found, F.lit(False)))
    return functools.reduce(operator.or_, broken) if broken else None


def _column_violation(f: T.StructField) -> Column | None:
    return undeclared(F.col(f"`{f.name}`"), f.dataType, f.metadata)


def enum_violation(df: DataFrame, name: str) -> Column:
    """Whether a column holds an enum value, at any depth, that is not declared."""
    found = _column_violation(df.schema[name])
    return F.lit(False) if found is None else found


def length_violation(column: Column | str, length: int) -> Column:
    return F.array_size(column) != length


def bad_enums(df: DataFrame, name: str) -> DataFrame:
    """Rows whose column holds an enum value that is not declared."""
    return df.where(enum_violation(df, name))


def bad_lengths(df: DataFrame, name: str, length: int | None = None) -> DataFrame:
    """Rows whose array does not have its fixed length."""
    wanted = df.schema[name].metadata["length"] if length is None else length
    return df.where(length_violation(name, wanted))


def require_declared(df: DataFrame) -> DataFrame:
    """The same rows; running them fails on the first value that breaks its declaration.

    One pass: the check rides on whatever job reads the frame.
    """
    for f in df.schema.fields:
        broken = _column_violation(f)
        if broken is not None:
            value = F.col(f"`{f.name}`")
            message = F.concat(F.lit(f"undeclared value in {f.name}: "), F.to_json(F.struct(value)))
            checked = F.when(broken, F.raise_error(message).cast(f.dataType)).otherwise(value)
            df = df.withColumn(f.name, checked).withMetadata(f.name, f.metadata)
    return df


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """The same rows; running them fails if a key has several.

    The rows come out partitioned by key, as a join on the key needs them.
    """
    others = [f for f in df.schema.fields if f.name != key]
    counted = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.first(f.name).alias(f.name) for f in others]
    )
    message = F.concat(F.lit(f"several rows for {key} "), F.col(key).cast("string"))
    failure = F.raise_error(message)
    return counted.select(
        key,
        *[
            F.when(F.col("__rows") == 1, F.col(f.name))
            .otherwise(failure.cast(f.dataType))
            .alias(f.name, metadata=f.metadata)
            for f in others
        ],
    )


def unmatched_keys(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, with the side: a new column must cover every row."""
    left = df.select(key, F.lit(True).alias("__left"))
    right = values.select(key).distinct().withColumn("__right", F.lit(True))
    joined = left.join(right, key, "full")
    side = F.when(F.col("__left").isNull(), "no row").when(F.col("__right").isNull(), "no value")
    return joined.select(key, side.alias("problem")).where(F.col("problem").isNotNull())


def schema_differences(left: T.StructType, right: T.StructType) -> list[tuple[str, str, str]]:
    """``(position, left, right)`` of every column that differs in name or type."""
    differences = []
    for i in range(max(len(left), len(right))):
        sides = [s.fields[i] if i < len(s) else None for s in (left, right)]
        same = None not in sides and schemas.same_schema(
            T.StructType([sides[0]]), T.StructType([sides[1]])
        )
        if not same:
            shown = [f"{f.name}: {f.dataType.simpleString()}" if f else "" for f in sides]
            differences.append((str(i), *shown))
    return differences


def require_same_schema(left: T.StructType, right: T.StructType) -> None:
    if not schemas.same_schema(left, right):
        raise TypeError(f"the schemas differ: {schema_differences(left, right)}")


def violation_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Count the rows that break each named condition, in one pass."""
    counted = df.agg(*[F.count(F.when(broken, 1)).alias(name) for name, broken in checks.items()])
    return counted.unpivot([], list(checks), "check", "violations")
