"""Sheets from rows, Arrow, pandas and files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sheetspark import schema as schemas
from sheetspark.operators.checks import require_declared


def from_rows(
    spark: SparkSession,
    rows: Iterable[Mapping[str, Any]] | DataFrame,
    schema: T.StructType | None = None,
    check: bool = True,
) -> DataFrame:
    """A sheet from rows given as dicts, with a declared or an inferred schema.

    An inferred schema has the fields of all rows, in the order they first appear.  With a
    declared one, an enum value or array length that breaks it fails the job unless ``check``
    is false.
    """
    if isinstance(rows, DataFrame):
        if schema is not None:
            raise ValueError("a schema cannot be given together with a DataFrame")
        return rows
    rows = list(rows)
    if schema is None:
        if not rows:
            raise ValueError("no rows to infer a schema from")
        names = dict.fromkeys(name for row in rows for name in row)
        return from_arrow(
            spark, pa.table({name: pa.array([row.get(name) for row in rows]) for name in names})
        )
    df = spark.createDataFrame([_tuple(row, schema) for row in rows], schema)
    return require_declared(df) if check else df


def _tuple(value: Any, dtype: T.DataType) -> Any:
    """Follow the schema: missing record fields are null and integers may fill float columns."""
    if value is None:
        return None
    if isinstance(dtype, T.StructType):
        return tuple(_tuple(value.get(f.name), f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return [_tuple(item, dtype.elementType) for item in value]
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return float(value)
    return value


def from_values(
    spark: SparkSession, values: Iterable[Any] | pa.Array, name: str = "value"
) -> DataFrame:
    """A single column from plain values or an Arrow array."""
    column = values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(list(values))
    return from_arrow(spark, pa.table({name: column}))


def from_arrow(spark: SparkSession, data: pa.Table | pa.StructArray) -> DataFrame:
    """A sheet from Arrow data; dictionary columns become enums."""
    if isinstance(data, pa.StructArray):
        data = pa.Table.from_struct_array(data)
    enums = {}
    for name in data.column_names:
        column = data[name]
        if pa.types.is_dictionary(column.type):
            column = column.unify_dictionaries().combine_chunks()
            chunk = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            enums[name] = chunk.dictionary.to_pylist()
            plain = column.cast(column.type.value_type)
            data = data.set_column(data.column_names.index(name), name, plain)
    _check_arrow(data.schema)
    df = spark.createDataFrame(_in_microseconds(data))
    for name, values in enums.items():
        df = df.withMetadata(name, schemas.field(name, schemas.enum(values)).metadata)
    schemas.check_supported(df.schema)
    return df


def _in_microseconds(data: pa.Table) -> pa.Table:
    """The same data with nanoseconds as microseconds; digits that would be lost are refused."""
    target = pa.schema([f.with_type(_microsecond_type(f.type)) for f in data.schema])
    if target.equals(data.schema):
        return data
    try:
        return data.cast(target)
    except pa.ArrowInvalid as error:
        raise ValueError(f"a time is finer than microseconds: {error}") from error


def _microsecond_type(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_timestamp(kind) and kind.unit == "ns":
        return pa.timestamp("us", kind.tz)
    if pa.types.is_duration(kind) and kind.unit == "ns":
        return pa.duration("us")
    if pa.types.is_struct(kind):
        return pa.struct([f.with_type(_microsecond_type(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(kind.value_field.with_type(_microsecond_type(kind.value_type)))
    return kind


def _check_arrow(schema: pa.Schema) -> None:
    for f in schema:
        kind = f.type
        while pa.types.is_list(kind) or pa.types.is_fixed_size_list(kind):
            kind = kind.value_type
        refused = (
            pa.types.is_map(kind)
            or pa.types.is_decimal(kind)
            or pa.types.is_unsigned_integer(kind)
            or pa.types.is_union(kind)
            or kind in (pa.int8(), pa.int16(), pa.float16())
            or pa.types.is_time(kind)
        )
        if refused:
            raise TypeError(f"column {f.name!r} has the unsupported Arrow type {f.type}")


def from_pandas(spark: SparkSession, pdf: pd.DataFrame) -> DataFrame:
    """A sheet from a pandas frame with plain column names."""
    if isinstance(pdf.columns, pd.MultiIndex):
        raise NotImplementedError("a pandas frame with a MultiIndex for columns is not supported")
    return from_arrow(spark, pa.Table.from_pandas(pdf, preserve_index=False))


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    format: str = "parquet",
    check: bool = True,
) -> DataFrame:
    """A sheet from files, against a declared schema or with the one the files carry.

    A value that breaks the declared schema fails the job that meets it, unless ``check`` is
    false; the check rides on the scan.
    """
    reader = spark.read.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    schemas.check_supported(df.schema)
    return require_declared(_declared(df, schema)) if schema is not None and check else df


def _declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the column metadata of ``schema``, which some sources leave out."""
    for f in schema.fields:
        if f.metadata and df.schema[f.name].metadata != f.metadata:
            df = df.withMetadata(f.name, f.metadata)
    return df


def to_rows(df: DataFrame) -> list[dict[str, Any]]:
    """All rows as dicts, for small results."""
    return [r.asDict(recursive=True) for r in df.collect()]


def to_pandas(df: DataFrame) -> pd.DataFrame:
    """All rows as a pandas frame, for small results; enums become categories."""
    pdf = df.toPandas()
    for f in df.schema.fields:
        if f.metadata.get("type") == "enum":
            values = f.metadata["values"]
            members = list(values.values()) if isinstance(values, dict) else list(values)
            pdf[f.name] = pd.Categorical(
                pdf[f.name], categories=[m for m in members if m is not None]
            )
    return pdf
