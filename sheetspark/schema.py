"""Declared sheet schemas: dict / JSON / YAML documents and Spark ``StructType``.

What a Spark type cannot carry (enum values, the unit of a time column, a fixed
array length, a named type) is kept in the metadata of the field, which filters,
projections of whole columns and Parquet files preserve.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from typing import Any
from zoneinfo import ZoneInfo

from pyspark.sql import types as T

from sheetspark.functions.accessor import find_field
from sheetspark.functions.rules import UNIT_TICKS

# Declared scalar types and their Spark types.
SCALARS: dict[str, T.DataType] = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "date": T.DateType(),
}
_SCALAR_NAMES = {type(dtype): name for name, dtype in SCALARS.items()}

# The file types and the fields each one has beyond the common three.
FILE_TYPES = {
    "file.File": (),
    "file.Image": ("height", "width"),
    "file.Audio": (),
    "file.PointCloud": (),
    "file.PointCloudBin": (),
    "label.Mask": (),
}

FILE_FIELDS = ("key", "extension", "size")


def field(name: str, declared: Any, metadata: Mapping[str, Any] | None = None) -> T.StructField:
    """One column from a type name, a type document or a Spark type."""
    dtype, info = declare(declared)
    return T.StructField(name, dtype, True, {**info, **(metadata or {})})


def record(**fields: Any) -> T.StructType:
    """A record schema from keyword arguments, in the order given."""
    return T.StructType([field(name, declared) for name, declared in fields.items()])


def enum(values: Sequence[Any] | Mapping[int, Any]) -> dict[str, Any]:
    return {"type": "enum", "values": values}


def array(items: Any, length: int | None = None) -> dict[str, Any]:
    document = {"type": "array", "items": items}
    if length is not None:
        document["length"] = length
    return document


def box2d(
    categories: Sequence[Any] | None = None,
    attributes: Mapping[str, Any] | None = None,
    coords: str = "float32",
) -> T.StructType:
    """A labelled two-dimensional box."""
    fields = {name: coords for name in ("xmin", "ymin", "xmax", "ymax")}
    schema = record(**fields)
    if categories is not None:
        schema.add(field("category", enum(categories)))
    if attributes is not None:
        schema.add(field("attribute", record(**attributes)))
    return schema


def declare(document: Any) -> tuple[T.DataType, dict[str, Any]]:
    """Read a type document: the Spark type and the metadata that goes with it."""
    if isinstance(document, T.DataType):
        return document, {}
    if isinstance(document, str):
        document = {"type": document}
    kind = document["type"]
    if kind in SCALARS:
        return SCALARS[kind], {}
    if kind == "record":
        return from_pyobj(document), {}
    if kind == "array":
        item, item_info = declare(document["items"])
        info: dict[str, Any] = {"items": item_info} if item_info else {}
        if document.get("length") is not None:
            info["length"] = int(document["length"])
        return T.ArrayType(item), info
    if kind == "enum":
        return _enum_type(document["values"])
    if kind == "time":
        return T.LongType(), {"type": "time", "unit": _unit(document)}
    if kind == "timestamp":
        info = {"unit": _unit(document)}
        if document.get("tz") is None:
            return T.TimestampNTZType(), info
        ZoneInfo(document["tz"])
        return T.TimestampType(), {**info, "tz": document["tz"]}
    if kind == "timedelta":
        return T.DayTimeIntervalType(), {"unit": _unit(document)}
    if kind in FILE_TYPES:
        return file_type(kind), {"type": kind}
    raise TypeError(f"unknown type {kind!r}")


def file_type(kind: str = "file.File") -> T.StructType:
    """The record that refers to one stored file."""
    fields = {"key": "string", "extension": "string", "size": "int64"}
    return record(**fields, **{name: "int32" for name in FILE_TYPES[kind]})


def is_file(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType) and tuple(dtype.names[:3]) == FILE_FIELDS


def _unit(document: Mapping[str, Any]) -> str:
    unit = document.get("unit", "us")
    if unit not in UNIT_TICKS:
        raise ValueError(f"unknown unit {unit!r}")
    return unit


def _enum_type(values: Any) -> tuple[T.DataType, dict[str, Any]]:
    coded = isinstance(values, Mapping)
    members = list(values.values()) if coded else list(values)
    kinds = {type(value) for value in members} - {type(None)}
    if not kinds <= {str, int, bool}:
        raise TypeError("enum values must be str, int, bool or None")
    if len(kinds) > 1:
        raise TypeError("the enum values of one Spark column must share a type")
    dtype = {str: T.StringType(), int: T.LongType(), bool: T.BooleanType()}[
        kinds.pop() if kinds else str
    ]
    if not coded and None not in members:
        return dtype, {"type": "enum", "values": members}
    # Metadata has text keys and no nulls inside lists: keep {code: value} instead.
    codes = values if coded else dict(enumerate(members))
    stored = {str(int(code)): value for code, value in codes.items()}
    return dtype, {"type": "enum", "values": stored, "listed": not coded}


def from_pyobj(document: Mapping[str, Any]) -> T.StructType:
    """The Spark schema of a ``record`` document."""
    if document.get("type") != "record":
        raise TypeError("a sheet schema must be of type 'record'")
    fields = document["fields"]
    if isinstance(fields, Mapping):
        fields = [{"name": name, **_document(spec)} for name, spec in fields.items()]
    schema = T.StructType([field(spec["name"], spec) for spec in fields])
    duplicates = sorted({n for n in schema.names if schema.names.count(n) > 1})
    if duplicates:
        raise KeyError(f"duplicate fields {duplicates}")
    return schema


def _document(spec: Any) -> Mapping[str, Any]:
    return {"type": spec} if isinstance(spec, str) else spec


def to_pyobj(schema: T.StructType) -> dict[str, Any]:
    """The ``record`` document of a Spark schema."""
    return _to_document(schema, {})


def _to_document(dtype: T.DataType, info: Mapping[str, Any]) -> dict[str, Any]:
    kind = info.get("type")
    if kind == "enum":
        values = info["values"]
        if isinstance(values, Mapping):
            values = {int(code): value for code, value in values.items()}
            if info.get("listed"):
                values = [values[code] for code in sorted(values)]
        return {"type": "enum", "values": values}
    if kind == "time":
        return {"type": "time", "unit": info["unit"]}
    if kind in FILE_TYPES:
        return {"type": kind}
    if isinstance(dtype, T.StructType):
        fields = [{"name": f.name, **_to_document(f.dataType, f.metadata)} for f in dtype.fields]
        return {"type": "record", "fields": fields}
    if isinstance(dtype, T.ArrayType):
        document = {"type": "array", "items": _to_document(dtype.elementType, info.get("items", {}))}
        if "length" in info:
            document["length"] = info["length"]
        return document
    if isinstance(dtype, T.TimestampNTZType):
        return {"type": "timestamp", "unit": info.get("unit", "us")}
    if isinstance(dtype, T.TimestampType):
        return {"type": "timestamp", "unit": info.get("unit", "us"), "tz": info.get("tz", "UTC")}
    if isinstance(dtype, T.DayTimeIntervalType):
        return {"type": "timedelta", "unit": info.get("unit", "us")}
    if type(dtype) in _SCALAR_NAMES:
        return {"type": _SCALAR_NAMES[type(dtype)]}
    raise TypeError(f"unsupported column type {dtype.simpleString()}")


def from_json(text: str) -> T.StructType:
    return from_pyobj(json.loads(text))


def to_json(schema: T.StructType) -> str:
    return json.dumps(to_pyobj(schema))


def from_yaml(text: str) -> T.StructType:
    return from_pyobj(_yaml().safe_load(text))


def to_yaml(schema: T.StructType) -> str:
    return _yaml().safe_dump(to_pyobj(schema), sort_keys=False)


def read_json(path: str) -> T.StructType:
    with open(path, encoding="utf-8") as file:
        return from_json(file.read())


def read_yaml(path: str) -> T.StructType:
    with open(path, encoding="utf-8") as file:
        return from_yaml(file.read())


def _yaml() -> Any:
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading or writing YAML schemas needs PyYAML") from error
    return yaml


def check_supported(schema: T.StructType) -> None:
    """Refuse types a sheet cannot hold (maps, decimals, small integers, ...)."""
    to_pyobj(schema)


def leaf_count(dtype: T.DataType) -> int:
    """How many leaf columns a type has; an array counts the leaves of its items."""
    if isinstance(dtype, T.StructType):
        return sum(leaf_count(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return leaf_count(dtype.elementType)
    return 1


def name_conflicts(schema: T.StructType) -> list[tuple[str, str]]:
    """Pairs of sibling names that differ only by case, at every depth."""
    return list(_conflicts(schema, ""))


def _conflicts(dtype: T.DataType, prefix: str) -> Iterator[tuple[str, str]]:
    while isinstance(dtype, T.ArrayType):
        dtype = dtype.elementType
    if not isinstance(dtype, T.StructType):
        return
    seen: dict[str, str] = {}
    for item in dtype.fields:
        yield from _conflicts(item.dataType, f"{prefix}{item.name}.")
        lowered = item.name.lower()
        if lowered in seen:
            yield prefix + seen[lowered], prefix + item.name
        seen[lowered] = item.name


def check_names(schema: T.StructType) -> None:
    conflicts = name_conflicts(schema)
    if conflicts:
        raise ValueError(f"field names must differ by more than case: {conflicts}")


def same_schema(left: T.DataType, right: T.DataType) -> bool:
    """Same names, order and types, whatever the nullability; enums must agree."""
    return _shape(left) == _shape(right)


def _shape(dtype: T.DataType, info: Mapping[str, Any] | None = None) -> Any:
    if isinstance(dtype, T.StructType):
        return [(f.name, _shape(f.dataType, f.metadata)) for f in dtype.fields]
    if isinstance(dtype, T.ArrayType):
        return ["array", _shape(dtype.elementType, (info or {}).get("items"))]
    values = (info or {}).get("values")
    return [dtype.simpleString(), json.dumps(values, sort_keys=True)]


# Edits of a schema.  Each returns a new schema.


def insert(schema: T.StructType, index: int, name: str, declared: Any) -> T.StructType:
    if name in schema.names:
        raise KeyError(f"field {name!r} already exists")
    fields = list(schema.fields)
    fields.insert(index, field(name, declared))
    return T.StructType(fields)


def rename(schema: T.StructType, old: str, new: str) -> T.StructType:
    _require(schema, old)
    if new in schema.names:
        raise KeyError(f"field {new!r} already exists")
    return T.StructType(
        [
            T.StructField(new if f.name == old else f.name, f.dataType, True, f.metadata)
            for f in schema.fields
        ]
    )


def astype(schema: T.StructType, name: str, declared: Any) -> T.StructType:
    _require(schema, name)
    return T.StructType([field(name, declared) if f.name == name else f for f in schema.fields])


def drop(schema: T.StructType, name: str | int) -> T.StructType:
    target = schema.names[name] if isinstance(name, int) else name
    _require(schema, target)
    return T.StructType([f for f in schema.fields if f.name != target])


def _require(schema: T.StructType, name: str) -> None:
    if name not in schema.names:
        raise KeyError(f"field {name!r} does not exist in {schema.names}")


def type_at(schema: T.StructType, path: str) -> T.DataType:
    """The type at a dotted path; arrays are stepped through."""
    dtype: T.DataType = schema
    for name in path.split("."):
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        dtype = find_field(dtype, name).dataType
    return dtype
