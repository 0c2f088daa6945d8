"""Typing and null rules shared by every traced expression.

All choices about result types, literals, division by zero and null tests live
here, so that they can be changed in one place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numeric types from narrowest to widest.
NUMBER_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)

# Ticks per second of each declared temporal unit.
UNIT_TICKS = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}

_LITERAL_TYPES: dict[type, T.DataType] = {
    bool: T.BooleanType(),
    int: T.LongType(),
    float: T.DoubleType(),
    str: T.StringType(),
    bytes: T.BinaryType(),
}


class EnumCode:
    """A literal given as the integer code of an enum, as saved searches do."""

    def __init__(self, code: int) -> None:
        self.code = code


class Value:
    """A Spark column with the type (and field metadata) it was declared with."""

    def __init__(
        self, column: Column, dtype: T.DataType | None, info: Mapping[str, Any] | None = None
    ) -> None:
        self.column = column
        self.dtype = dtype
        self.info = dict(info or {})

    @property
    def family(self) -> str:
        return family(self.dtype, self.info)


def family(dtype: T.DataType | None, info: Mapping[str, Any]) -> str:
    """Name the group of types within which values may be compared."""
    if info.get("type") in ("enum", "time"):
        return info["type"]
    if dtype is None:
        return "any"
    if isinstance(dtype, NUMBER_TYPES):
        return "number"
    for cls, name in (
        (T.StringType, "string"),
        (T.BooleanType, "boolean"),
        (T.BinaryType, "binary"),
        (T.DateType, "date"),
        (T.TimestampType, "timestamp"),
        (T.TimestampNTZType, "timestamp"),
        (T.DayTimeIntervalType, "timedelta"),
        (T.StructType, "record"),
        (T.ArrayType, "array"),
    ):
        if isinstance(dtype, cls):
            return name
    raise TypeError(f"unsupported column type {dtype.simpleString()}")


ORDERED = {"number", "date", "time", "timestamp", "timedelta", "any"}


def enum_codes(info: Mapping[str, Any]) -> dict[int, Any]:
    """Map each declared code to its value; a list counts from zero."""
    values = info["values"]
    if isinstance(values, Mapping):
        return {int(code): value for code, value in values.items()}
    return dict(enumerate(values))


def literal(value: Any, like: Value) -> Value:
    """Turn a Python literal into a column of the type it is compared with."""
    kind = like.family
    if isinstance(value, Column):
        return Value(value, None)
    if value is None:
        return Value(F.lit(None), None)
    if kind == "enum":
        codes = enum_codes(like.info)
        if isinstance(value, EnumCode):
            return literal(codes[value.code], like)
        if not any(v == value and type(v) is type(value) for v in codes.values()):
            raise KeyError(f"{value!r} is not one of the enum values {list(codes.values())}")
        return Value(F.lit(value), like.dtype, like.info)
    if isinstance(value, EnumCode):
        value = value.code
    if kind in ("date", "timestamp", "timedelta", "time"):
        return Value(_temporal(value, kind, like), like.dtype, like.info)
    dtype = _LITERAL_TYPES.get(type(value))
    if dtype is None or kind not in ("any", family(dtype, {})):
        raise TypeError(f"cannot combine {kind} with the literal {value!r}")
    return Value(F.lit(value).cast(dtype), dtype)


def _temporal(value: Any, kind: str, like: Value) -> Column:
    unit = like.info.get("unit", "us")
    if isinstance(value, bool):
        raise TypeError(f"cannot compare {kind} with {value!r}")
    if kind == "date":
        if isinstance(value, int):
            return F.date_from_unix_date(F.lit(value))
        if isinstance(value, dt.date):
            return F.lit(value.strftime("%Y-%m-%d")).cast("date")
    elif kind == "timestamp":
        if isinstance(value, int):
            moment = dt.datetime(1970, 1, 1) + dt.timedelta(
                microseconds=value * UNIT_TICKS["us"] // UNIT_TICKS[unit]
            )
        elif isinstance(value, dt.datetime):
            moment = value
            if moment.tzinfo is not None:
                moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
        elif isinstance(value, dt.date):
            moment = dt.datetime(value.year, value.month, value.day)
        else:
            raise TypeError(f"cannot compare timestamp with {value!r}")
        text = moment.isoformat(timespec="microseconds")
        if isinstance(like.dtype, T.TimestampNTZType):
            return F.lit(text).cast("timestamp_ntz")
        return F.lit(text + "Z").cast("timestamp")
    elif kind == "timedelta":
        if isinstance(value, int):
            value = dt.timedelta(microseconds=value * UNIT_TICKS["us"] // UNIT_TICKS[unit])
        if isinstance(value, dt.timedelta):
            return F.lit(value)
    elif kind == "time":
        if isinstance(value, int):
            return F.lit(value).cast("bigint")
        if isinstance(value, dt.time):
            micros = (
                (value.hour * 60 + value.minute) * 60 + value.second
            ) * 1_000_000 + value.microsecond
            return F.lit(micros * UNIT_TICKS[unit] // UNIT_TICKS["us"]).cast("bigint")
    raise TypeError(f"cannot compare {kind} with {value!r}")


def pair(left: Any, right: Any) -> tuple[Value, Value]:
    """Give both sides a type; at least one of them is a typed value already."""
    if not isinstance(left, Value):
        left = literal(left, right)
    elif not isinstance(right, Value):
        right = literal(right, left)
    return left, right


def _same_family(name: str, left: Value, right: Value) -> None:
    kinds = {left.family, right.family} - {"any"}
    if len(kinds) > 1 and kinds != {"enum", "string"}:
        raise TypeError(f"invalid '{name}' between {left.family} and {right.family}")


def _boolean(column: Column) -> Value:
    return Value(column, T.BooleanType())


def equals(left: Any, right: Any) -> Value:
    """Equality; comparing with None asks whether the value is null."""
    if left is None or right is None:
        known = right if left is None else left
        return _boolean(known.column.isNull())
    left, right = pair(left, right)
    _same_family("==", left, right)
    return _boolean(left.column == right.column)


def differs(left: Any, right: Any) -> Value:
    """Inequality; comparing with None asks whether the value is present."""
    if left is None or right is None:
        known = right if left is None else left
        return _boolean(known.column.isNotNull())
    left, right = pair(left, right)
    _same_family("!=", left, right)
    return _boolean(left.column != right.column)


def _ordered(name: str, compare: Any) -> Any:
    def apply(left: Any, right: Any) -> Value:
        left, right = pair(left, right)
        for side in (left, right):
            if side.family not in ORDERED:
                raise TypeError(f"'{name}' is not defined for {side.family}")
        _same_family(name, left, right)
        return _boolean(compare(left.column, right.column))

    return apply


greater = _ordered(">", lambda a, b: a > b)
at_least = _ordered(">=", lambda a, b: a >= b)
less = _ordered("<", lambda a, b: a < b)
at_most = _ordered("<=", lambda a, b: a <= b)


def _logical(name: str, combine: Any) -> Any:
    def apply(left: Any, right: Any) -> Value:
        left, right = pair(left, right)
        for side in (left, right):
            if side.family not in ("boolean", "any"):
                raise TypeError(f"'{name}' needs boolean operands, not {side.family}")
        return _boolean(combine(left.column, right.column))

    return apply


both = _logical("&", lambda a, b: a & b)
either = _logical("|", lambda a, b: a | b)


def negate(value: Value) -> Value:
    if value.family not in ("boolean", "any"):
        raise TypeError(f"'~' needs a boolean operand, not {value.family}")
    return _boolean(~value.column)


def _arithmetic(name: str, compute: Any) -> Any:
    def apply(left: Any, right: Any) -> Value:
        left, right = pair(left, right)
        for side in (left, right):
            if side.family != "number":
                raise TypeError(f"'{name}' is not defined for {side.family}")
        if name == "/":
            dtype: T.DataType = T.DoubleType()
        else:
            dtype = max(left.dtype, right.dtype, key=lambda t: NUMBER_TYPES.index(type(t)))
        sides = left.column.cast(dtype), right.column.cast(dtype)
        column = compute(*sides, dtype) if compute is _power else compute(*sides)
        return Value(column.cast(dtype), dtype)

    return apply


def _power(base: Column, exponent: Column, dtype: T.DataType) -> Column:
    """Powers of integers by squaring, so that they are exact and overflow is an error."""
    if not isinstance(dtype, (T.IntegerType, T.LongType)):
        return F.pow(base, exponent)
    wide, times = base.cast("bigint"), exponent.cast("bigint")
    one = F.lit(1).cast("bigint")
    start = F.struct(one.alias("result"), wide.alias("square"), times.alias("left"))

    def step(state: Column, _: Column) -> Column:
        odd, rest = state["left"] % 2 == 1, F.shiftright(state["left"], 1)
        return F.struct(
            F.when(odd, state["result"] * state["square"]).otherwise(state["result"]).alias("result"),
            F.when(rest > 0, state["square"] * state["square"])
            .otherwise(state["square"])
            .alias("square"),
            rest.alias("left"),
        )

    bits = F.sequence(F.lit(1), F.length(F.bin(times)))
    exact = F.aggregate(bits, start, step, lambda state: state["result"])
    return F.when(times >= 0, exact).otherwise(F.pow(base, exponent).cast("bigint"))


add = _arithmetic("+", lambda a, b: a + b)
subtract = _arithmetic("-", lambda a, b: a - b)
multiply = _arithmetic("*", lambda a, b: a * b)
divide = _arithmetic("/", F.try_divide)  # x / 0 is null
modulo = _arithmetic("%", F.try_mod)  # x % 0 is null; the sign is the dividend's
power = _arithmetic("**", _power)
