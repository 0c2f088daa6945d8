"""Enum codes and integer forms of temporal columns."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.functions.rules import UNIT_TICKS, enum_codes


def _lookup(pairs: Mapping[Any, Any], key: Column) -> Column:
    """A literal map; keys that are not in it, and null, give null."""
    items = [F.lit(part) for pair in pairs.items() for part in pair]
    return F.when(key.isNotNull(), F.try_element_at(F.create_map(*items), key))


def encode_enum(column: Column, values: Any) -> Column:
    """The integer code of each enum value; null for null."""
    codes = enum_codes({"values": values})
    return _lookup({v: c for c, v in codes.items() if v is not None}, column).cast("int")


def decode_enum(column: Column, values: Any) -> Column:
    """The enum value of each integer code; null for null."""
    codes = enum_codes({"values": values})
    if sorted(codes) == list(range(len(codes))):
        return F.get(F.array(*[F.lit(codes[code]) for code in range(len(codes))]), column)
    return _lookup({c: v for c, v in codes.items() if v is not None}, column.cast("int"))


def temporal_to_int(column: Column, dtype: T.DataType, unit: str = "us") -> Column:
    """Days of a date, ticks in ``unit`` of a timestamp or a timedelta."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(dtype, T.DayTimeIntervalType):
        micros = _interval_micros(column)
    elif isinstance(dtype, T.TimestampNTZType):
        midnight = column.cast("date")
        micros = F.unix_date(midnight).cast("bigint") * 86_400_000_000 + _interval_micros(
            column - midnight.cast("timestamp_ntz")
        )
    elif isinstance(dtype, T.TimestampType):
        micros = F.unix_micros(column)
    elif isinstance(dtype, T.LongType):
        return column
    else:
        raise TypeError(f"{dtype.simpleString()} is not temporal")
    ticks = UNIT_TICKS[unit]
    if ticks > UNIT_TICKS["us"]:
        return micros * (ticks // UNIT_TICKS["us"])
    divisor = UNIT_TICKS["us"] // ticks
    if divisor == 1:
        return micros
    # pmod keeps the division a floor for moments before the epoch; div is exact on integers.
    floor = micros - F.pmod(micros, F.lit(divisor).cast("bigint"))
    return F.call_function("div", floor, F.lit(divisor).cast("bigint"))


def _interval_micros(column: Column) -> Column:
    days = F.extract(F.lit("DAY"), column).cast("bigint")
    hours = F.extract(F.lit("HOUR"), column).cast("bigint")
    minutes = F.extract(F.lit("MINUTE"), column).cast("bigint")
    micros = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
    return ((days * 24 + hours) * 60 + minutes) * 60_000_000 + micros
