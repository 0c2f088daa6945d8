"""Schema edits inside a history.

A column is known by a number that never changes; its name, type and place may.  The log has a row
for every sheet that is created or deleted and for every column that is added, renamed, retyped or
dropped: ``seq, op, field_id, field, place``, where ``field`` is the column as JSON, with metadata.
Edits are stored under the numbers of columns, in the types that they had; they are read in those
of a later schema.  A schema is what a driver plans with, so the log of one sheet is folded there.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark import schema as schemas

LOG = "sheet string, seq bigint, op string, field_id bigint, field string, place double"


@dataclass(frozen=True)
class Field:
    """A column of a sheet: its number, where it stands among the others, and what it is."""

    number: int
    place: float
    field: T.StructField

    @property
    def name(self) -> str:
        return self.field.name


@dataclass(frozen=True)
class Change:
    """A row of the log."""

    op: str  # create, delete, add, rename, retype or drop
    number: int | None = None
    field: T.StructField | None = None
    place: float | None = None

    def row(self, sheet: str, seq: int) -> tuple:
        text = None if self.field is None else json.dumps(self.field.jsonValue())
        return (sheet, seq, self.op, self.number, text, self.place)


def _parsed(text: str | None) -> T.StructField | None:
    return None if text is None else T.StructField.fromJson(json.loads(text))


class SheetSchema:
    """A sheet's schema after some changes, and the types its columns have had."""

    def __init__(self) -> None:
        self.exists = False
        self.epoch: int | None = None  # seq of the change that made it what it is
        self.since: int | None = None  # seq of its creation
        self.fields: dict[int, Field] = {}
        self.types: dict[int, list[tuple[int, T.DataType]]] = {}
        self.next_number = 0

    @classmethod
    def of(cls, rows: Iterable[Any]) -> SheetSchema:
        """From log rows of one sheet, in any order."""
        found = cls()
        for row in sorted(rows, key=lambda r: r["seq"]):
            found.apply(Change(row["op"], row["field_id"], _parsed(row["field"]), row["place"]), row["seq"])
        return found

    def apply(self, change: Change, seq: int) -> None:
        if change.op == "create":
            self.exists, self.since, self.fields, self.types = True, seq, {}, {}
        elif change.op == "delete":
            self.exists, self.fields, self.types = False, {}, {}
        elif change.op == "drop":
            del self.fields[change.number]
        elif change.op == "add":
            self.fields[change.number] = Field(change.number, change.place, change.field)
            self.types[change.number] = [(seq, change.field.dataType)]
            self.next_number = max(self.next_number, change.number + 1)
        else:
            self.fields[change.number] = replace(self.fields[change.number], field=change.field)
            if change.op == "retype":
                self.types[change.number].append((seq, change.field.dataType))
        self.epoch = seq

    def ordered(self) -> list[Field]:
        return sorted(self.fields.values(), key=lambda f: (f.place, f.number))

    def struct(self) -> T.StructType:
        return T.StructType([f.field for f in self.ordered()])

    def _find(self, name: str) -> Field:
        for found in self.fields.values():
            if found.name == name:
                return found
        raise KeyError(f"the sheet has no column {name!r}")

    # What a schema edit means here; each checks the schema that it leads to.

    def created(self, schema: T.StructType) -> list[Change]:
        schemas.check_names(schema)
        schemas.check_supported(schema)
        first = self.next_number
        adds = [Change("add", first + i, f, float(i)) for i, f in enumerate(schema.fields)]
        return [Change("create"), *adds]

    def inserted(self, index: int, name: str, declared: Any) -> Change:
        field = schemas.insert(self.struct(), index, name, declared)[name]
        order = self.ordered()
        index = max(0, len(order) + index) if index < 0 else min(index, len(order))  # as in a list
        before = order[index - 1].place if index else (order[0].place - 2 if order else -2)
        after = order[index].place if index < len(order) else before + 2
        return Change("add", self.next_number, field, (before + after) / 2)

    def renamed(self, old: str, new: str) -> Change:
        found = self._find(old)
        return Change("rename", found.number, schemas.rename(self.struct(), old, new)[new])

    def retyped(self, name: str, declared: Any) -> Change:
        found = self._find(name)
        return Change("retype", found.number, schemas.astype(self.struct(), name, declared)[name])

    def dropped(self, name: str) -> Change:
        return Change("drop", self._find(name).number)


def log_rows(df: DataFrame, sheet: str) -> list:
    return df.where(F.col("sheet") == sheet).select("seq", "op", "field_id", "field", "place").collect()


def stored_edits(edits: DataFrame, schema: SheetSchema, first_seq: int) -> DataFrame:
    """Edits as they are stored: ``record_key, seq, op, cols, set``, columns by number.

    ``edits`` has ``record_key``, ``op``, ``seq`` (their order), ``set`` (the names that an update
    supplies) and the sheet's columns; a column that is missing is null.
    """
    fields = schema.ordered()
    known = {f.name for f in fields}
    unknown = set(edits.columns) - known - {"record_key", "op", "seq", "set"}
    if unknown:
        raise KeyError(f"the sheet has no columns {sorted(unknown)}")
    values = [
        (F.col(f.name) if f.name in edits.columns else F.lit(None)).cast(f.field.dataType).alias(f"f{f.number}")
        for f in fields
    ]
    numbers = F.create_map(*(x for f in fields for x in (F.lit(f.name), F.lit(f"f{f.number}"))))
    named = F.col("set") if "set" in edits.columns else F.lit(None).cast("array<string>")
    number = F.transform(
        named,
        lambda n: F.coalesce(
            numbers[n], F.raise_error(F.concat(F.lit("the sheet has no column "), n)).cast("string")
        ),
    )
    return edits.select(
        F.col("record_key").cast("string").alias("record_key"),
        (F.col("seq") + first_seq).cast("bigint").alias("seq"),
        "op",
        F.struct(*values).alias("cols"),
        number.alias("set"),
    )


def _converted(value: Column, types: Sequence[T.DataType]) -> Column:
    """A value through the types that its column took; null where one cannot hold it."""
    for dtype in types:
        value = value.try_cast(dtype)
    return value


def upgraded(edits: DataFrame, epoch: int, schema: SheetSchema) -> DataFrame:
    """Stored edits of an epoch as edits of a later schema of the same lifetime of the sheet.

    A renamed column keeps its values, a retyped one has them converted, a dropped one loses them, and
    one that did not exist yet is null; of a column that was dropped and added again, they are gone.
    """
    written = edits.schema["cols"].dataType
    values = []
    for f in schema.ordered():
        column = f"f{f.number}"
        if column in written.names:
            later = [dtype for seq, dtype in schema.types[f.number] if seq > epoch]
            value = _converted(F.col("cols").getField(column), later)
        else:
            value = F.lit(None).cast(f.field.dataType)
        values.append(value.cast(f.field.dataType).alias(f.name, metadata=f.field.metadata))
    names = F.create_map(*(x for f in schema.ordered() for x in (F.lit(f"f{f.number}"), F.lit(f.name))))
    renamed = F.array_compact(F.transform("set", lambda n: names[n]))
    return edits.select("record_key", "seq", "op", F.struct(*values).alias("cols"), renamed.alias("set"))
