"""Row accessors: a Python function of a row becomes a Spark ``Column``.

The function is called once, on the driver, with a :class:`Record`.  Indexing
the record gives typed values; their operators build ordinary column
expressions, so no Python runs on the executors.

Predicates over the elements of an array are kept open (:class:`Elements`)
until ``any``/``all``/``sum``... closes them.  Only then is the array column
built, from the arrays of just those element fields the predicate reads
(``boxes.category`` rather than ``boxes``), which lets the Parquet reader skip
every other element field.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.functions import rules
from sheetspark.functions.rules import Value

Path = tuple[str, ...]
_scopes = itertools.count()


class Operand:
    """Python operators, deferred to ``_apply``."""

    __hash__ = object.__hash__

    def _apply(self, operation: Callable[[Any, Any], Value], left: Any, right: Any) -> Any:
        raise NotImplementedError

    def __eq__(self, other: Any) -> Any:
        return self._apply(rules.equals, self, other)

    def __ne__(self, other: Any) -> Any:
        return self._apply(rules.differs, self, other)

    def __gt__(self, other: Any) -> Any:
        return self._apply(rules.greater, self, other)

    def __ge__(self, other: Any) -> Any:
        return self._apply(rules.at_least, self, other)

    def __lt__(self, other: Any) -> Any:
        return self._apply(rules.less, self, other)

    def __le__(self, other: Any) -> Any:
        return self._apply(rules.at_most, self, other)

    def __and__(self, other: Any) -> Any:
        return self._apply(rules.both, self, other)

    def __rand__(self, other: Any) -> Any:
        return self._apply(rules.both, other, self)

    def __or__(self, other: Any) -> Any:
        return self._apply(rules.either, self, other)

    def __ror__(self, other: Any) -> Any:
        return self._apply(rules.either, other, self)

    def __add__(self, other: Any) -> Any:
        return self._apply(rules.add, self, other)

    def __radd__(self, other: Any) -> Any:
        return self._apply(rules.add, other, self)

    def __sub__(self, other: Any) -> Any:
        return self._apply(rules.subtract, self, other)

    def __rsub__(self, other: Any) -> Any:
        return self._apply(rules.subtract, other, self)

    def __mul__(self, other: Any) -> Any:
        return self._apply(rules.multiply, self, other)

    def __rmul__(self, other: Any) -> Any:
        return self._apply(rules.multiply, other, self)

    def __truediv__(self, other: Any) -> Any:
        return self._apply(rules.divide, self, other)

    def __rtruediv__(self, other: Any) -> Any:
        return self._apply(rules.divide, other, self)

    def __mod__(self, other: Any) -> Any:
        return self._apply(rules.modulo, self, other)

    def __rmod__(self, other: Any) -> Any:
        return self._apply(rules.modulo, other, self)

    def __pow__(self, other: Any) -> Any:
        return self._apply(rules.power, self, other)

    def __rpow__(self, other: Any) -> Any:
        return self._apply(rules.power, other, self)

    def __invert__(self) -> Any:
        return self._apply(lambda value, _: rules.negate(value), self, self)

    def __bool__(self) -> bool:
        raise TypeError("use '&', '|' and '~' instead of 'and', 'or' and 'not'")


class Scalar(Operand, Value):
    """One value per row."""

    def _apply(self, operation: Callable[[Any, Any], Value], left: Any, right: Any) -> Any:
        for side in (left, right):
            if isinstance(side, Elements):
                return side._apply(operation, left, right)
        return scalar(operation(left, right))


def scalar(value: Value) -> Scalar:
    return Scalar(value.column, value.dtype, value.info)


class Record:
    """A row, or a nested record of a row."""

    def __init__(
        self,
        fields: T.StructType,
        get: Callable[[str], Column],
        column: Column,
        key: Any,
        computed: frozenset[str] = frozenset(),
    ) -> None:
        self.fields = fields
        self._get = get
        self.column = column
        self.key = key
        self.computed = computed  # columns that no source has as they are

    def __getitem__(self, name: str) -> Any:
        field = find_field(self.fields, name)
        result = wrap(
            self._get(field.name), field.dataType, field.metadata, (self.key, field.name)
        )
        if isinstance(result, RecordArray):
            result.source.computed = field.name in self.computed
        return result

    def keys(self) -> list[str]:
        return self.fields.fieldNames()

    def items(self) -> list[tuple[str, Any]]:
        return [(name, self[name]) for name in self.keys()]


def find_field(fields: T.StructType, name: str) -> T.StructField:
    """Find a field by exact name first, then ignoring case."""
    for field in fields.fields:
        if field.name == name:
            return field
    matches = [field for field in fields.fields if field.name.lower() == name.lower()]
    if len(matches) != 1:
        reason = "is ambiguous" if matches else "does not exist"
        raise KeyError(f"field {name!r} {reason} in {fields.fieldNames()}")
    return matches[0]


def wrap(column: Column, dtype: T.DataType, info: Any, key: Any) -> Any:
    """Choose the accessor for a column by its type."""
    if isinstance(dtype, T.StructType):
        return Record(dtype, column.getField, column, key)
    if isinstance(dtype, T.ArrayType):
        source = Source(column, dtype.elementType, (info or {}).get("items"), key)
        if isinstance(dtype.elementType, T.StructType):
            return RecordArray(source, (), dtype.elementType)
        return Elements.of(source, ())
    return Scalar(column, dtype, info)


class Source:
    """An array column that element expressions read from."""

    def __init__(self, column: Column, item: T.DataType, info: Any, key: Any) -> None:
        self.column = column
        self.item = item
        self.info = dict(info or {})
        self.key = key
        self.computed = False

    def field(self, path: Path) -> Column:
        """The array of one element field, as long as the array itself."""
        column = self.column
        for name in path:
            column = column.getField(name)
        return column

    def typed(self, path: Path, column: Column) -> Scalar:
        dtype, info = self.item, self.info
        for name in path:
            field = find_field(dtype, name)
            dtype, info = field.dataType, field.metadata
        return Scalar(column, dtype, info)

    def first_leaf(self) -> Path:
        """The element field that is cheapest to read when only the length matters."""
        path: Path = ()
        dtype = self.item
        while isinstance(dtype, T.StructType):
            field = min(dtype.fields, key=lambda f: isinstance(f.dataType, T.ArrayType))
            path += (field.name,)
            dtype = field.dataType
        return path


class Elements(Operand):
    """One value per element of an array, not yet turned into a column."""

    def __init__(
        self, source: Source, paths: list[Path], build: Callable[[dict[Path, Scalar]], Value]
    ) -> None:
        self.source = source
        self.paths = paths
        self.build = build
        self.bare = False  # the values are a field as it is
        self.wanted: Column | None = None  # the predicate is "field == wanted"
        self.unwanted: Column | None = None  # the predicate is "field != unwanted"

    @classmethod
    def of(cls, source: Source, path: Path) -> Elements:
        elements = cls(source, [path], lambda env: env[path])
        elements.bare = True
        return elements

    def _apply(self, operation: Callable[[Any, Any], Value], left: Any, right: Any) -> Elements:
        paths: list[Path] = []
        for side in (left, right):
            if isinstance(side, Elements):
                if side.source.key != self.source.key:
                    raise ValueError("element expressions of two different arrays cannot be mixed")
                paths += [path for path in side.paths if path not in paths]

        def build(env: dict[Path, Scalar]) -> Scalar:
            sides = [s.build(env) if isinstance(s, Elements) else s for s in (left, right)]
            return scalar(operation(*sides))

        result = Elements(self.source, paths, build)
        if self.bare and not isinstance(right, (Operand, Column)):
            if operation is rules.equals:
                result.wanted = self._same_type(right)
            elif operation is rules.differs:
                result.unwanted = self._same_type(right)
        return result

    def _same_type(self, value: Any) -> Column | None:
        """The literal as a column, if the comparison needs no cast."""
        typed = self._typed()
        wanted = rules.literal(value, typed)
        return wanted.column if wanted.dtype == typed.dtype else None

    def _typed(self) -> Value:
        return self.build({p: self.source.typed(p, F.lit(None)) for p in self.paths})

    @property
    def family(self) -> str:
        return self._typed().family

    @property
    def info(self) -> dict[str, Any]:
        return self._typed().info

    def _over(self, function: Callable[[Column, Callable[[Column], Column]], Column]) -> Column:
        """Call an array function on the arrays of the fields read, and nothing else."""
        if len(self.paths) == 1:
            path = self.paths[0]
            return function(
                self.source.field(path),
                lambda element: self.build({path: self.source.typed(path, element)}).column,
            )
        if self.source.computed:
            # An array that is computed is computed once; there is no reader to prune it.
            return function(
                self.source.column,
                lambda element: self.build(
                    {p: self.source.typed(p, _inner(element, p)) for p in self.paths}
                ).column,
            )
        names = {path: f"f{i}" for i, path in enumerate(self.paths)}
        zipped = F.arrays_zip(*[self.source.field(p).alias(n) for p, n in names.items()])
        return function(
            zipped,
            lambda element: self.build(
                {p: self.source.typed(p, element.getField(n)) for p, n in names.items()}
            ).column,
        )

    @property
    def column(self) -> Column:
        """The array of values."""
        if self.bare:
            return self.source.field(self.paths[0])
        return self._over(F.transform)

    def any(self) -> Scalar:
        """Whether some element is true; false for an empty array.

        Searching for one value is ``array_contains``, which gives the same as
        ``exists`` and, unlike it, is compiled into the stage.
        """
        if self.wanted is not None:
            found = F.array_contains(self.source.field(self.paths[0]), self.wanted)
            return Scalar(found, T.BooleanType())
        return Scalar(self._over(F.exists), T.BooleanType())

    def all(self) -> Scalar:
        """Whether every element is true; true for an empty array."""
        if self.unwanted is not None:
            found = F.array_contains(self.source.field(self.paths[0]), self.unwanted)
            return Scalar(~found, T.BooleanType())
        return Scalar(self._over(F.forall), T.BooleanType())

    def size(self) -> Scalar:
        length = F.array_size(self.source.field(self.paths[0]))
        return Scalar(length.cast("bigint"), T.LongType())

    def max(self) -> Scalar:
        typed = self._typed()
        return Scalar(F.array_max(self.column), typed.dtype, typed.info)

    def min(self) -> Scalar:
        typed = self._typed()
        return Scalar(F.array_min(self.column), typed.dtype, typed.info)

    def sum(self) -> Scalar:
        """Sum without the nulls; 0 for an empty array, null for a null one."""
        typed = self._typed()
        if typed.family != "number":
            raise TypeError(f"sum is not defined for {typed.family}")
        wide: T.DataType = (
            T.LongType()
            if isinstance(typed.dtype, (T.IntegerType, T.LongType))
            else T.DoubleType()
        )
        zero = F.lit(0).cast(wide)
        total = F.aggregate(
            self.column, zero, lambda acc, item: acc + F.coalesce(item.cast(wide), zero)
        )
        return Scalar(total, wide)

    def query(self, predicate: Callable[[Any], Any]) -> Elements:
        """Keep the elements for which the predicate is true."""
        typed = self._typed()
        key = next(_scopes)
        kept = F.filter(
            self.column,
            lambda item: boolean_column(
                predicate(wrap(item, typed.dtype, typed.info, (key, "item")))
            ),
        )
        return Elements.of(Source(kept, typed.dtype, typed.info, (key, "kept")), ())

    def each(self, function: Callable[[Any], Any]) -> Elements:
        """Map every element; the way into an array of arrays."""
        key = next(_scopes)

        def build(env: dict[Path, Scalar]) -> Value:
            value = self.build(env)
            result = function(wrap(value.column, value.dtype, value.info, (key, "item")))
            return result if isinstance(result, Value) else Scalar(result.column, None)

        return Elements(self.source, self.paths, build)


def _inner(element: Column, path: Path) -> Column:
    for name in path:
        element = element.getField(name)
    return element


class RecordArray:
    """An array of records, or one nested record of its elements."""

    def __init__(self, source: Source, prefix: Path, fields: T.StructType) -> None:
        self.source = source
        self.prefix = prefix
        self.fields = fields

    @property
    def column(self) -> Column:
        return self.source.field(self.prefix)

    def __getitem__(self, name: str) -> Any:
        field = find_field(self.fields, name)
        path = self.prefix + (field.name,)
        if isinstance(field.dataType, T.StructType):
            return RecordArray(self.source, path, field.dataType)
        return Elements.of(self.source, path)

    def query(self, predicate: Callable[[Record], Any]) -> RecordArray:
        """Keep the records for which the predicate is true."""
        key = next(_scopes)
        kept = F.filter(
            self.column,
            lambda item: boolean_column(
                predicate(Record(self.fields, item.getField, item, (key, "item")))
            ),
        )
        return RecordArray(Source(kept, self.fields, None, (key, "kept")), (), self.fields)

    def each(self, function: Callable[[Record], Any]) -> Elements:
        """Map every record to one value."""
        key = next(_scopes)
        prefix, fields = self.prefix, self.fields

        def build(env: dict[Path, Scalar]) -> Value:
            item = env[prefix].column
            result = function(Record(fields, item.getField, item, (key, "item")))
            return result if isinstance(result, Value) else Scalar(result.column, None)

        return Elements(self.source, [prefix], build)

    def size(self) -> Scalar:
        length = F.array_size(self.source.field(self.source.first_leaf()))
        return Scalar(length.cast("bigint"), T.LongType())


def row(df: DataFrame) -> Record:
    """The accessor of a whole row of ``df``."""
    return Record(
        df.schema,
        lambda name: F.col("`" + name.replace("`", "``") + "`"),
        F.struct("*"),
        "row",
        _computed(df),
    )


def _computed(df: DataFrame) -> frozenset[str]:
    """The arrays of records that some projection of ``df`` computes.

    A column is read as it is if it leads to the output of a leaf of the plan, over renamings.
    """
    arrays = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType)
    }
    if not arrays or not hasattr(df, "_jdf"):
        return frozenset()
    plan = df._jdf.queryExecution().analyzed()
    read, renamed = set(), {}
    for leaf in _items(plan.collectLeaves()):
        read.update(attribute.exprId().id() for attribute in _items(leaf.output()))
    todo = [plan]
    while todo:
        node = todo.pop()
        todo += _items(node.children())
        if node.nodeName() == "Project":
            for item in _items(node.projectList()):
                if item.nodeName() == "Alias" and item.child().nodeName() == "AttributeReference":
                    renamed[item.exprId().id()] = item.child().exprId().id()
    found = set()
    for attribute in _items(plan.output()):
        at = attribute.exprId().id()
        while at not in read and at in renamed:
            at = renamed[at]
        if at not in read and attribute.name() in arrays:
            found.add(attribute.name())
    return frozenset(found)


def _items(sequence: Any) -> list[Any]:
    return [sequence.apply(i) for i in range(sequence.size())]


def column_of(result: Any) -> Column:
    """The Spark column behind whatever a row function returned."""
    if isinstance(result, Column):
        return result
    if isinstance(result, (Value, Elements, Record, RecordArray)):
        return result.column
    return F.lit(result)


def boolean_column(result: Any) -> Column:
    if isinstance(result, Value) and result.family not in ("boolean", "any"):
        raise TypeError(f"the predicate must be boolean, not {result.family}")
    if isinstance(result, (Elements, Record, RecordArray)):
        raise TypeError("close an element predicate with .any() or .all()")
    return column_of(result)
