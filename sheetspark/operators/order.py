"""Ordered and positional reads.

A sheet has no stored positions; they follow from an order whose columns
together identify a row.  Small reads at either end are a top-k.  Everything
else goes through :class:`Positions`, which never sorts the sheet in one task:

1. a bounded sample of the keys gives range bounds, which become *literals*;
2. one counting scan of the key columns gives the rows in each range, hence the
   position at which each range starts;
3. a read keeps only the ranges it touches (the bounds reach the Parquet reader
   as pushed filters) and numbers the rows inside each range in parallel.

Consecutive rows need no numbers: the keys at the two ends are looked up, and
the read is a filter between two literals that shuffles nothing.

The bounds are fixed literals, so a lost executor recomputes the same ranges.
How good the sample was affects only how even the ranges are, not the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetspark.runtime import ensure_checkpoints

TOP_K = 10_000  # largest read that is kept in memory as a top-k
RANGE_ROWS = 50_000  # rows aimed at in one range
MAX_RANGES = 16_384  # bounds the sample and the counts that reach the driver
SAMPLE_PER_RANGE = 16

# Keys travel as JSON literals; timestamps keep their microseconds.
KEY_FORMAT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def order_by(df: DataFrame, columns: str | Sequence[str], key: str) -> DataFrame:
    """Order by (nested) columns, ``"a|b.c"`` or a list; ties by the record key."""
    return df.orderBy(*_ascending(_names(columns)), F.col(key))


def sort(df: DataFrame, columns: str | Sequence[str], key: str | None = None) -> DataFrame:
    """Order by columns with a direction, ``"name"``, ``"-name"`` or ``"name:desc"``.

    Nulls come first ascending and last descending.
    """
    keys = []
    for part in _names(columns):
        name, _, direction = part.strip().lstrip("-").partition(":")
        down = part.strip().startswith("-") or direction.lower() == "desc"
        keys.append(F.col(name).desc_nulls_last() if down else F.col(name).asc_nulls_first())
    return df.orderBy(*keys, *([F.col(key)] if key else []))


def page(
    df: DataFrame,
    key: str,
    order_by: str | Sequence[str] = (),
    offset: int = 0,
    limit: int = 128,
    columns: str | Sequence[str] | None = None,
) -> DataFrame:
    """``limit`` rows from ``offset`` on, ordered by some columns and then by the record key.

    Columns may be given as a list or as text, ``"a|b.c"`` or ``"a,b.c"``.
    """
    keys = [*_names(order_by), key]
    if offset + limit <= TOP_K:
        rows = _first(df, keys, _ascending(keys), offset, limit)
    else:
        rows = Positions(df, keys).span(offset, offset + limit).orderBy(*_ascending(keys))
    return rows if columns is None else rows.select(*_names(columns))


def numbered(df: DataFrame, name: str = "pos") -> DataFrame:
    """The rows of an ordered frame with their place in it.

    The frame is checkpointed, since a sort that runs twice may cut its ranges differently; then
    the rows of each partition are counted and each partition adds the rows before it.
    """
    ensure_checkpoints(df.sparkSession)
    kept = df.checkpoint()
    part, row = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    counted = kept.groupBy(part.alias("part")).count().collect()
    sizes = {r["part"]: r["count"] for r in counted}
    before, starts = 0, []
    for number in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(number, 0)
    offsets = F.from_json(F.lit(str(starts)), "array<bigint>")
    return kept.withColumn(name, F.get(offsets, part) + row)


def _first(df: DataFrame, keys: Sequence[str], order: Sequence[Column], offset: int, limit: int) -> DataFrame:
    """``limit`` rows from ``offset`` on as a top-k, at most :data:`TOP_K` rows and one more.

    Rows up to there, and the one after them, must differ in the keys, as in a numbered range: else
    it would be open which rows are read.
    """
    rows = df.orderBy(*order).limit(offset + limit + 1)
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    message = F.concat(F.lit("several rows have the key "), F.to_json(key))
    tied = key.eqNullSafe(F.lag(key).over(Window.orderBy(*order))) & (F.row_number().over(Window.orderBy(*order)) > 1)
    place = F.when(tied, F.raise_error(message).cast("int")).otherwise(F.lit(0))
    checked = rows.withColumn("__tied", place).where("__tied = 0").drop("__tied")
    return checked.orderBy(*order).offset(offset).limit(limit)


def head(df: DataFrame, keys: str | Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows, in order; a negative ``n`` leaves out the last ``-n``."""
    keys = _names(keys)
    if 0 <= n <= TOP_K:
        return _first(df, keys, _ascending(keys), 0, n)
    positions = Positions(df, keys)
    rows = positions.span(0, n if n > 0 else positions.count + n)
    return rows.orderBy(*_ascending(keys))


def tail(df: DataFrame, keys: str | Sequence[str], n: int = 5) -> DataFrame:
    """The last ``n`` rows, in order; a negative ``n`` leaves out the first ``-n``."""
    keys = _names(keys)
    if n == 0:
        return df.limit(0)
    if 0 < n <= TOP_K:
        last = _first(df, keys, [F.col(k).desc_nulls_last() for k in keys], 0, n)
        return last.orderBy(*_ascending(keys))
    positions = Positions(df, keys)
    rows = positions.span(max(0, positions.count - n) if n > 0 else -n, positions.count)
    return rows.orderBy(*_ascending(keys))


def row_at(df: DataFrame, keys: str | Sequence[str], index: int) -> DataFrame:
    """The single row at a position; a negative index counts from the end."""
    positions = Positions(df, keys)
    at = index + positions.count if index < 0 else index
    if not 0 <= at < positions.count:
        raise IndexError(f"row {index} is out of range of {positions.count} rows")
    return positions.rows(at, at + 1)


def slice_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    start: int | None = None,
    stop: int | None = None,
    step: int | None = None,
) -> DataFrame:
    """The rows of ``[start:stop:step]`` with their position in the sheet as ``pos``.

    The result is a set of rows; order it by ``pos`` (descending for a negative
    step) to read it as the list slice.
    """
    return Positions(df, keys).slice(start, stop, step)


class Positions:
    """Positions of the rows of ``df`` in the order of ``keys``.

    The keys must identify a row and the frame must give the same rows when it
    is read again, as a stored sheet does.  Two rows with one key in a range that
    is numbered fail the job; they are in one range, since the whole key decides.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: str | Sequence[str],
        range_rows: int | None = None,
    ) -> None:
        self.df = df
        self.keys = _names(keys)
        if not self.keys:
            raise ValueError("positions need an order that identifies every row")
        self.count = df.count()
        wanted = min(MAX_RANGES, max(1, math.ceil(self.count / (range_rows or RANGE_ROWS))))
        levels = math.ceil(math.log2(wanted + 1)) if wanted > 1 else 0
        self._bounds = self._sample_bounds((1 << levels) - 1)
        self._steps = [1 << level for level in reversed(range(levels))] if self._bounds else []
        self.starts = self._count_ranges()

    def _sample_bounds(self, wanted: int) -> list[str]:
        """``wanted`` evenly spaced sampled keys, as JSON; none if one range is enough."""
        if wanted == 0:
            return []
        fraction = min(1.0, SAMPLE_PER_RANGE * (wanted + 1) / self.count)
        keys = self.df.select(*self._key_fields())
        if fraction < 1.0:
            keys = keys.sample(fraction, seed=7)
        sampled = self._as_json(keys.orderBy(*keys.columns))
        if not sampled:
            return []
        return [sampled[i * len(sampled) // (wanted + 1)] for i in range(1, wanted + 1)]

    def _key_fields(self) -> list[Column]:
        return [F.col(key).alias(f"k{i}") for i, key in enumerate(self.keys)]

    def _as_json(self, keys: DataFrame) -> list[str]:
        packed = F.to_json(F.struct(*keys.columns), KEY_FORMAT)
        return [r[0] for r in keys.select(packed).collect()]

    def _literals(self, keys: Sequence[str]) -> Column:
        """Keys given as JSON, as one array; Catalyst folds it to a literal."""
        schema = self.df.select(*self._key_fields()).schema
        fields = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields)
        text = F.lit("[" + ",".join(keys) + "]")
        return F.from_json(text, f"array<struct<{fields}>>", KEY_FORMAT)

    # Nulls come first.  The whole key decides; the test of the leading column
    # beside it only says less, in a form that reaches the Parquet reader.

    def _from(self, bound: Column) -> Column:
        """Rows at or after a key."""
        lead = bound.getField("k0")
        later = F.struct(*self._key_fields()) >= bound
        return ((F.col(self.keys[0]) >= lead) | lead.isNull()) & later

    def _before(self, bound: Column) -> Column:
        """Rows before a key."""
        leading = F.col(self.keys[0])
        earlier = F.struct(*self._key_fields()) < bound
        return ((leading <= bound.getField("k0")) | leading.isNull()) & earlier

    def _range(self) -> Column:
        """How many bounds are at or below the key of the row, by binary search."""
        if not self._bounds:
            return F.lit(0)
        bounds, key = self._literals(self._bounds), F.struct(*self._key_fields())
        return F.aggregate(
            F.array(*[F.lit(step) for step in self._steps]),
            F.lit(0),
            lambda found, step: F.when(
                F.element_at(bounds, found + step) <= key, found + step
            ).otherwise(found),
        )

    def _count_ranges(self) -> list[int]:
        """The position at which each range starts, and the end of the last one."""
        if not self._bounds:
            return [0, self.count]
        counted = self.df.groupBy(self._range().alias("range")).count().collect()
        sizes = {r["range"]: r["count"] for r in counted}
        starts = [0]
        for i in range(len(self._bounds) + 1):
            starts.append(starts[-1] + sizes.get(i, 0))
        return starts

    def rows(self, start: int, stop: int) -> DataFrame:
        """The rows at positions ``start <= pos < stop``, with ``pos``."""
        start, stop = max(start, 0), min(stop, self.count)
        if start >= stop:
            return self.df.limit(0).withColumn("pos", F.lit(0).cast("bigint"))
        first = max(i for i, s in enumerate(self.starts[:-1]) if s <= start)
        last = max(i for i, s in enumerate(self.starts[:-1]) if s < stop)
        rows = self.df
        if first > 0:
            rows = rows.where(self._from(self._literals(self._bounds[first - 1 : first])[0]))
        if last < len(self._bounds):
            rows = rows.where(self._before(self._literals(self._bounds[last : last + 1])[0]))
        starts = F.from_json(F.lit(str(self.starts)), "array<bigint>")
        rows = rows.withColumn("__range", self._range())
        in_order = Window.partitionBy("__range").orderBy(*_ascending(self.keys))
        within = F.row_number().over(in_order)
        key = F.struct(*self._key_fields())
        message = F.concat(F.lit("several rows have the key "), F.to_json(key))
        tied = key.eqNullSafe(F.lag(key).over(in_order)) & (within > 1)
        position = F.when(tied, F.raise_error(message).cast("bigint")).otherwise(
            F.element_at(starts, F.col("__range") + 1) + within - 1
        )
        rows = rows.withColumn("pos", position.cast("bigint")).drop("__range")
        if (start, stop) == (0, self.count):
            return rows
        return rows.where((F.col("pos") >= start) & (F.col("pos") < stop))

    def span(self, start: int, stop: int) -> DataFrame:
        """The rows at positions ``start <= pos < stop``, without ``pos`` and without a shuffle."""
        start, stop = max(start, 0), min(stop, self.count)
        if start >= stop:
            return self.df.limit(0)
        ends = [p for p in (start, stop) if 0 < p < self.count]
        found = {p: self._literals(self._as_json(self._keys_at(p)))[0] for p in ends}
        rows = self.df
        if start in found:
            rows = rows.where(self._from(found[start]))
        if stop in found:
            rows = rows.where(self._before(found[stop]))
        return rows

    def without(self, start: int, stop: int) -> DataFrame:
        """All rows but those of :meth:`span`."""
        start, stop = max(start, 0), min(stop, self.count)
        if start >= stop:
            return self.df
        return self.span(0, start).unionByName(self.span(stop, self.count))

    def _keys_at(self, position: int) -> DataFrame:
        return self.rows(position, position + 1).select(*self._key_fields())

    def slice(self, start: int | None, stop: int | None, step: int | None = None) -> DataFrame:
        """The rows of a Python slice, with ``pos``."""
        chosen = range(*slice(start, stop, step).indices(self.count))
        if not chosen:
            return self.rows(0, 0)
        low, high = min(chosen[0], chosen[-1]), max(chosen[0], chosen[-1])
        rows = self.rows(low, high + 1)
        if abs(chosen.step) == 1:
            return rows
        return rows.where((F.col("pos") - low) % abs(chosen.step) == 0)


def cells(
    df: DataFrame,
    keys: str | Sequence[str],
    columns: Sequence[str],
    start: int | None = None,
    stop: int | None = None,
    step: int | None = None,
) -> DataFrame:
    """A slice of some columns only, with ``pos``."""
    wanted = df.select(*dict.fromkeys([*_names(keys), *columns]))
    return slice_rows(wanted, keys, start, stop, step).select("pos", *columns)


def subset(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Several named columns of every row."""
    return df.select(*names)


def _names(names: str | Sequence[str]) -> list[str]:
    if isinstance(names, str):
        names = names.replace(",", "|").split("|")
    return [name for name in names if name]


def _ascending(keys: Sequence[str]) -> list[Any]:
    return [F.col(key).asc_nulls_first() for key in keys]
