"""Sheets whose order is stored: every row has a label, and rows follow their labels.

Rows that come in between two neighbours get labels between theirs, so a slice may be replaced by
more or fewer rows without a new number for the rest of the sheet.  Where the gap is too narrow,
the rows of the smallest aligned range of labels around it that is sparse enough are spread evenly
over that range.  A range of 2**k labels counts as sparse with at most 1.6**k rows: the wider, the
sparser, so that a range that has been spread takes many rows until it has to be spread again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.operators.checks import require_same_schema
from sheetspark.operators.order import Positions

LABEL = "__place"
#: Labels are 0 to 2**BITS - 1.
BITS = 62
#: A range of 2**k labels is sparse with at most SPARSE**k rows, 4 * 10**12 in the whole space.
SPARSE = 1.6


@dataclass(frozen=True)
class Splice:
    """What replacing a slice does: rows that stay as they are, and rows that are written."""

    untouched: DataFrame
    written: DataFrame
    #: The labels ``[low, high)`` that were spread anew; empty if the gap was wide enough.
    low: int
    high: int
    #: How many rows of the sheet were removed, and how many others got a new label.
    removed: int
    moved: int

    def sheet(self) -> DataFrame:
        return self.untouched.unionByName(self.written)


def labelled(
    df: DataFrame, order: str | Sequence[str], label: str = LABEL, spacing: int | None = None
) -> DataFrame:
    """``df`` with labels in the given order, whose columns identify a row.

    Labels are ``spacing`` apart, by default as far as the space allows.
    """
    positions = Positions(df, order)
    gap = spacing or (1 << BITS) // (positions.count + 1)
    if gap < 1 or gap * (positions.count + 1) > 1 << BITS:
        raise ValueError(f"no room for {positions.count} rows that are {gap} labels apart")
    numbered = positions.rows(0, positions.count)
    return numbered.withColumn(label, (F.col("pos") + 1) * gap).drop("pos")


def _label_at(positions: Positions, place: int, label: str) -> int:
    return positions.rows(place, place + 1).select(label).first()[0]


def _sparse_range(kept: DataFrame, label: str, anchor: int, more: int) -> tuple[int, int, int]:
    """(low, high, rows) of the smallest aligned range around ``anchor`` with room for ``more`` rows.

    One scan of the labels: a row is in the range of 2**k labels around the anchor if both differ
    in their last k binary digits only.
    """
    apart = F.col(label).bitwiseXOR(F.lit(anchor).cast("bigint"))
    digits = F.when(apart == 0, 0).otherwise(F.length(F.bin(apart)))
    sizes = {r["digits"]: r["count"] for r in kept.groupBy(digits.alias("digits")).count().collect()}
    held = 0
    for bits in range(BITS + 1):
        held += sizes.get(bits, 0)
        if held + more <= int(SPARSE**bits):
            low = anchor >> bits << bits
            return low, low + (1 << bits), held
    raise ValueError(f"a sheet of {held} rows has no room for {more} more")


def plan_splice(
    df: DataFrame,
    rows: DataFrame,
    rows_order: str | Sequence[str],
    start: int | None = None,
    stop: int | None = None,
    label: str = LABEL,
) -> Splice:
    """``sheet[start:stop] = rows`` for a labelled sheet, as Python does it with a list.

    ``rows`` may be fewer or more than the slice, or none; a slice that ends before it starts is
    the empty one at ``start``.  They come in the order of ``rows_order``, whose columns identify a
    row of ``rows`` and may be columns that the sheet lacks; other columns must be the sheet's, and
    those that are missing become null.  Labels must be unique and not null.  ``df`` must give the
    same rows when it is read again, as a stored sheet does.
    """
    order = [rows_order] if isinstance(rows_order, str) else list(rows_order)
    unknown = set(rows.columns) - set(df.columns) - set(order)
    if unknown:
        raise KeyError(f"the sheet has no columns {sorted(unknown)}")
    positions = Positions(df, label)
    begin, end, _ = slice(start, stop).indices(positions.count)
    end = max(begin, end)
    left = _label_at(positions, begin - 1, label) if begin else -1
    right = _label_at(positions, end, label) if end < positions.count else 1 << BITS

    added = Positions(rows, order)
    place = F.col("pos")
    numbered = added.rows(0, added.count)
    if right - left > added.count:
        step = (right - left) // (added.count + 1)
        new = _as_sheet(numbered, df, label, left + (place + 1) * step)
        kept = df if begin == end else df.where(_outside(label, left, right))
        return Splice(kept, new, 0, 0, end - begin, 0)

    kept = df.where(_outside(label, left, right))
    low, high, held = _sparse_range(kept.select(label), label, max(left, 0), added.count)
    step = (high - low) // (held + added.count)
    inside = (F.col(label) >= low) & (F.col(label) < high)
    around = Positions(kept.where(inside), label)
    before = kept.where(inside & (F.col(label) <= left)).count()
    later = place + F.when(F.col(label) > left, added.count).otherwise(0)
    moved = _as_sheet(around.rows(0, around.count), df, label, low + later * step + step // 2)
    new = _as_sheet(numbered, df, label, low + (place + before) * step + step // 2)
    return Splice(kept.where(~inside), moved.unionByName(new), low, high, end - begin, held)


def splice(
    df: DataFrame,
    rows: DataFrame,
    rows_order: str | Sequence[str],
    start: int | None = None,
    stop: int | None = None,
    label: str = LABEL,
) -> DataFrame:
    """The sheet after :func:`plan_splice`."""
    return plan_splice(df, rows, rows_order, start, stop, label).sheet()


def insert_rows(
    df: DataFrame, rows: DataFrame, rows_order: str | Sequence[str], at: int, label: str = LABEL
) -> DataFrame:
    """``rows`` before the row at a position; at the end for a position after the last."""
    return splice(df, rows, rows_order, at, at, label)


def _outside(label: str, left: int, right: int) -> Column:
    return (F.col(label) <= left) | (F.col(label) >= right)


def _as_sheet(numbered: DataFrame, sheet: DataFrame, label: str, place: Column) -> DataFrame:
    """Numbered rows with their labels and the columns of the sheet."""
    columns = [
        place.cast("bigint").alias(label)
        if f.name == label
        else F.col(f"`{f.name}`")
        if f.name in numbered.columns
        else F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in sheet.schema.fields
    ]
    result = numbered.select(*columns)
    require_same_schema(sheet.drop(label).schema, result.drop(label).schema)
    return result
