"""Row filters, computed columns, projections and saved searches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.functions.accessor import Elements, Value, boolean_column, column_of, row
from sheetspark.functions.criteria import CriteriaError, evaluate, is_path

RESULT = "apply_result"


def query(df: DataFrame, predicate: Callable[[Any], Any]) -> DataFrame:
    """Keep the rows for which ``predicate(row)`` is true."""
    return df.where(boolean_column(predicate(row(df))))


def apply(
    df: DataFrame, function: Callable[[Any], Any], name: str = RESULT, keep: Sequence[str] = ()
) -> DataFrame:
    """Compute one column from each row, next to the columns in ``keep``."""
    return df.select(*keep, _result(function(row(df)), name))


def _result(result: Any, name: str) -> Column:
    info = {}
    if isinstance(result, Value):
        info = result.info
    elif isinstance(result, Elements) and result.info:
        info = {"items": result.info}
    return column_of(result).alias(name, metadata=info) if info else column_of(result).alias(name)


def select(df: DataFrame, columns: Mapping[str, Any] | Sequence[Any]) -> DataFrame:
    """Project to named columns.

    Each entry is a path such as ``"a.b"`` or ``{name: path or function}``.  A
    dotted name builds nested records; two names that need the same place raise.
    """
    named: list[tuple[str, Any]] = []
    for item in [columns] if isinstance(columns, Mapping) else columns:
        named += item.items() if isinstance(item, Mapping) else [(item, item)]
    record = row(df)
    built = []
    for name, source in named:
        if isinstance(source, str):
            built.append((name, evaluate("$." + source, record)))
        else:
            built.append((name, source(record) if callable(source) else source))
    return df.select(*_nested(built))


def _nested(named: Sequence[tuple[str, Any]]) -> list[Column]:
    tree: dict[str, Any] = {}
    for name, result in named:
        *parents, last = name.split(".")
        level = tree
        for parent in parents:
            level = level.setdefault(parent, {})
            if not isinstance(level, dict):
                raise CriteriaError(f"{name!r} conflicts with another column")
        if last in level:
            raise CriteriaError(f"{name!r} conflicts with another column")
        level[last] = result

    def column(name: str, node: Any) -> Column:
        if isinstance(node, dict):
            return F.struct(*[column(n, child) for n, child in node.items()]).alias(name)
        return _result(node, name)

    return [column(name, node) for name, node in tree.items()]


def search(df: DataFrame, criteria: Mapping[str, Any]) -> DataFrame:
    """Run a saved search: an optional ``where`` and an optional ``select``."""
    record = row(df)
    if criteria.get("where") is not None:
        df = df.where(boolean_column(evaluate(criteria["where"], record)))
    if not criteria.get("select"):
        return df
    named = []
    for item in criteria["select"]:
        if is_path(item):
            named.append((item[2:], evaluate(item, record)))
        elif isinstance(item, Mapping) and len(item) == 1:
            ((name, expr),) = item.items()
            named.append((name, evaluate(expr, record)))
        else:
            raise CriteriaError(f"invalid column {item!r} in 'select'")
    return df.select(*_nested(named))
