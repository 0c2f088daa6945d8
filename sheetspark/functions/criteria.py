"""Saved searches: a dict of ``$`` operators evaluated through the accessors.

``{"where": {"$any_match": ["$.boxes", {"$eq": ["$.category", 1]}]}}`` names
columns as ``$.a.b`` and, inside an array operator, element fields as ``$.f``
(or ``$.`` for the element itself).  Enum literals are codes and temporal
literals are integers in the unit of their column.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping
from typing import Any

from sheetspark.functions.accessor import Elements, Operand, RecordArray
from sheetspark.functions.rules import EnumCode

# The names of the operators in a search.
BINARY = {
    "$eq": operator.eq,
    "$ne": operator.ne,
    "$gt": operator.gt,
    "$gte": operator.ge,
    "$lt": operator.lt,
    "$lte": operator.le,
    "$add": operator.add,
    "$sub": operator.sub,
    "$mult": operator.mul,
    "$div": operator.truediv,
    "$mod": operator.mod,
    "$pow": operator.pow,
}
FOLDS = {"$and": operator.and_, "$or": operator.or_}
REDUCTIONS = ("$size", "$max", "$min", "$sum")
ARRAY_OPERATORS = ("$any_match", "$all_match", "$filter", *REDUCTIONS)


class CriteriaError(ValueError):
    """The search dict is not well formed."""


def is_path(expr: Any) -> bool:
    return isinstance(expr, str) and expr.startswith("$.")


def evaluate(expr: Any, scope: Any) -> Any:
    """Evaluate a criteria expression against a row, an element or an array of elements."""
    if is_path(expr):
        try:
            return functools.reduce(operator.getitem, filter(None, expr[2:].split(".")), scope)
        except (KeyError, TypeError) as error:
            raise CriteriaError(f"cannot resolve {expr!r}") from error
    if not isinstance(expr, Mapping):
        return expr
    if len(expr) != 1:
        raise CriteriaError(f"expected a single operator in {expr!r}")
    ((name, args),) = expr.items()
    if name in BINARY:
        left, right = (evaluate(arg, scope) for arg in args)
        return BINARY[name](_coded(left, right), _coded(right, left))
    if name in FOLDS:
        return functools.reduce(FOLDS[name], (evaluate(arg, scope) for arg in args))
    if name in ("$any_match", "$all_match"):
        array, test = _two(name, args)
        predicate = _over_elements(test, evaluate(array, scope))
        if not isinstance(predicate, Elements):
            raise CriteriaError(f"{name} needs a predicate over the elements of {args[0]!r}")
        return predicate.any() if name == "$any_match" else predicate.all()
    if name == "$filter":
        array, test = _two(name, args)
        return evaluate(array, scope).query(lambda item: evaluate(test, item))
    if name in REDUCTIONS:
        parts = args if isinstance(args, list) else [args]
        array = evaluate(parts[0], scope) if parts else None
        if len(parts) == 2 and name != "$size":
            array = _over_elements(parts[1], array)
        elif len(parts) != 1:
            raise CriteriaError(f"{name} takes an array{'' if name == '$size' else ', and what to take of its elements'}")
        if not isinstance(array, (Elements, RecordArray)) or not hasattr(array, name[1:]):
            raise CriteriaError(f"{name} needs an array of values, not {parts[0]!r}")
        return getattr(array, name[1:])()
    raise CriteriaError(f"operator {name!r} is not supported")


def _two(name: str, args: Any) -> tuple[Any, Any]:
    if not isinstance(args, (list, tuple)) or len(args) != 2:
        raise CriteriaError(f"{name} takes an array and an expression over its elements")
    return args[0], args[1]


def _over_elements(expr: Any, array: Any) -> Any:
    """An expression over the elements of an array.

    One that looks into arrays inside the elements is evaluated element by element; any other
    reads only the element fields it names.
    """
    if not isinstance(array, (Elements, RecordArray)):
        raise CriteriaError(f"{expr!r} needs an array to look into")
    if _nests(expr):
        return array.each(lambda item: evaluate(expr, item))
    return evaluate(expr, array)


def _nests(expr: Any) -> bool:
    if isinstance(expr, Mapping):
        return any(name in ARRAY_OPERATORS or _nests(args) for name, args in expr.items())
    return isinstance(expr, (list, tuple)) and any(map(_nests, expr))


def _coded(value: Any, other: Any) -> Any:
    """Read an integer literal as an enum code when the other side is an enum."""
    if type(value) is int and isinstance(other, Operand) and other.family == "enum":
        return EnumCode(value)
    return value
