"""Every operator as a query over the given tables, next to the SQL it must equal."""

from sheetspark.plans import (
    arrays,
    edits,
    files,
    filters,
    history,
    loading,
    positions,
    projections,
    repository,
    validation,
)
from sheetspark.plans.registry import ORACLE, QUERIES

__all__ = [
    "ORACLE",
    "QUERIES",
    "arrays",
    "edits",
    "files",
    "filters",
    "history",
    "loading",
    "positions",
    "projections",
    "repository",
    "validation",
]
