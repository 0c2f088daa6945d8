"""Typed, nested, versioned tables on Spark: queries, edits and snapshots."""
