"""Whole-sheet measures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetspark.schema import leaf_count
from sheetspark.sources.files import file_references


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("record_count"))


def sheet_counts(rows: DataFrame, sheet: str = "sheet") -> DataFrame:
    """The row count of every sheet of a revision."""
    return rows.groupBy(sheet).agg(F.count(F.lit(1)).alias("record_count"))


def shape(df: DataFrame) -> DataFrame:
    """Rows, top-level columns and their product."""
    columns = F.lit(len(df.columns)).cast("bigint")
    return row_count(df).select(
        F.col("record_count").alias("n_rows"),
        columns.alias("n_columns"),
        (F.col("record_count") * columns).alias("size"),
    )


def pending_counts(df: DataFrame) -> DataFrame:
    """Rows and files that a write of ``df`` would send, and its leaf columns."""
    return df.agg(
        F.count(F.lit(1)).alias("data_count"),
        F.coalesce(F.sum(F.size(file_references(df))), F.lit(0)).cast("bigint").alias("file_count"),
    ).withColumn("leaf_columns", F.lit(leaf_count(df.schema)).cast("bigint"))
