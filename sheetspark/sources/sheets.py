"""Stored sheets: one folder of Parquet per sheet of a data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetspark import schema as schemas
from sheetspark.operators.checks import require_declared

RECORD_KEY = "__record_key"


def write_sheet(df: DataFrame, root: str, sheet: str, mode: str = "errorifexists") -> None:
    """Store a sheet.  Names are checked here, enums and array lengths by the write itself."""
    schemas.check_names(df.schema)
    schemas.check_supported(df.schema)
    require_declared(df).write.mode(mode).parquet(f"{root}/{sheet}")


def read_sheet(spark: SparkSession, root: str, sheet: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{sheet}")


def append_edits(ops: DataFrame, path: str) -> None:
    """Add the edits of a commit to a stored log, one folder per commit."""
    ops.write.mode("append").partitionBy("commit_id").parquet(path)


def write_bucketed(
    df: DataFrame, table: str, key: str = RECORD_KEY, buckets: int = 1024, path: str | None = None
) -> None:
    """Store a sheet bucketed by record key.

    Keyed edits of a bucketed sheet join without shuffling it: only the edits,
    which are small beside the sheet, move.
    """
    schemas.check_names(df.schema)
    schemas.check_supported(df.schema)
    writer = require_declared(df).write.mode("errorifexists").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
