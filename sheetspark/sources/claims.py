"""Names that only one writer can take: files that are created if there is none of that name."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has taken the name."""


def file_system(spark: SparkSession, path: str):
    """Spark's file system for a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def claim(spark: SparkSession, path: str, text: str) -> None:
    """Create a file with a line of text; refused if it exists."""
    files, where = file_system(spark, path)
    try:
        stream = files.create(where, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise Conflict(f"{path} exists") from None
        raise
    stream.write(bytearray(text.encode() + b"\n"))
    stream.close()
