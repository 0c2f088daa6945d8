"""Binary files as a table, and the file references held by sheets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.functions.images import image_format, image_size
from sheetspark.schema import FILE_FIELDS, is_file

# Suffixes that name a compression, so that ".tar.gz" stays whole.
ENCODING_SUFFIXES = (".gz", ".Z", ".bz2", ".xz", ".br")

# The last dot and what follows it, unless the dot begins or ends the name.
SUFFIX = r"^.+(\.[^.]+)$"

REFERENCE = "array<struct<path:string,file:struct<key:string,extension:string,size:bigint>>>"


def read_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The files under a path: ``path, modificationTime, length, content``.

    Spark reads the bytes only for queries that use ``content``.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def extension(path: Column) -> Column:
    """The suffix of the file name, with the one before it if it names a compression."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    suffix = F.regexp_extract(name, SUFFIX, 1)
    stem = F.substring(name, F.lit(1), F.length(name) - F.length(suffix))
    return F.when(
        suffix.isin(*ENCODING_SUFFIXES), F.concat(F.regexp_extract(stem, SUFFIX, 1), suffix)
    ).otherwise(suffix)


def file_record(path: Column, content: Column, size: Column | None = None) -> Column:
    """The reference of a local file: its path as key, its extension and size."""
    size = F.octet_length(content) if size is None else size
    return F.struct(
        path.alias("key"), extension(path).alias("extension"), size.cast("bigint").alias("size")
    )


def image_record(path: Column, content: Column) -> Column:
    """The reference of a local image: a file reference with the height and width."""
    file = file_record(path, content)
    measured = F.transform(
        F.array(image_size(content)),
        lambda size: F.struct(
            *[file.getField(name).alias(name) for name in FILE_FIELDS],
            size.getField("height").alias("height"),
            size.getField("width").alias("width"),
        ),
    )
    return measured[0]


def file_table(files: DataFrame) -> DataFrame:
    """``path, extension, size, checksum`` of files read by :func:`read_files`."""
    return files.select(
        "path",
        extension(F.col("path")).alias("extension"),
        F.col("length").alias("size"),
        F.sha1("content").alias("checksum"),
    )


def image_table(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``path, format, height, width`` of image files."""
    kinds = files.select(
        F.col(path).alias("path"),
        F.col(content).alias("content"),
        image_format(F.col(content)).alias("format"),
    )
    sized = kinds.select("path", "format", image_size(F.col("content"), F.col("format")).alias("size"))
    return sized.select("path", "format", "size.height", "size.width")


def holds_files(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return holds_files(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return is_file(dtype) or any(holds_files(f.dataType) for f in dtype.fields)
    return False


def file_references(df: DataFrame) -> Column:
    """All file references of a row, found through records and arrays at any depth.

    One array of ``struct(path, file)`` per row, so that one scan serves every
    file column of the sheet.
    """
    found = [
        _references(f.dataType, F.col("`" + f.name + "`"), f.name)
        for f in df.schema.fields
        if holds_files(f.dataType)
    ]
    return _joined(found)


def _joined(arrays: list[Column]) -> Column:
    empty = F.array().cast(REFERENCE)
    return F.concat(*[F.coalesce(a, empty) for a in arrays]) if arrays else empty


def _references(dtype: T.DataType, column: Column, path: str) -> Column:
    if isinstance(dtype, T.ArrayType):
        item = dtype.elementType
        return F.flatten(F.transform(column, _per_item(item, path)))
    if is_file(dtype):
        file = F.struct(*[column.getField(n).alias(n) for n in FILE_FIELDS])
        one = F.struct(F.lit(path).alias("path"), file.alias("file"))
        return F.when(column.isNotNull(), F.array(one).cast(REFERENCE))
    found = [
        _references(f.dataType, column.getField(f.name), f"{path}.{f.name}")
        for f in dtype.fields
        if holds_files(f.dataType)
    ]
    return _joined(found)


def _per_item(item: T.DataType, path: str) -> Callable[[Column], Column]:
    return lambda element: _joined([_references(item, element, path)])


def map_files(df: DataFrame, new_key: Callable[[Column], Column]) -> DataFrame:
    """Give every file reference, at any depth, the key that ``new_key(file)`` computes."""

    def mapped(dtype: T.DataType, column: Column) -> Column:
        if is_file(dtype):
            return column.withField("key", new_key(column))
        if isinstance(dtype, T.ArrayType):
            return F.transform(column, lambda item: mapped(dtype.elementType, item))
        for f in dtype.fields:
            if holds_files(f.dataType):
                column = column.withField(f.name, mapped(f.dataType, column.getField(f.name)))
        return column

    changed = {
        f.name: mapped(f.dataType, F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if holds_files(f.dataType)
    }
    for name, column in changed.items():
        df = df.withColumn(name, column).withMetadata(name, df.schema[name].metadata)
    return df


def extract_files(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per file reference: ``keep..., path, key, extension, size``."""
    rows = df.select(*keep, F.explode_outer(file_references(df)).alias("__reference"))
    rows = rows.where(F.col("__reference").isNotNull())
    return rows.select(*keep, "__reference.path", "__reference.file.*")
