"""File tables, content keys, reference copies and image sizes.

The documents stand in for files; the images are headers written byte by byte
from the numbers of each document, in all the formats that can be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators import files, order
from sheetspark.plans.inputs import FILES_SQL, documents_as_files, table
from sheetspark.plans.registry import query
from sheetspark.runtime import fresh_path
from sheetspark.sources import content
from sheetspark.sources.files import file_record, file_table as as_file_table, image_table
from sheetspark.sources.sheets import read_sheet, write_sheet


@query(f"WITH {FILES_SQL} SELECT path, extension, size, digest AS checksum FROM files")
def file_table(spark: SparkSession, folder: str) -> DataFrame:
    df = documents_as_files(spark, folder)
    return as_file_table(df.withColumn("length", F.octet_length("content").cast("bigint")))


@query(
    f"""WITH {FILES_SQL} SELECT 'store/' || digest AS key, min(path) AS path, count(*) AS n_copies
    FROM files GROUP BY ALL"""
)
def content_keys(spark: SparkSession, folder: str) -> DataFrame:
    keyed = documents_as_files(spark, folder).withColumn(
        "key", files.content_key(F.col("content"), "store/")
    )
    return files.distinct_files(keyed)


# Files of sources 0 to 4 are local, 5 to 9 belong to the target, the rest to other data sets.
DATASET_SQL = """CASE WHEN CAST(substr(source, 4) AS INTEGER) < 5 THEN NULL
  WHEN CAST(substr(source, 4) AS INTEGER) < 10 THEN 'target' ELSE source END"""


def _references(spark: SparkSession, folder: str) -> DataFrame:
    number = F.substring("source", 4, 10).cast("int")
    return documents_as_files(spark, folder).select(
        "doc_id",
        F.when(number < 5, None).when(number < 10, "target").otherwise(F.col("source")).alias("dataset"),
        files.content_key(F.col("content"), "origin/").alias("key"),
    )


@query(
    f"""WITH {FILES_SQL}, refs AS (SELECT doc_id, {DATASET_SQL} AS dataset FROM files)
    SELECT doc_id, CASE WHEN dataset IS NULL THEN 'local' WHEN dataset = 'target' THEN 'same'
      ELSE 'other' END AS place FROM refs"""
)
def classify_refs(spark: SparkSession, folder: str) -> DataFrame:
    df = _references(spark, folder)
    return df.select("doc_id", files.classify(F.col("dataset"), "target").alias("place"))


@query(
    f"""WITH {FILES_SQL}, refs AS (SELECT doc_id, digest, {DATASET_SQL} AS dataset FROM files)
    SELECT doc_id, CASE WHEN dataset IS NULL THEN NULL ELSE 'target' END AS dataset,
      CASE WHEN dataset <> 'target' THEN 'copies/' ELSE 'origin/' END || digest AS key FROM refs"""
)
def copy_refs(spark: SparkSession, folder: str) -> DataFrame:
    df = _references(spark, folder)
    workspace, storage = F.lit("home"), F.lit("s1")
    problem = files.copy_problem(workspace, storage, "home", "s1")
    return files.copy_references(df, "key", "dataset", "target", "copies/", problem)


_PLACES_SQL = """
  SELECT f.doc_id, digest, CASE WHEN f.doc_id % 7 = 0 THEN NULL WHEN lang = 'de' THEN 'away'
    ELSE 'home' END AS workspace, CASE WHEN f.doc_id % 11 = 0 THEN NULL WHEN d.source = 'src5'
    THEN 's2' ELSE 's1' END AS storage
  FROM files f JOIN documents d ON f.doc_id = d.doc_id"""


@query(
    f"""WITH {FILES_SQL}, refs AS ({_PLACES_SQL})
    SELECT doc_id, 'origin/' || digest AS key,
      CASE WHEN workspace IS DISTINCT FROM 'home' THEN 'other workspace'
        WHEN storage IS DISTINCT FROM 's1' THEN 'other storage' END AS problem FROM refs"""
)
def copy_problems(spark: SparkSession, folder: str) -> DataFrame:
    """References of several workspaces and storages, some unknown, with what forbids a copy."""
    df = _references(spark, folder).join(
        table(spark, folder, "documents").select("doc_id", "lang", "source"), "doc_id"
    )
    workspace = F.when(F.col("doc_id") % 7 == 0, None).otherwise(
        F.when(F.col("lang") == "de", "away").otherwise("home")
    )
    storage = F.when(F.col("doc_id") % 11 == 0, None).otherwise(
        F.when(F.col("source") == "src5", "s2").otherwise("s1")
    )
    problem = files.copy_problem(workspace, storage, "home", "s1")
    return df.select("doc_id", "key", problem.alias("problem"))


@query(
    """WITH refs AS (SELECT l_orderkey, l_linenumber, 'origin/' || l_suppkey AS key FROM lineitem)
    SELECT l_orderkey, l_linenumber,
      CASE WHEN s_acctbal > 0 THEN 'copies/' || s_name ELSE key END AS key
    FROM refs LEFT JOIN supplier ON key = 'origin/' || s_suppkey"""
)
def map_refs(spark: SparkSession, folder: str) -> DataFrame:
    """Rewrite references through a table of new keys; some keys are not in it."""
    refs = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.concat(F.lit("origin/"), F.col("l_suppkey").cast("string")).alias("key"),
    )
    mapping = table(spark, folder, "supplier").where(F.col("s_acctbal") > 0).select(
        F.concat(F.lit("origin/"), F.col("s_suppkey").cast("string")).alias("key"),
        F.concat(F.lit("copies/"), F.col("s_name")).alias("new_key"),
    )
    return files.map_references(refs, "key", mapping)


@query(
    f"""WITH {FILES_SQL}, ranked AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM files)
    SELECT doc_id, 'copies/' || regexp_extract(path, '([^/]*)$', 1) AS key, extension, size
    FROM ranked WHERE pos % 2 = 0"""
)
def downsample_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Every second file of a sheet goes to a new sheet of another data set."""
    source = documents_as_files(spark, folder).select(
        "doc_id", file_record(F.col("path"), F.col("content")).alias("file")
    )
    half = order.slice_rows(source, "doc_id", None, None, 2).drop("pos")
    copied = half.withColumn(
        "file", F.col("file").withField("key", files.copied_key(F.col("file.key"), "copies/"))
    )
    root = fresh_path(spark, "sheets")
    write_sheet(copied, root, "half")
    return read_sheet(spark, root, "half").select("doc_id", "file.*")


# The formats written below, in the order of doc_id modulo their number.
FORMATS = (
    "jpeg png png-old gif jpeg2000 bmp bmp-old tiff-le tiff-be ico webp-lossy webp-lossless "
    "webp-extended flif none"
).split()


def _hex(value: Column, length: int) -> Column:
    return F.lpad(F.hex(value.cast("bigint")), 2 * length, "0")


def _swapped(value: Column, length: int) -> Column:
    text = _hex(value, length)
    return F.concat(*[F.substring(text, 2 * i + 1, 2) for i in reversed(range(length))])


def _varint(value: Column) -> Column:
    """Three groups of seven bits, largest first."""
    low = F.lit(127)
    groups = [F.shiftright(value, shift).bitwiseAND(low) for shift in (14, 7, 0)]
    return F.concat(_hex(groups[0] + 128, 1), _hex(groups[1] + 128, 1), _hex(groups[2], 1))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """One image header per document; width and height come from its numbers."""
    width = (F.col("n_chars") % 2000 + 1).cast("bigint")
    height = (F.col("doc_id") % 1500 + 1).cast("bigint")
    filler = F.repeat(F.lit("00"), (F.col("n_chars") % 300).cast("int"))
    segment = F.concat(F.lit("FFE0"), _hex(F.length(filler) / 2 + 2, 2), filler)

    def tiff(number, mark):
        def entry(tag, kind, value, pad):
            return F.concat(number(F.lit(tag), 2), number(F.lit(kind), 2), number(F.lit(1), 4), value, F.lit(pad))

        return F.concat(
            F.lit(mark),
            number(F.lit(8), 4),
            number(F.lit(3), 2),
            entry(254, 4, number(F.lit(0), 4), ""),
            entry(256, 3, number(width, 2), "0000"),
            entry(257, 4, number(height, 4), ""),
        )

    lossless = (width - 1) + F.shiftleft(height - 1, 14)
    riff = F.concat(F.lit("52494646"), F.lit("00000000"), F.lit("57454250"))
    bodies = {
        "jpeg": F.concat(
            F.lit("FFD8"), segment, segment, F.lit("FFC2001108"), _hex(height, 2), _hex(width, 2)
        ),
        "png": F.concat(
            F.lit("89504E470D0A1A0A0000000D49484452"), _hex(width, 4), _hex(height, 4)
        ),
        "png-old": F.concat(F.lit("89504E470D0A1A0A"), _hex(width, 4), _hex(height, 4)),
        "gif": F.concat(F.lit("474946383961"), _swapped(width, 2), _swapped(height, 2)),
        "jpeg2000": F.concat(
            F.lit("0000000C6A5020200D0A870A"),
            F.repeat(F.lit("00"), 36),
            _hex(height, 4),
            _hex(width, 4),
        ),
        # The height is negative: rows are stored from the top.
        "bmp": F.concat(
            F.lit("424D"),
            F.repeat(F.lit("00"), 12),
            _swapped(F.lit(40), 4),
            _swapped(width, 4),
            _swapped(F.lit(1 << 32) - height, 4),
        ),
        "bmp-old": F.concat(
            F.lit("424D"),
            F.repeat(F.lit("00"), 12),
            _swapped(F.lit(12), 4),
            _swapped(width, 2),
            _swapped(height, 2),
            F.repeat(F.lit("00"), 4),
        ),
        "tiff-le": tiff(_swapped, "49492A00"),
        "tiff-be": tiff(_hex, "4D4D002A"),
        "ico": F.concat(F.lit("000001000100"), _hex(width % 256, 1), _hex(height % 256, 1)),
        "webp-lossy": F.concat(
            riff,
            F.lit("56503820"),
            F.repeat(F.lit("00"), 7),
            F.lit("9D012A"),
            _swapped(width, 2),
            _swapped(height, 2),
        ),
        "webp-lossless": F.concat(
            riff, F.lit("5650384C"), F.lit("00000000"), F.lit("2F"), _swapped(lossless, 4)
        ),
        "webp-extended": F.concat(
            riff,
            F.lit("56503858"),
            F.repeat(F.lit("00"), 8),
            _swapped(width - 1, 3),
            _swapped(height - 1, 3),
        ),
        "flif": F.concat(
            F.lit("464C49463331"), _varint(width - 1), _varint(height - 1), F.repeat(F.lit("FF"), 8)
        ),
        "none": _hex(width, 8),
    }
    body = F.lit(None).cast("string")
    for index, name in enumerate(FORMATS):
        body = F.when(F.col("doc_id") % len(FORMATS) == index, bodies[name]).otherwise(body)
    return table(spark, folder, "documents").select(
        F.concat(F.lit("image/"), F.col("doc_id").cast("string")).alias("path"),
        F.unhex(body).alias("content"),
    )


_KIND_SQL = "CASE doc_id % {} {} END".format(
    len(FORMATS),
    " ".join(
        f"WHEN {i} THEN "
        + (
            "NULL"
            if name == "none"
            else "'png-old'"
            if name == "png-old"
            else f"'{name.split('-')[0]}'"
        )
        for i, name in enumerate(FORMATS)
    ),
)


@query(
    f"""WITH sized AS (
      SELECT doc_id, {_KIND_SQL} AS format, CAST(n_chars % 2000 + 1 AS INTEGER) AS w,
        CAST(doc_id % 1500 + 1 AS INTEGER) AS h FROM documents)
    SELECT 'image/' || doc_id AS path, format,
      CASE WHEN format = 'ico' THEN (h + 255) % 256 + 1 WHEN format IS NOT NULL THEN h END AS height,
      CASE WHEN format = 'ico' THEN (w + 255) % 256 + 1 WHEN format IS NOT NULL THEN w END AS width
    FROM sized"""
)
def image_size(spark: SparkSession, folder: str) -> DataFrame:
    return image_table(images(spark, folder))


@query(
    f"""WITH {FILES_SQL} SELECT 'store/' || digest AS key, max(size)::BIGINT AS size,
      any_value(text) AS text, count(*) AS n_references
    FROM files GROUP BY digest"""
)
def content_store(spark: SparkSession, folder: str) -> DataFrame:
    """Files stored in two puts that overlap, read back by the references of all of them."""
    df, root = documents_as_files(spark, folder), fresh_path(spark, "contents")
    content.put_contents(spark, root, df.where(F.col("doc_id") % 3 > 0), "store/")
    content.put_contents(spark, root, df.where(F.col("doc_id") % 3 < 2), "store/")
    references = df.select(files.content_key(F.col("content"), "store/").alias("key"))
    counts = references.groupBy("key").agg(F.count(F.lit(1)).alias("n_references"))
    stored = content.stored_contents(spark, root)
    return stored.join(counts, "key").select(
        "key", "size", F.decode("content", "UTF-8").alias("text"), "n_references"
    )
