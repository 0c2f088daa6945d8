"""Tables of a data folder, and nested sheets derived from them row by row.

The nested sheets are built inside each row, without grouping: collecting the
rows of a key into an array would put a key of any size into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.schema import enum, field

CHARGE_KINDS = ["net", "discount", "tax"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CHARGE = T.StructType(
    [
        T.StructField("kind", T.StringType(), False, field("kind", enum(CHARGE_KINDS)).metadata),
        field("amount", "float64"),
        field("rate", "float64"),
        field("due", T.TimestampNTZType()),
    ]
)
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_enum(df: DataFrame, name: str, values: list[str]) -> DataFrame:
    return df.withMetadata(name, field(name, enum(values)).metadata)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the priority declared as an enum."""
    return with_enum(table(spark, folder, "orders"), "o_orderpriority", PRIORITIES)


def invoices(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with ``charges``, an array of up to three records.

    Returned lines have no net charge, so some arrays are empty; single pieces
    have no charges at all (null); a net charge has no rate (null).
    """
    price, discount, tax = (F.col(f"l_{n}") for n in ("extendedprice", "discount", "tax"))
    ship = F.col("l_shipdate")

    def due(days: int) -> Column:
        return ship + F.make_dt_interval(F.lit(days))

    def charge(kind: str, amount: Column, rate: Column, day: Column) -> Column:
        return F.array(
            F.struct(
                F.lit(kind).alias("kind", metadata=CHARGE["kind"].metadata),
                amount.alias("amount"),
                rate.alias("rate"),
                day.alias("due"),
            )
        )

    none = F.array().cast(T.ArrayType(CHARGE, False))
    no_rate = F.lit(None).cast("double")
    charges = F.concat(
        F.when(F.col("l_returnflag") != "R", charge("net", price, no_rate, ship)).otherwise(none),
        F.when(discount > 0, charge("discount", price * discount, discount, due(30))).otherwise(none),
        F.when(tax > 0, charge("tax", price * (1 - discount) * tax, tax, due(60))).otherwise(none),
    )
    lines = table(spark, folder, "lineitem")
    return lines.withColumn("charges", F.when(F.col("l_quantity") >= 2, charges))


INVOICES_SQL = """
invoices AS (
  SELECT *, CASE WHEN l_quantity >= 2 THEN list_filter([
      CASE WHEN l_returnflag <> 'R' THEN
        {'kind': 'net', 'amount': l_extendedprice, 'rate': NULL::DOUBLE, 'due': l_shipdate} END,
      CASE WHEN l_discount > 0 THEN
        {'kind': 'discount', 'amount': l_extendedprice * l_discount, 'rate': l_discount,
         'due': l_shipdate + INTERVAL 30 DAY} END,
      CASE WHEN l_tax > 0 THEN
        {'kind': 'tax', 'amount': l_extendedprice * (1 - l_discount) * l_tax, 'rate': l_tax,
         'due': l_shipdate + INTERVAL 60 DAY} END
    ], lambda c: c IS NOT NULL) END AS charges
  FROM lineitem)
"""


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with ``lines``, an array of records that hold an array of words."""

    def line(text: Column, index: Column) -> Column:
        return F.struct(
            (index + 1).cast("int").alias("no"),
            F.length(text).alias("n_chars"),
            (text == "").alias("blank"),
            F.filter(F.split(text, " "), lambda word: word != "").alias("words"),
        )

    lines = F.transform(F.split("text", "\n"), line)
    return table(spark, folder, "documents").withColumn("lines", lines).drop("text")


TEXTS_SQL = """
texts AS (
  SELECT doc_id, lang, source, n_chars,
    list_transform(string_split(text, chr(10)), lambda t, i:
      {'no': i, 'n_chars': length(t), 'blank': t = '',
       'words': list_filter(string_split(t, ' '), lambda w: w <> '')}) AS lines
  FROM documents)
"""


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with their attributes in nested records."""
    profile = F.struct(
        F.struct("c_nationkey", "c_mktsegment").alias("market"),
        F.col("c_acctbal").alias("balance"),
    )
    return table(spark, folder, "customer").select("c_custkey", "c_name", profile.alias("profile"))


def documents_as_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files: a path, the bytes, and the record that refers to them."""
    suffix = (
        F.when(F.col("lang") == "en", ".txt")
        .when(F.col("lang") == "de", ".txt.gz")
        .when(F.col("lang") == "fr", ".tar.bz2")
        .otherwise("")
    )
    return table(spark, folder, "documents").select(
        "doc_id",
        "source",
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), suffix).alias("path"),
        F.col("text").cast("binary").alias("content"),
    )


FILES_SQL = """
files AS (
  SELECT doc_id, source, text,
    source || '/' || doc_id || CASE lang WHEN 'en' THEN '.txt' WHEN 'de' THEN '.txt.gz'
      WHEN 'fr' THEN '.tar.bz2' ELSE '' END AS path,
    CASE lang WHEN 'en' THEN '.txt' WHEN 'de' THEN '.txt.gz'
      WHEN 'fr' THEN '.tar.bz2' ELSE '' END AS extension,
    sha1(text) AS digest, strlen(text) AS size
  FROM documents)
"""
