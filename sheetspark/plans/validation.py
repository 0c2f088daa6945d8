"""Checks that give violations as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.operators import checks
from sheetspark.plans.inputs import (
    CHARGE,
    INVOICES_SQL,
    PRIORITIES,
    TEXTS_SQL,
    invoices,
    orders,
    table,
    texts,
    with_enum,
)
from sheetspark.plans.registry import query
from sheetspark.schema import enum, field


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def bad_enum(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose priority is not among the three that are declared here."""
    df = with_enum(table(spark, folder, "orders"), "o_orderpriority", PRIORITIES[1:4])
    return checks.bad_enums(df, "o_orderpriority").select("o_orderkey", "o_orderpriority")


@query(
    f"""WITH {INVOICES_SQL} SELECT l_orderkey, l_linenumber, l_tax FROM invoices
    WHERE len(list_filter(charges, lambda c: c.kind NOT IN ('net', 'discount'))) > 0"""
)
def bad_nested_enum(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with a charge of a kind that is not among the two declared here."""
    df = invoices(spark, folder)
    charge = T.StructType(
        [field("kind", enum(["net", "discount"])) if f.name == "kind" else f for f in CHARGE.fields]
    )
    redeclared = df.withColumn("charges", F.col("charges").cast(T.ArrayType(charge)))
    return checks.bad_enums(redeclared, "charges").select("l_orderkey", "l_linenumber", "l_tax")


@query(
    f"""WITH {TEXTS_SQL} SELECT doc_id, len(lines) AS n_lines FROM texts WHERE len(lines) <> 4"""
)
def bad_length(spark: SparkSession, folder: str) -> DataFrame:
    bad = checks.bad_lengths(texts(spark, folder), "lines", 4)
    return bad.select("doc_id", F.array_size("lines").cast("bigint").alias("n_lines"))


@query(
    """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
         CASE WHEN l.doc_id IS NULL THEN 'no value' ELSE 'no row' END AS problem
       FROM (SELECT doc_id FROM documents WHERE lang <> 'de') d
       FULL JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL"""
)
def unmatched_values(spark: SparkSession, folder: str) -> DataFrame:
    """A new column must have a value for every row and a row for every value."""
    rows = table(spark, folder, "documents").where(F.col("lang") != "de")
    return checks.unmatched_keys(rows, table(spark, folder, "labels"), "doc_id")


@query(
    """SELECT 'priority' AS "check", count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH',
         '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS violations FROM orders
       UNION ALL SELECT 'price', count(*) FILTER (o_totalprice > 400000) FROM orders
       UNION ALL SELECT 'words', count(*) FILTER (len(string_split(o_orderpriority, '-')) <> 2) FROM orders"""
)
def violation_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Several conditions over a sheet, counted in one pass."""
    df = orders(spark, folder).withColumn("words", F.split("o_orderpriority", "-"))
    return checks.violation_counts(
        df,
        {
            "priority": checks.enum_violation(df, "o_orderpriority"),
            "price": F.col("o_totalprice") > 400000,
            "words": checks.length_violation("words", 2),
        },
    )
