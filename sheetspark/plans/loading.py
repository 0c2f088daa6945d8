"""Reading, writing, measuring and appending sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark import schema as schemas
from sheetspark.operators import checks, columns, edit, measures
from sheetspark.operators.query import query as where
from sheetspark.plans.inputs import (
    FILES_SQL,
    INVOICES_SQL,
    SEGMENTS,
    documents_as_files,
    invoices,
    orders,
    table,
)
from sheetspark.plans.registry import query
from sheetspark.runtime import fresh_path
from sheetspark.sources.files import file_record
from sheetspark.sources.load import read_table
from sheetspark.sources.sheets import read_sheet, write_sheet

CUSTOMER = schemas.record(
    c_custkey="int64",
    c_name="string",
    c_nationkey="int32",
    c_acctbal="float64",
    c_mktsegment=schemas.enum(SEGMENTS),
)

ORDERS_JSON = """
{"type": "record", "fields": [
  {"name": "o_orderkey", "type": "int64"},
  {"name": "o_totalprice", "type": "float64"},
  {"name": "o_orderdate", "type": "timestamp"},
  {"name": "o_orderstatus", "type": "enum", "values": ["F", "O", "P"]}
]}
"""


@query("SELECT * FROM customer")
def load_declared(spark: SparkSession, folder: str) -> DataFrame:
    df = read_table(spark, f"{folder}/customer.parquet", CUSTOMER)
    return checks.require_declared(df)


@query(
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name END AS p_name,
         CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS BIGINT) END AS p_size, p_retailprice
       FROM part"""
)
def load_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """JSON records, which leave out what is null, get the fields that any of them has."""
    path = fresh_path(spark, "records")
    even, large = F.col("p_size") % 2 == 0, F.col("p_size") > 25
    table(spark, folder, "part").select(
        "p_partkey",
        F.when(large, F.col("p_name")).alias("p_name"),
        F.when(even, F.col("p_size")).alias("p_size"),
        "p_retailprice",
    ).write.json(path)
    return read_table(spark, path, format="json").select(
        "p_partkey", "p_name", "p_size", "p_retailprice"
    )


@query(
    """SELECT o_orderkey, o_totalprice, o_orderdate, o_orderstatus,
         CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS code
       FROM orders"""
)
def load_schema_file(spark: SparkSession, folder: str) -> DataFrame:
    schema = schemas.from_json(ORDERS_JSON)
    df = read_table(spark, f"{folder}/orders.parquet", schema)
    return columns.with_codes(df, "o_orderstatus", "code")


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, CAST(i - 1 AS INTEGER) AS pos, charges[i].kind AS kind,
      charges[i].amount AS amount
    FROM (SELECT *, unnest(range(1, len(charges) + 1)) AS i FROM invoices)
    WHERE len(list_filter(charges, lambda c: c.kind = 'tax')) > 0"""
)
def write_read_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """A nested sheet is stored, read back and searched by an enum of its elements."""
    root = fresh_path(spark, "sheets")
    sheet = invoices(spark, folder).select("l_orderkey", "l_linenumber", "charges")
    write_sheet(sheet, root, "invoices")
    kept = where(
        read_sheet(spark, root, "invoices"), lambda x: (x["charges"]["kind"] == "tax").any()
    )
    items = columns.explode_items(kept, "charges", ["l_orderkey", "l_linenumber"])
    return items.drop("rate", "due")


@query(
    """SELECT event_type AS sheet, count(*) AS record_count FROM events GROUP BY event_type
       UNION ALL SELECT 'all', count(*) FROM events"""
)
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    whole = measures.row_count(events).withColumn("sheet", F.lit("all"))
    return measures.sheet_counts(events, "event_type").toDF("sheet", "record_count").unionByName(
        whole
    )


@query(
    """SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns, count(*) * 11 AS size
       FROM lineitem"""
)
def shape_size(spark: SparkSession, folder: str) -> DataFrame:
    return measures.shape(table(spark, folder, "lineitem"))


@query(
    f"""WITH {FILES_SQL}
    SELECT count(*) AS data_count, count(CASE WHEN source <> 'src3' THEN 1 END) AS file_count,
      CAST(4 AS BIGINT) AS leaf_columns FROM files"""
)
def leaf_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, files and leaf columns that a write would send; some rows have no file."""
    df = documents_as_files(spark, folder)
    body = file_record(F.col("path"), F.col("content"))
    sheet = df.select("doc_id", F.when(F.col("source") != "src3", body).alias("body"))
    return measures.pending_counts(sheet)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 99000")
def case_insensitive(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        table(spark, folder, "orders"),
        lambda x: (x["O_ORDERSTATUS"] == "O") & (x["o_TotalPrice"] > 99000),
    )
    return kept.select("o_orderkey", "o_orderstatus")


@query(
    """SELECT * FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT * FROM orders WHERE o_totalprice > 100000"""
)
def extend(spark: SparkSession, folder: str) -> DataFrame:
    df = orders(spark, folder)
    first = where(df, lambda x: x["o_orderstatus"] == "F")
    return edit.extend(first, where(df, lambda x: x["o_totalprice"] > 100000))
