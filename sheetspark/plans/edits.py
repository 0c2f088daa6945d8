"""Keyed and positional edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators import edit, labels
from sheetspark.operators.order import Positions
from sheetspark.operators.query import query as where
from sheetspark.plans.inputs import table
from sheetspark.plans.registry import query
from sheetspark.runtime import fresh_path
from sheetspark.sources import keys

BY_PRICE = ["o_totalprice", "o_orderkey"]
SHOWN = ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"]

RANKED = """ranked AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority, count(*) OVER () AS n,
    row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders)"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(SHOWN)


@query(
    """WITH base AS (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS record_key
                     FROM orders WHERE o_orderstatus <> 'P'),
       batch AS (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos
                 FROM orders WHERE o_orderstatus = 'P')
       SELECT record_key, o_orderkey, o_totalprice FROM base
       UNION ALL
       SELECT lpad(CAST(pos + 1 + (SELECT max(CAST(record_key AS BIGINT)) FROM base) AS VARCHAR), 20, '0'),
         o_orderkey, o_totalprice FROM batch"""
)
def append_keys(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders")
    shown = ["o_orderkey", "o_totalprice"]
    batch = where(df, lambda x: x["o_orderstatus"] == "P").select(shown)
    base = where(df, lambda x: x["o_orderstatus"] != "P").select(
        edit.record_key(F.col("o_orderkey")).alias("record_key"), *shown
    )
    return edit.append(base, batch, BY_PRICE, key="record_key")


@query(
    """WITH parts AS (SELECT *, CASE o_orderstatus WHEN 'P' THEN 0 ELSE 1 END AS turn FROM orders
                      WHERE o_orderstatus <> 'O')
       SELECT lpad(CAST(row_number() OVER (ORDER BY turn, o_totalprice, o_orderkey) - 1 AS VARCHAR), 20, '0')
         AS record_key, o_orderkey, o_totalprice FROM parts"""
)
def leased_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches appended one after the other under leased keys; the sheet is not searched for its last."""
    df, root = table(spark, folder, "orders"), fresh_path(spark, "keys")
    shown = ["o_orderkey", "o_totalprice"]
    first = df.where(F.col("o_orderstatus") == "P").select(shown)
    second = df.where(F.col("o_orderstatus") == "F").select(shown)
    sheet = first.limit(0).withColumn("record_key", F.lit("")).select("record_key", *shown)
    sheet = keys.append_leased(sheet, first, BY_PRICE, root, key="record_key")
    return keys.append_leased(sheet, second, BY_PRICE, root, key="record_key")


@query(
    f"""WITH {RANKED},
    batch AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS i
              FROM customer)
    SELECT o_orderkey, coalesce(c_acctbal, o_totalprice) AS o_totalprice,
      CASE WHEN c_custkey IS NULL THEN o_orderstatus ELSE 'N' END AS o_orderstatus,
      CASE WHEN c_custkey IS NULL THEN o_orderpriority END AS o_orderpriority
    FROM ranked LEFT JOIN batch ON pos >= 300 AND (pos - 300) % 2 = 0 AND i = (pos - 300) // 2"""
)
def replace_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``iloc[300 : 300 + 2 * n : 2] = rows``, n rows; they leave the priority empty."""
    customers = table(spark, folder, "customer")
    rows = customers.select(
        "c_custkey",
        F.col("c_acctbal").alias("o_totalprice"),
        F.lit("N").alias("o_orderstatus"),
        F.lit(None).cast("string").alias("o_orderpriority"),
    )
    return edit.replace_slice(
        _orders(spark, folder),
        BY_PRICE,
        "o_orderkey",
        rows,
        ["o_totalprice", "c_custkey"],
        300,
        300 + 2 * customers.count(),
        2,
    )


@query(
    f"""WITH {RANKED},
    batch AS (SELECT c_custkey, c_acctbal,
                row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS i FROM customer),
    spliced AS (
      SELECT pos, o_orderkey, o_totalprice, o_orderstatus FROM ranked WHERE pos < 300
      UNION ALL
      SELECT 300 + i, c_custkey, c_acctbal, NULL FROM batch
      UNION ALL
      SELECT pos - 10 + (SELECT count(*) FROM batch), o_orderkey, o_totalprice, o_orderstatus
      FROM ranked WHERE pos >= 310)
    SELECT * FROM spliced"""
)
def splice_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``sheet[300:310] = rows`` with another number of rows, in a stored sheet with labels.

    Labels are so close that the rows around have to be spread anew.
    """
    shown = _orders(spark, folder).select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = fresh_path(spark, "labelled")
    labels.labelled(shown, BY_PRICE, spacing=16).write.parquet(path)
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_orderkey"), F.col("c_acctbal").alias("o_totalprice")
    )
    sheet = labels.splice(spark.read.parquet(path), rows, BY_PRICE, 300, 310)
    positions = Positions(sheet, labels.LABEL)
    return positions.rows(0, positions.count).drop(labels.LABEL)


@query(
    f"""WITH {RANKED},
    batch AS (SELECT p_name, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
    SELECT o_orderkey, o_totalprice, o_orderstatus, coalesce(p_name, o_orderpriority) AS o_orderpriority
    FROM ranked LEFT JOIN batch ON i = n - 1 - pos"""
)
def set_cells(spark: SparkSession, folder: str) -> DataFrame:
    """``df["o_orderpriority"][: -1 - n : -1] = values``, n values from the last row backwards."""
    parts = table(spark, folder, "part")
    values = parts.select("p_partkey", F.col("p_name").alias("o_orderpriority"))
    return edit.replace_slice(
        _orders(spark, folder),
        BY_PRICE,
        "o_orderkey",
        values,
        "p_partkey",
        None,
        -1 - parts.count(),
        -1,
    )


@query(
    """SELECT event_id, user_id,
         CASE WHEN event_type IN ('click', 'purchase') THEN value * 2 ELSE value END AS value,
         CASE WHEN event_type = 'purchase' THEN NULL ELSE props END AS props
       FROM events"""
)
def update_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks get a new value; purchases also have their props set to an explicit null."""
    events = table(spark, folder, "events")
    updates = where(
        events, lambda x: (x["event_type"] == "click") | (x["event_type"] == "purchase")
    ).select(
        "event_id",
        (F.col("value") * 2).alias("value"),
        F.lit(None).cast("string").alias("props"),
        F.when(F.col("event_type") == "purchase", F.array(F.lit("value"), F.lit("props")))
        .otherwise(F.array(F.lit("value")))
        .alias("set"),
    )
    return edit.update_by_key(
        events.select("event_id", "user_id", "value", "props"), updates, "event_id"
    )


@query(
    """SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)"""
)
def delete_by_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = where(table(spark, folder, "lineitem"), lambda x: x["l_quantity"] > 45)
    keys = lines.select(F.col("l_orderkey").alias("o_orderkey"))
    return edit.delete_by_key(_orders(spark, folder), keys, "o_orderkey")


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM ranked
    WHERE NOT (pos >= 100 AND pos < n - 500 AND (pos - 100) % 2 = 0)"""
)
def delete_slice(spark: SparkSession, folder: str) -> DataFrame:
    return edit.delete_slice(
        _orders(spark, folder), BY_PRICE, "o_orderkey", 100, -500, 2
    )


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM ranked
    WHERE pos < 100 OR pos >= n - 500"""
)
def delete_rows(spark: SparkSession, folder: str) -> DataFrame:
    return edit.delete_slice(_orders(spark, folder), BY_PRICE, "o_orderkey", 100, -500)


@query(
    """WITH last AS (
      SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id
      FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id),
    priced AS (SELECT user_id, arg_max(value, event_id) AS value FROM events
      WHERE event_type = 'click' GROUP BY user_id)
    SELECT c_custkey, coalesce(p.value, c_acctbal) AS c_acctbal,
      coalesce(l.event_type, c_mktsegment) AS c_mktsegment
    FROM customer LEFT JOIN last l ON l.user_id = c_custkey LEFT JOIN priced p ON p.user_id = c_custkey"""
)
def update_in_order(spark: SparkSession, folder: str) -> DataFrame:
    """Many updates of a key, in the order of the events; a view does not supply the balance."""
    events = where(
        table(spark, folder, "events"),
        lambda x: (x["event_type"] == "click") | (x["event_type"] == "view"),
    )
    balance, segment = F.lit("c_acctbal"), F.lit("c_mktsegment")
    updates = events.select(
        F.col("user_id").alias("c_custkey"),
        "event_id",
        F.col("value").alias("c_acctbal"),
        F.col("event_type").alias("c_mktsegment"),
        F.when(F.col("event_type") == "click", F.array(balance, segment))
        .otherwise(F.array(segment))
        .alias("set"),
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return edit.update_by_key(customers, updates, "c_custkey", seq="event_id")


@query(
    """SELECT d.doc_id, d.n_chars, CAST(l.toxic AS BIGINT) AS toxic
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def schema_backfill(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    return edit.backfill_column(df, "toxic", "int64", labels, "doc_id")
