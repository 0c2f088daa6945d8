"""Ordered, paged and positional reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators import order
from sheetspark.plans.inputs import profiles, table
from sheetspark.plans.registry import query

BY_PRICE = ["o_totalprice", "o_orderkey"]
SHOWN = ["o_orderkey", "o_totalprice", "o_orderstatus"]

RANKED = """ranked AS (
  SELECT o_orderkey, o_totalprice, o_orderstatus, count(*) OVER () AS n,
    row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders)"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(SHOWN)


@query(
    """SELECT c_custkey, c_nationkey AS nation, c_mktsegment AS segment,
         row_number() OVER (ORDER BY c_mktsegment, c_nationkey, c_custkey) - 1 AS pos
       FROM customer"""
)
def order_by_multi(spark: SparkSession, folder: str) -> DataFrame:
    ordered = order.order_by(
        profiles(spark, folder),
        "profile.market.c_mktsegment|profile.market.c_nationkey",
        key="c_custkey",
    )
    return order.numbered(
        ordered.select(
            "c_custkey",
            F.col("profile.market.c_nationkey").alias("nation"),
            F.col("profile.market.c_mktsegment").alias("segment"),
        )
    )


@query(
    """SELECT o_orderkey, o_totalprice, o_orderstatus, row_number() OVER
         (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) - 1 AS pos FROM orders"""
)
def sort_desc(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(
        order.sort(_orders(spark, folder), "o_orderstatus,-o_totalprice", key="o_orderkey")
    )


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, pos - 384 AS pos FROM ranked
    WHERE pos >= 384 AND pos < 512"""
)
def page(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(
        order.page(
            _orders(spark, folder),
            "o_orderkey",
            order_by="o_totalprice",
            offset=384,
            limit=128,
            columns="o_orderkey|o_totalprice",
        )
    )


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos - 10500 AS pos FROM ranked
    WHERE pos >= 10500 AND pos < 12500"""
)
def deep_page(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(
        order.page(
            _orders(spark, folder), "o_orderkey", order_by="o_totalprice", offset=10500, limit=2000
        )
    )


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos FROM ranked
    WHERE pos < 100"""
)
def head(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(order.head(_orders(spark, folder), BY_PRICE, 100))


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos FROM ranked
    WHERE pos < 10500"""
)
def head_large(spark: SparkSession, folder: str) -> DataFrame:
    """More rows than are kept in memory as a top-k."""
    return order.numbered(order.head(_orders(spark, folder), BY_PRICE, 10_500))


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos FROM ranked
    WHERE pos < n - 300"""
)
def head_negative(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(order.head(_orders(spark, folder), BY_PRICE, -300))


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos - n + 100 AS pos
    FROM ranked WHERE pos >= n - 100"""
)
def tail(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(order.tail(_orders(spark, folder), BY_PRICE, 100))


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos - 300 AS pos FROM ranked
    WHERE pos >= 300"""
)
def tail_negative(spark: SparkSession, folder: str) -> DataFrame:
    return order.numbered(order.tail(_orders(spark, folder), BY_PRICE, -300))


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos FROM ranked
    WHERE pos = n - 777"""
)
def row_at(spark: SparkSession, folder: str) -> DataFrame:
    return order.row_at(_orders(spark, folder), BY_PRICE, -777)


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos FROM ranked
    WHERE pos >= 100 AND pos < n - 100 AND (pos - 100) % 3 = 0"""
)
def slice_step(spark: SparkSession, folder: str) -> DataFrame:
    return order.slice_rows(_orders(spark, folder), BY_PRICE, 100, -100, 3)


@query(
    f"""WITH {RANKED} SELECT o_orderkey, o_totalprice, o_orderstatus, pos FROM ranked
    WHERE pos <= n - 10 AND pos > 50 AND (n - 10 - pos) % 7 = 0"""
)
def slice_negative_step(spark: SparkSession, folder: str) -> DataFrame:
    return order.slice_rows(_orders(spark, folder), BY_PRICE, -10, 50, -7)


@query(f"WITH {RANKED} SELECT pos, o_orderstatus FROM ranked WHERE pos >= 200 AND pos < 1200")
def cell_slice(spark: SparkSession, folder: str) -> DataFrame:
    return order.cells(
        table(spark, folder, "orders"), BY_PRICE, ["o_orderstatus"], 200, 1200
    )


@query("SELECT o_orderkey, o_orderdate FROM orders")
def row_subset(spark: SparkSession, folder: str) -> DataFrame:
    return order.subset(table(spark, folder, "orders"), ["o_orderkey", "o_orderdate"])
