"""Row filters, scalar arithmetic, computed columns and saved searches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators import columns, measures
from sheetspark.operators.query import apply, search, select
from sheetspark.operators.query import query as where
from sheetspark.plans.inputs import INVOICES_SQL, invoices, orders, profiles, table
from sheetspark.plans.registry import query


@query(
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'"""
)
def filter_eq_ne(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "orders")
    kept = where(df, lambda x: (x["o_orderstatus"] == "F") & (x["o_orderpriority"] != "5-LOW"))
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem
       WHERE l_quantity >= 10 AND l_quantity <= 20 AND l_discount < 0.05 AND l_tax > 0
         AND l_extendedprice > l_quantity * 2000"""
)
def filter_range(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        table(spark, folder, "lineitem"),
        lambda x: (x["l_quantity"] >= 10)
        & (x["l_quantity"] <= 20)
        & (x["l_discount"] < 0.05)
        & (x["l_tax"] > 0)
        & (x["l_extendedprice"] > x["l_quantity"] * 2000),
    )
    return kept.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity FROM lineitem
       WHERE (l_returnflag = 'R' AND l_linestatus = 'O') OR NOT (l_quantity < 45)"""
)
def filter_logic(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        table(spark, folder, "lineitem"),
        lambda x: ((x["l_returnflag"] == "R") & (x["l_linestatus"] == "O"))
        | ~(x["l_quantity"] < 45),
    )
    return kept.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")


@query(
    """SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
       WHERE o_totalprice > 250000 AND o_orderstatus = 'O' AND o_custkey < 700"""
)
def filter_chained(spark: SparkSession, folder: str) -> DataFrame:
    df = where(table(spark, folder, "orders"), lambda x: x["o_totalprice"] > 250000)
    df = where(df, lambda x: x["o_orderstatus"] == "O")
    df = where(df, lambda x: x["o_custkey"] < 700)
    return df.select("o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderpriority = '2-HIGH' OR o_orderpriority = '5-LOW'"""
)
def filter_enum(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        orders(spark, folder),
        lambda x: (x["o_orderpriority"] == "2-HIGH") | (x["o_orderpriority"] == "5-LOW"),
    )
    return kept.select("o_orderkey", "o_orderpriority")


@query(
    """SELECT event_id, ts, event_type FROM events
       WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20 12:30:00.5'
         AND ts <> TIMESTAMP '2024-01-06'"""
)
def filter_temporal(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        table(spark, folder, "events"),
        lambda x: (x["ts"] >= dt.date(2024, 1, 5))
        & (x["ts"] < dt.datetime(2024, 1, 20, 12, 30, 0, 500_000))
        & (x["ts"] != dt.datetime(2024, 1, 6, tzinfo=dt.timezone.utc)),
    )
    return kept.select("event_id", "ts", "event_type")


@query(
    """SELECT l_orderkey, l_linenumber, o_day, waiting FROM (
         SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS o_day,
                epoch_us(l_shipdate - TIMESTAMP '1998-01-01') AS waiting FROM lineitem)
       WHERE o_day >= DATE '1997-06-01' AND waiting < 864000000000"""
)
def filter_date_timedelta(spark: SparkSession, folder: str) -> DataFrame:
    start = F.lit("1998-01-01").cast("timestamp_ntz")
    df = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("o_day"),
        (F.col("l_shipdate") - start).alias("waiting"),
    )
    kept = where(
        df,
        lambda x: (x["o_day"] >= dt.date(1997, 6, 1)) & (x["waiting"] < dt.timedelta(days=10)),
    )
    return columns.as_integers(kept, "waiting")


@query(
    """SELECT l_orderkey, l_linenumber, shipped, returned FROM (
         SELECT l_orderkey, l_linenumber, l_linestatus = 'F' AS shipped,
                l_returnflag = 'R' AS returned FROM lineitem)
       WHERE shipped AND returned = FALSE"""
)
def filter_bool(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_linestatus") == "F").alias("shipped"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    return where(df, lambda x: x["shipped"] & (x["returned"] == False))  # noqa: E712


@query(
    """SELECT c_custkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       WHERE c_acctbal > 1000 AND c_mktsegment = 'BUILDING' AND c_nationkey <> 3"""
)
def filter_nested(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        profiles(spark, folder),
        lambda x: (x["profile"]["balance"] > 1000)
        & (x["profile"]["market"]["c_mktsegment"] == "BUILDING")
        & (x["profile"]["market"]["c_nationkey"] != 3),
    )
    return kept.select(
        "c_custkey",
        F.col("profile.balance").alias("balance"),
        F.col("profile.market.c_mktsegment").alias("segment"),
    )


@query(
    """SELECT p_partkey, p_size + 5 AS size_plus, p_retailprice - p_size AS price_minus,
         p_size * 3 AS size_times, p_partkey - p_size AS key_minus, 100 - p_size AS rest
       FROM (SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part)"""
)
def arith_add_sub_mul(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        table(spark, folder, "part"),
        [
            "p_partkey",
            {
                "size_plus": lambda x: x["p_size"] + 5,
                "price_minus": lambda x: x["p_retailprice"] - x["p_size"],
                "size_times": lambda x: x["p_size"] * 3,
                "key_minus": lambda x: x["p_partkey"] - x["p_size"],
                "rest": lambda x: 100 - x["p_size"],
            },
        ],
    )


@query(
    """SELECT o_orderkey, (o_orderkey - 7000) % 11 AS by_number,
         CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_orderkey % (o_custkey % 3) END AS by_column
       FROM orders"""
)
def arith_mod(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        table(spark, folder, "orders"),
        [
            "o_orderkey",
            {
                "by_number": lambda x: (x["o_orderkey"] - 7000) % 11,
                "by_column": lambda x: x["o_orderkey"] % (x["o_custkey"] % 3),
            },
        ],
    )


@query(
    """SELECT p_partkey, CAST(pow(p_size, 3) AS BIGINT) AS cubed, pow(p_size, 2.0) AS squared,
         CAST(list_reduce([CAST(p_size + 100 AS HUGEINT) FOR i IN range(8)],
           lambda a, b: a * b) AS BIGINT) AS eighth,
         CAST(CASE WHEN p_size % 40 = 0 THEN 1
           ELSE list_reduce([CAST(3 AS HUGEINT) FOR i IN range(p_size % 40)],
             lambda a, b: a * b) END AS BIGINT) AS by_column
       FROM part"""
)
def arith_pow(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        table(spark, folder, "part"),
        [
            "p_partkey",
            {
                "cubed": lambda x: x["p_size"] ** 3,
                "squared": lambda x: x["p_size"] ** 2.0,
                "eighth": lambda x: (x["p_size"] + 100) ** 8,
                "by_column": lambda x: (x["p_size"] * 0 + 3) ** (x["p_size"] % 40),
            },
        ],
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price,
         CASE WHEN l_discount = 0 THEN NULL ELSE l_extendedprice / l_discount END AS per_discount,
         CAST(l_orderkey AS DOUBLE) / l_linenumber AS whole
       FROM lineitem"""
)
def arith_div(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        table(spark, folder, "lineitem"),
        [
            "l_orderkey",
            "l_linenumber",
            {
                "unit_price": lambda x: x["l_extendedprice"] / x["l_quantity"],
                "per_discount": lambda x: x["l_extendedprice"] / x["l_discount"],
                "whole": lambda x: x["l_orderkey"] / x["l_linenumber"],
            },
        ],
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS apply_result
       FROM lineitem"""
)
def apply_column(spark: SparkSession, folder: str) -> DataFrame:
    return apply(
        table(spark, folder, "lineitem"),
        lambda x: x["l_extendedprice"] * (1 - x["l_discount"]),
        keep=["l_orderkey", "l_linenumber"],
    )


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber,
      CAST(len(list_filter(charges, lambda c: c.kind = 'tax')) AS BIGINT) AS apply_result
    FROM invoices WHERE len(list_filter(charges, lambda c: c.kind = 'tax')) > 0"""
)
def query_apply(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(invoices(spark, folder), lambda x: (x["charges"]["kind"] == "tax").any())
    return apply(
        kept,
        lambda x: x["charges"].query(lambda c: c["kind"] == "tax").size(),
        keep=["l_orderkey", "l_linenumber"],
    )


SEARCH = {
    "where": {
        "$and": [
            {"$any_match": ["$.charges", {"$eq": ["$.kind", 1]}]},
            {"$gt": [{"$sum": ["$.charges.amount"]}, 50000]},
        ]
    },
    "select": [
        "$.l_orderkey",
        "$.l_linenumber",
        {"money.gross": {"$mult": ["$.l_extendedprice", {"$add": ["$.l_tax", 1]}]}},
        {"money.charged": {"$sum": ["$.charges.amount"]}},
        {"n_charges": {"$size": ["$.charges"]}},
        {"n_large": {"$size": [{"$filter": ["$.charges", {"$gte": ["$.amount", 1000]}]}]}},
    ],
}


@query(
    f"""WITH {INVOICES_SQL},
    summed AS (SELECT *, coalesce(list_sum(list_transform(charges, lambda c: c.amount)), 0) AS charged
               FROM invoices WHERE len(list_filter(charges, lambda c: c.kind = 'discount')) > 0)
    SELECT l_orderkey, l_linenumber, l_extendedprice * (l_tax + 1) AS money_gross,
      charged AS money_charged, len(charges) AS n_charges,
      len(list_filter(charges, lambda c: c.amount >= 1000)) AS n_large
    FROM summed WHERE charged > 50000"""
)
def saved_search(spark: SparkSession, folder: str) -> DataFrame:
    return columns.flatten(search(invoices(spark, folder), SEARCH))


@query(
    f"""WITH {INVOICES_SQL}
    SELECT count(*) AS record_count FROM invoices
    WHERE len(list_filter(charges, lambda c: c.kind = 'discount')) > 0
      AND coalesce(list_sum(list_transform(charges, lambda c: c.amount)), 0) > 50000"""
)
def search_count(spark: SparkSession, folder: str) -> DataFrame:
    return measures.row_count(search(invoices(spark, folder), SEARCH))
