"""Element-wise predicates, arithmetic and reductions over the arrays of a row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from sheetspark.operators.columns import explode_items
from sheetspark.operators.query import apply, select
from sheetspark.operators.query import query as where
from sheetspark.plans.inputs import INVOICES_SQL, TEXTS_SQL, invoices, table, texts
from sheetspark.plans.registry import query

LINE = ["l_orderkey", "l_linenumber", "l_extendedprice"]


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM invoices
    WHERE len(list_filter(charges, lambda c: c.kind = 'discount')) > 0"""
)
def any_match(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(invoices(spark, folder), lambda x: (x["charges"]["kind"] == "discount").any())
    return kept.select(LINE)


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM invoices
    WHERE len(list_filter(charges, lambda c: c.amount > 1000)) = len(charges)"""
)
def all_match(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(invoices(spark, folder), lambda x: (x["charges"]["amount"] > 1000).all())
    return kept.select(LINE)


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice, c.kind AS kind, c.amount AS amount, c.due AS due
    FROM (SELECT *, unnest(list_filter(charges, lambda c: c.amount > 2000 AND c.kind <> 'net')) AS c
          FROM invoices)"""
)
def array_filter_records(spark: SparkSession, folder: str) -> DataFrame:
    kept = apply(
        invoices(spark, folder),
        lambda x: x["charges"].query(lambda c: (c["amount"] > 2000) & (c["kind"] != "net")),
        keep=LINE,
    )
    items = explode_items(kept, "apply_result", LINE)
    return items.select(*LINE, "kind", "amount", "due")


@query(
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, kept[i] AS item FROM (
         SELECT *, unnest(range(1, len(kept) + 1)) AS i FROM (
           SELECT vec_id, list_filter(embedding, lambda v: v > 0.1 OR v < -0.2) AS kept
           FROM embeddings))"""
)
def array_filter_scalars(spark: SparkSession, folder: str) -> DataFrame:
    kept = apply(
        table(spark, folder, "embeddings"),
        lambda x: x["embedding"].query(lambda v: (v > 0.1) | (v < -0.2)),
        keep=["vec_id"],
    )
    return explode_items(kept, "apply_result", ["vec_id"])


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice, len(charges) AS apply_result FROM invoices"""
)
def array_size(spark: SparkSession, folder: str) -> DataFrame:
    return apply(invoices(spark, folder), lambda x: x["charges"].size(), keep=LINE)


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice,
      list_max(list_transform(charges, lambda c: c.amount)) AS top_amount,
      list_max(list_transform(charges, lambda c: c.rate)) AS top_rate FROM invoices"""
)
def array_max(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        invoices(spark, folder),
        [
            *LINE,
            {
                "top_amount": lambda x: x["charges"]["amount"].max(),
                "top_rate": lambda x: x["charges"]["rate"].max(),
            },
        ],
    )


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice,
      list_min(list_transform(charges, lambda c: c.amount)) AS low_amount,
      list_min(list_transform(charges, lambda c: c.due)) AS first_due FROM invoices"""
)
def array_min(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        invoices(spark, folder),
        [
            *LINE,
            {
                "low_amount": lambda x: x["charges"]["amount"].min(),
                "first_due": lambda x: x["charges"]["due"].min(),
            },
        ],
    )


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice,
      CASE WHEN charges IS NOT NULL THEN
        coalesce(list_sum(list_transform(charges, lambda c: c.amount)), 0) END AS sum_amount,
      CASE WHEN charges IS NOT NULL THEN
        coalesce(list_sum(list_transform(charges, lambda c: c.rate)), 0) END AS sum_rate
    FROM invoices"""
)
def array_sum(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        invoices(spark, folder),
        [
            *LINE,
            {
                "sum_amount": lambda x: x["charges"]["amount"].sum(),
                "sum_rate": lambda x: x["charges"]["rate"].sum(),
            },
        ],
    )


@query(
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, embedding[i] >= 0 AS item
       FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""
)
def elem_compare(spark: SparkSession, folder: str) -> DataFrame:
    compared = apply(
        table(spark, folder, "embeddings"), lambda x: x["embedding"] >= 0, keep=["vec_id"]
    )
    return explode_items(compared, "apply_result", ["vec_id"])


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(i - 1 AS INTEGER) AS pos,
      (charges[i].amount * 2 + 1) / nullif(charges[i].rate, 0) - charges[i].amount % 7 AS item
    FROM (SELECT *, unnest(range(1, len(charges) + 1)) AS i FROM invoices)"""
)
def elem_arith(spark: SparkSession, folder: str) -> DataFrame:
    computed = apply(
        invoices(spark, folder),
        lambda x: (x["charges"]["amount"] * 2 + 1) / x["charges"]["rate"]
        - x["charges"]["amount"] % 7,
        keep=LINE,
    )
    return explode_items(computed, "apply_result", LINE)


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice,
      CASE WHEN charges IS NOT NULL THEN
        len(list_filter(charges, lambda c: c.amount > 3000 AND c.kind = 'tax')) > 0 END AS same_element,
      CASE WHEN charges IS NOT NULL THEN
        len(list_filter(charges, lambda c: c.amount > 3000)) > 0
        AND len(list_filter(charges, lambda c: c.kind = 'tax')) > 0 END AS any_and_any
    FROM invoices"""
)
def elem_logic_same_element(spark: SparkSession, folder: str) -> DataFrame:
    def same(x):
        return ((x["charges"]["amount"] > 3000) & (x["charges"]["kind"] == "tax")).any()

    def separate(x):
        return (x["charges"]["amount"] > 3000).any() & (x["charges"]["kind"] == "tax").any()

    return select(
        invoices(spark, folder), [*LINE, {"same_element": same, "any_and_any": separate}]
    )


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM invoices
    WHERE len(list_filter(charges, lambda c: c.kind <> 'net')) = len(charges)
      AND len(list_filter(charges, lambda c: c.kind = 'tax')) > 0"""
)
def elem_enum(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        invoices(spark, folder),
        lambda x: (x["charges"]["kind"] != "net").all() & (x["charges"]["kind"] == "tax").any(),
    )
    return kept.select(LINE)


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM invoices
    WHERE len(list_filter(charges, lambda c: c.due >= TIMESTAMP '1997-01-15'
                          AND c.due < TIMESTAMP '1997-03-01')) > 0"""
)
def elem_temporal(spark: SparkSession, folder: str) -> DataFrame:
    kept = where(
        invoices(spark, folder),
        lambda x: (
            (x["charges"]["due"] >= dt.date(1997, 1, 15))
            & (x["charges"]["due"] < dt.datetime(1997, 3, 1))
        ).any(),
    )
    return kept.select(LINE)


@query(
    f"""WITH {TEXTS_SQL}
    SELECT doc_id, len(list_filter(lines, lambda l: l.blank)) > 0 AS some_blank,
      len(list_filter(lines, lambda l: l.blank)) = len(lines) AS all_blank FROM texts"""
)
def bool_array_any(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        texts(spark, folder),
        [
            "doc_id",
            {
                "some_blank": lambda x: x["lines"]["blank"].any(),
                "all_blank": lambda x: x["lines"]["blank"].all(),
            },
        ],
    )


@query(
    f"""WITH {TEXTS_SQL}
    SELECT doc_id,
      len(list_filter(lines, lambda l: len(list_filter(l.words, lambda w: w = 'the')) > 0)) > 0 AS has_word,
      CAST(list_sum(list_transform(lines, lambda l: len(l.words))) AS BIGINT) AS n_words,
      list_max(list_transform(lines, lambda l: len(l.words))) AS longest_line,
      len(list_filter(lines, lambda l: len(l.words) > 8)) AS n_long
    FROM texts"""
)
def nested_array(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        texts(spark, folder),
        [
            "doc_id",
            {
                "has_word": lambda x: x["lines"]["words"].each(lambda w: (w == "the").any()).any(),
                "n_words": lambda x: x["lines"]["words"].each(lambda w: w.size()).sum(),
                "longest_line": lambda x: x["lines"]["words"].each(lambda w: w.size()).max(),
                "n_long": lambda x: x["lines"].query(lambda l: l["words"].size() > 8).size(),
            },
        ],
    )


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice,
      CASE WHEN charges IS NOT NULL THEN coalesce(list_sum(
        list_transform(charges, lambda c: c.amount * c.rate)), 0) END AS weighted,
      list_max(list_transform(charges, lambda c: c.amount - 1000)) AS top_excess,
      CASE WHEN charges IS NOT NULL THEN coalesce(list_sum(
        list_transform(list_filter(charges, lambda c: c.kind <> 'net'), lambda c: c.amount)), 0)
      END AS extras
    FROM invoices"""
)
def computed_array_sum(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        invoices(spark, folder),
        [
            *LINE,
            {
                "weighted": lambda x: (x["charges"]["amount"] * x["charges"]["rate"]).sum(),
                "top_excess": lambda x: (x["charges"]["amount"] - 1000).max(),
                "extras": lambda x: x["charges"]
                .query(lambda c: c["kind"] != "net")["amount"]
                .sum(),
            },
        ],
    )


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM invoices
    WHERE len(list_filter(charges, lambda c: c.amount > l_extendedprice * 0.05 AND c.kind <> 'net')) > 0"""
)
def outer_column_in_predicate(spark: SparkSession, folder: str) -> DataFrame:
    """An element compared with a value of its own row."""
    kept = where(
        invoices(spark, folder),
        lambda x: (
            (x["charges"]["amount"] > x["l_extendedprice"] * 0.05) & (x["charges"]["kind"] != "net")
        ).any(),
    )
    return kept.select(LINE)


@query(
    """SELECT vec_id, len(embedding) AS n, list_max(embedding) AS top, list_min(embedding) AS low,
         len(list_filter(embedding, lambda v: v > 0.3)) > 0 AS some_large
       FROM embeddings"""
)
def numeric_array(spark: SparkSession, folder: str) -> DataFrame:
    return select(
        table(spark, folder, "embeddings"),
        [
            "vec_id",
            {
                "n": lambda x: x["embedding"].size(),
                "top": lambda x: x["embedding"].max(),
                "low": lambda x: x["embedding"].min(),
                "some_large": lambda x: (x["embedding"] > 0.3).any(),
            },
        ],
    )
