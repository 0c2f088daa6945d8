"""Projections and column-level edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.operators import columns
from sheetspark.operators.files import copied_key
from sheetspark.operators.query import apply, select
from sheetspark.plans.inputs import (
    FILES_SQL,
    INVOICES_SQL,
    PRIORITIES,
    documents_as_files,
    invoices,
    orders,
    profiles,
    table,
)
from sheetspark.plans.registry import query
from sheetspark.sources.files import extension, extract_files, map_files


@query(
    """SELECT c_custkey, c_acctbal AS balance, c_mktsegment AS segment FROM customer"""
)
def select_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = profiles(spark, folder)
    return select(
        df,
        [
            "c_custkey",
            {"balance": "profile.balance", "segment": lambda x: x["profile"]["market"]["c_mktsegment"]},
        ],
    )


@query(
    """SELECT o_orderkey, o_orderstatus AS info_status, o_totalprice AS info_money_total,
         o_totalprice * 0.19 AS info_money_vat FROM orders"""
)
def select_named(spark: SparkSession, folder: str) -> DataFrame:
    named = select(
        table(spark, folder, "orders"),
        [
            "o_orderkey",
            {
                "info.status": "o_orderstatus",
                "info.money.total": "o_totalprice",
                "info.money.vat": lambda x: x["o_totalprice"] * 0.19,
            },
        ],
    )
    return columns.flatten(named)


@query(
    """SELECT d.doc_id, d.n_chars * 2 AS doubled, l.quality AS quality
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def add_column(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "documents").select("doc_id", "n_chars")
    df = columns.add_column(df, "doubled", lambda x: x["n_chars"] * 2)
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return columns.attach_column(df, "quality", labels, "doc_id").drop("n_chars")


@query(
    """SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS balance
       FROM customer"""
)
def rename_field(spark: SparkSession, folder: str) -> DataFrame:
    df = columns.rename(profiles(spark, folder), "c_custkey", "id")
    df = columns.rename(df, "profile.market.c_mktsegment", "segment")
    df = columns.rename(df, "profile.market", "place")
    return df.select(
        "id",
        F.col("profile.place.c_nationkey").alias("nation"),
        "profile.place.segment",
        "profile.balance",
    )


@query(
    """SELECT c_custkey, CAST(c_acctbal AS FLOAT) AS balance, CAST(c_nationkey AS BIGINT) AS nation,
         c_name FROM customer"""
)
def retype_field(spark: SparkSession, folder: str) -> DataFrame:
    df = columns.astype(profiles(spark, folder), "profile.balance", "float32")
    df = columns.astype(df, "profile.market.c_nationkey", "int64")
    return df.select(
        "c_custkey",
        "c_name",
        "profile.balance",
        F.col("profile.market.c_nationkey").alias("nation"),
    )


@query(
    """SELECT p_partkey, CAST(NULL AS VARCHAR) AS note, p_size * p_retailprice AS worth, p_name
       FROM part"""
)
def insert_field(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "part")
    df = columns.insert(df, 1, "note", "string")
    df = columns.insert(df, 2, "worth", "float64", F.col("p_size") * F.col("p_retailprice"))
    return df.select(df.columns[:4])


@query("""SELECT c_custkey, c_nationkey AS profile_market_c_nationkey FROM customer""")
def drop_field(spark: SparkSession, folder: str) -> DataFrame:
    df = columns.drop(profiles(spark, folder), "profile.balance")
    df = columns.drop(df, "profile.market.c_mktsegment")
    return columns.flatten(columns.drop(df, 1))


@query(
    """SELECT c_custkey, c_name, c_nationkey AS profile_market_c_nationkey,
         c_mktsegment AS profile_market_c_mktsegment, c_acctbal AS profile_balance FROM customer"""
)
def flatten_record(spark: SparkSession, folder: str) -> DataFrame:
    return columns.flatten(profiles(spark, folder))


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, CAST(i - 1 AS INTEGER) AS pos, charges[i].amount AS item
    FROM (SELECT *, unnest(range(1, len(charges) + 1)) AS i FROM invoices)"""
)
def array_field_values(spark: SparkSession, folder: str) -> DataFrame:
    keep = ["l_orderkey", "l_linenumber"]
    values = apply(invoices(spark, folder), lambda x: x["charges"]["amount"], keep=keep)
    return columns.explode_items(values, "apply_result", keep)


_CODES = " ".join(f"WHEN '{value}' THEN {code}" for code, value in enumerate(PRIORITIES))


@query(
    f"""SELECT o_orderkey, CAST(CASE o_orderpriority {_CODES} END AS INTEGER) AS priority_code,
          o_orderpriority AS decoded FROM orders"""
)
def enum_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = columns.with_codes(orders(spark, folder), "o_orderpriority", "priority_code")
    coded = coded.select("o_orderkey", "priority_code")
    return columns.from_codes(coded, "priority_code", "decoded", PRIORITIES)


@query(
    """SELECT event_id, epoch_us(ts) AS ts, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ts_ms,
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT) AS day,
         epoch_us(ts - TIMESTAMP '2024-01-15') // 1000000 AS since,
         epoch_us(ts + INTERVAL 7900 YEAR) AS late_us,
         CAST(epoch_us(ts + INTERVAL 7900 YEAR) // 1000 AS BIGINT) AS late_ms FROM
         (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15')
       UNION ALL
       SELECT event_id, epoch_us(ts), CAST(epoch_us(ts) // 1000 AS BIGINT),
         CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT),
         CAST(floor(epoch_us(ts - TIMESTAMP '2024-01-15') / 1000000.0) AS BIGINT),
         epoch_us(ts + INTERVAL 7900 YEAR),
         CAST(epoch_us(ts + INTERVAL 7900 YEAR) // 1000 AS BIGINT) FROM events
       WHERE ts < TIMESTAMP '2024-01-15'"""
)
def temporal_to_int(spark: SparkSession, folder: str) -> DataFrame:
    middle = F.lit("2024-01-15").cast("timestamp_ntz")
    late = F.col("ts") + F.make_ym_interval(F.lit(7900), F.lit(0))
    df = table(spark, folder, "events").select(
        "event_id",
        "ts",
        F.col("ts").alias("ts_ms"),
        F.col("ts").cast("date").alias("day"),
        (F.col("ts") - middle).alias("since"),
        late.alias("late_us"),
        late.alias("late_ms"),
    )
    units = {"ts": "us", "ts_ms": "ms", "day": None, "since": "s", "late_us": "us", "late_ms": "ms"}
    for name, unit in units.items():
        df = columns.as_integers(df, name, unit)
    return df


@query(
    f"""WITH {INVOICES_SQL}
    SELECT l_orderkey, l_linenumber, CAST(i - 1 AS INTEGER) AS pos, charges[i].kind AS kind,
      charges[i].amount AS amount, charges[i].rate AS rate, charges[i].due AS due
    FROM (SELECT *, unnest(range(1, len(charges) + 1)) AS i FROM invoices)"""
)
def explode_items(spark: SparkSession, folder: str) -> DataFrame:
    return columns.explode_items(
        invoices(spark, folder), "charges", ["l_orderkey", "l_linenumber"]
    )


@query(
    f"""WITH {FILES_SQL}
    SELECT doc_id, 'body' AS path, 'store/' || digest AS key, extension, size FROM files
    UNION ALL
    SELECT doc_id, 'extra.previews', 'thumb/' || path, '.png', doc_id FROM files
    UNION ALL
    SELECT doc_id, 'extra.previews', 'large/' || path, '.png', size FROM files WHERE size > 1000"""
)
def file_refs(spark: SparkSession, folder: str) -> DataFrame:
    """References held by a record column and by an array inside another record."""
    return extract_files(filed(spark, folder), ["doc_id"])


@query(
    f"""WITH {FILES_SQL}
    SELECT doc_id, 'body' AS path, 'copies/' || digest AS key, extension, size FROM files
    UNION ALL
    SELECT doc_id, 'extra.previews', 'copies/' || regexp_extract(path, '([^/]*)$', 1), '.png', doc_id
    FROM files
    UNION ALL
    SELECT doc_id, 'extra.previews', 'copies/' || regexp_extract(path, '([^/]*)$', 1), '.png', size
    FROM files WHERE size > 1000"""
)
def copy_nested_refs(spark: SparkSession, folder: str) -> DataFrame:
    """Every reference of a sheet, at any depth, becomes one of another data set."""
    copied = map_files(
        filed(spark, folder), lambda file: copied_key(file.getField("key"), "copies/")
    )
    return extract_files(copied, ["doc_id"])


def filed(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a file of their own and an array of preview files."""

    def reference(key, suffix, size):
        return F.struct(
            key.alias("key"), suffix.alias("extension"), size.cast("bigint").alias("size")
        )

    df = documents_as_files(spark, folder)
    size = F.octet_length("content")
    previews = F.array_compact(
        F.array(
            reference(F.concat(F.lit("thumb/"), "path"), F.lit(".png"), F.col("doc_id")),
            F.when(
                size > 1000, reference(F.concat(F.lit("large/"), "path"), F.lit(".png"), size)
            ),
        )
    )
    return df.select(
        "doc_id",
        reference(
            F.concat(F.lit("store/"), F.sha1("content")), extension(F.col("path")), size
        ).alias("body"),
        F.struct(F.col("source"), previews.alias("previews")).alias("extra"),
    )
