"""What the physical plans must (not) contain to hold at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sheetspark.operators import edit, order
from sheetspark.operators.query import apply, query, search
from sheetspark.sources.sheets import write_bucketed

FOLDER = "/root/testdata/sf0.001"

NO_SHUFFLE = """any_match all_match array_filter_records array_filter_scalars array_size array_max
array_min array_sum elem_compare elem_arith elem_logic_same_element elem_enum elem_temporal
bool_array_any nested_array computed_array_sum filter_eq_ne filter_range filter_logic
filter_chained filter_enum filter_temporal filter_bool filter_nested arith_add_sub_mul arith_mod
arith_pow arith_div apply_column query_apply saved_search select_columns select_named
rename_field retype_field insert_field drop_field flatten_record array_field_values enum_codes
temporal_to_int explode_items file_refs load_declared load_inferred load_schema_file
case_insensitive extend classify_refs copy_refs copy_nested_refs bad_nested_enum file_table image_size bad_enum bad_length""".split()


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_operators_do_not_shuffle(spark, plan, name):
    assert "Exchange" not in plan(entry.queries()[name](spark, FOLDER))


# Writing and reading sheets, positions and histories run jobs when they are built.
EAGER = """write_read_roundtrip downsample_copy""".split()


def test_no_query_joins_every_pair_or_sorts_in_one_task(spark, plan, monkeypatch):
    """Only whole-table measures, one row each, may end in a single partition."""
    monkeypatch.setattr(order, "RANGE_ROWS", 20)
    measures = {"row_count", "shape_size", "leaf_counts", "search_count", "violation_counts"}
    for name, function in entry.queries().items():
        if name in EAGER:
            continue
        text = plan(function(spark, FOLDER))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        if name not in measures:
            assert "SinglePartition" not in text, name


@pytest.fixture(scope="module")
def nested(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("nested") / "t")
    item = F.struct(
        F.col("id").alias("a"),
        F.lit("x").alias("b"),
        F.struct(F.lit(1.5).alias("c"), F.lit("wide").alias("d")).alias("deep"),
        F.array(F.col("id")).alias("list"),
    )
    spark.range(100).select("id", F.array(item, item).alias("items")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize(
    "predicate, read",
    [
        (lambda x: (x["items"]["a"] > 5).any(), "array<struct<a:bigint>>"),
        (lambda x: (x["items"]["b"] == "x").any(), "array<struct<b:string>>"),
        (
            lambda x: ((x["items"]["a"] > 5) & (x["items"]["b"] == "x")).all(),
            "array<struct<a:bigint,b:string>>",
        ),
        (
            lambda x: (x["items"]["deep"]["c"] > x["id"]).any(),
            "array<struct<deep:struct<c:double>>>",
        ),
        (lambda x: x["items"].size() > 1, "array<struct<a:bigint>>"),
        (lambda x: x["items"]["deep"]["c"].sum() > 1, "array<struct<deep:struct<c:double>>>"),
    ],
)
def test_predicates_read_only_their_fields(nested, predicate, read):
    scan = query(nested, predicate).select("id")._jdf.queryExecution().executedPlan().toString()
    whole = nested.where(F.lit(True))
    assert whole.columns == nested.columns
    formatted = query(nested, predicate).select("id")
    schema = _read_schema(formatted)
    assert f"items:{read}" in schema, (schema, scan)


def _read_schema(df):
    explained = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return [line for line in explained.splitlines() if line.startswith("ReadSchema")][0]


def test_saved_searches_prune_too(nested):
    found = search(
        nested,
        {"where": {"$any_match": ["$.items", {"$gt": ["$.a", 3]}]}, "select": ["$.id"]},
    )
    assert "items:array<struct<a:bigint>>" in _read_schema(found)


def test_scalar_predicates_reach_the_scan(spark, plan):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    kept = query(query(lines, lambda x: x["l_quantity"] > 5), lambda x: x["l_tax"] == 0.0)
    text = plan(apply(kept, lambda x: x["l_extendedprice"] * x["l_discount"]))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_tax)" in text
    assert text.count("Filter") - text.count("Filters") == 1
    schema = _read_schema(apply(kept, lambda x: x["l_extendedprice"]))
    assert schema == "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_tax:double>"


def test_value_search_is_compiled(spark, plan):
    text = plan(entry.queries()["any_match"](spark, FOLDER))
    assert "array_contains" in text and "exists" not in text


def test_edits_of_a_bucketed_sheet_do_not_move_it(spark, plan, tmp_path):
    base = spark.range(20_000).select(
        F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.col("id").cast("string").alias("s")
    )
    spark.sql("DROP TABLE IF EXISTS bucketed_sheet")
    write_bucketed(base, "bucketed_sheet", key="k", buckets=8, path=str(tmp_path / "sheet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table("bucketed_sheet")
        updates = spark.range(0, 20_000, 7).select(F.col("id").alias("k"), F.lit(-1).cast("bigint").alias("v"))
        updated = edit.update_by_key(stored, updates, "k")
        text = plan(updated)
        assert text.count("Exchange") == 1
        assert updated.where("v = -1").count() == 2858
        deleted = edit.delete_by_key(stored, updates, "k")
        assert plan(deleted).count("Exchange") == 1
        assert deleted.count() == 20_000 - 2858
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_sheet")


def test_computed_arrays_are_computed_once(spark, plan):
    from pyspark.sql import functions as F

    from sheetspark.operators.query import query

    both = lambda x: ((x["r"]["a"] > 1) & (x["r"]["b"] == "marked")).any()
    made = F.array(F.struct(F.col("id").alias("a"), F.concat(F.lit("mar"), F.lit("ked")).alias("b")))
    wanted = F.transform(F.sequence(F.lit(1), F.col("id")), lambda i: F.struct(i.alias("a"), F.lit("marked").alias("b")))
    df = spark.range(5).withColumn("r", F.when(F.col("id") > 0, wanted))
    kept = query(df, both)
    assert sorted(r.id for r in kept.collect()) == [2, 3, 4]
    text = plan(kept)
    condition = next(line for line in text.splitlines() if "Filter" in line)
    assert condition.count("sequence(") == 1
    again = query(spark.range(3).withColumn("r", made).withColumnRenamed("r", "s"), lambda x: (x["s"]["a"] > 1).any())
    assert again.count() == 1
