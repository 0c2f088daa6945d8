"""Declared schemas, loading and column edits."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark import schema as schemas
from sheetspark.operators import checks, columns, edit, measures
from sheetspark.operators.query import query
from sheetspark.sources import load
from sheetspark.sources.sheets import read_sheet, write_sheet

INVOICE = {
    "type": "record",
    "fields": [
        {"name": "l_orderkey", "type": "int64"},
        {"name": "l_extendedprice", "type": "float64"},
        {
            "name": "shipment",
            "type": "record",
            "fields": [
                {"name": "mode", "type": "enum", "values": ["AIR", "RAIL", "SHIP", "TRUCK"]},
                {"name": "due", "type": "date"},
                {"name": "returned", "type": "boolean"},
            ],
        },
    ],
}

EVERYTHING = {
    "type": "record",
    "fields": [
        {"name": "s", "type": "string"},
        {"name": "b", "type": "binary"},
        {"name": "day", "type": "date"},
        {"name": "at", "type": "time", "unit": "ns"},
        {"name": "ts", "type": "timestamp", "unit": "ms"},
        {"name": "tz", "type": "timestamp", "unit": "us", "tz": "Europe/Berlin"},
        {"name": "span", "type": "timedelta", "unit": "s"},
        {"name": "coded", "type": "enum", "values": {3: "a", 7: "b"}},
        {"name": "with_null", "type": "enum", "values": ["a", None, "c"]},
        {"name": "numbers", "type": "enum", "values": [10, 20]},
        {"name": "image", "type": "file.Image"},
        {"name": "point", "type": "array", "items": {"type": "float64"}, "length": 3},
        {
            "name": "tags",
            "type": "array",
            "items": {"type": "enum", "values": ["x", "y"]},
        },
        {
            "name": "boxes",
            "type": "array",
            "items": {"type": "record", "fields": [{"name": "c", "type": "float32"}]},
        },
    ],
}


@pytest.mark.parametrize("document", [INVOICE, EVERYTHING])
def test_documents_round_trip(document):
    schema = schemas.from_pyobj(document)
    assert schemas.to_pyobj(schema) == document
    yaml = pytest.importorskip("yaml")
    assert yaml.safe_load(schemas.to_yaml(schema)) == document
    assert schemas.same_schema(schemas.from_yaml(schemas.to_yaml(schema)), schema)


def test_json_text_keeps_the_order_of_keys():
    schema = schemas.record(o_orderkey="int64", o_orderstatus=schemas.enum(["F", "O", "P"]))
    text = (
        '{"type": "record", "fields": [{"name": "o_orderkey", "type": "int64"}, '
        '{"name": "o_orderstatus", "type": "enum", "values": ["F", "O", "P"]}]}'
    )
    assert schemas.to_json(schema) == text
    assert schemas.from_json(text) == schema


def test_schema_files(tmp_path, spark):
    (tmp_path / "schema.json").write_text(json.dumps(INVOICE))
    schema = schemas.read_json(str(tmp_path / "schema.json"))
    modes = schema["shipment"].dataType["mode"].metadata["values"]
    assert modes == ["AIR", "RAIL", "SHIP", "TRUCK"]
    pytest.importorskip("yaml")
    (tmp_path / "schema.yaml").write_text(schemas.to_yaml(schema))
    assert schemas.read_yaml(str(tmp_path / "schema.yaml")) == schema
    df = load.from_rows(spark, [{"l_orderkey": 7, "shipment": {"mode": "RAIL"}}], schema)
    assert df.first().asDict(recursive=True) == {
        "l_orderkey": 7,
        "l_extendedprice": None,
        "shipment": {"mode": "RAIL", "due": None, "returned": None},
    }


@pytest.mark.parametrize(
    "bad",
    [
        {"type": "decimal"},
        {"type": "enum", "values": [1.5]},
        {"type": "enum", "values": ["a", 1]},
    ],
)
def test_unknown_types(bad):
    with pytest.raises(TypeError):
        schemas.field("c", bad)


def test_bad_time_zone_and_unit():
    with pytest.raises(Exception):
        schemas.field("t", {"type": "timestamp", "tz": "Nowhere/Land"})
    with pytest.raises(ValueError):
        schemas.field("t", {"type": "time", "unit": "hour"})


def test_schema_edits():
    schema = schemas.record(a="string", b="int32")
    assert schemas.insert(schema, 1, "c", "float64").names == ["a", "c", "b"]
    assert schemas.rename(schema, "a", "z").names == ["z", "b"]
    assert schemas.astype(schema, "b", "int64")["b"].dataType == T.LongType()
    assert schemas.drop(schema, 0).names == ["b"]
    for wrong in (
        lambda: schemas.insert(schema, 0, "a", "string"),
        lambda: schemas.rename(schema, "q", "z"),
        lambda: schemas.rename(schema, "a", "b"),
        lambda: schemas.astype(schema, "q", "int64"),
        lambda: schemas.drop(schema, "q"),
    ):
        with pytest.raises(KeyError):
            wrong()


def test_leaf_count():
    schema = schemas.record(
        f="string", image={"type": "file.Image"}, boxes=schemas.array(schemas.box2d(["a"]))
    )
    assert schemas.leaf_count(schema) == 1 + 5 + 5


def test_name_conflicts_at_every_depth():
    inner = schemas.record(x="int32", X="int32")
    schema = schemas.record(a="string", A="string", deep=schemas.array(schemas.array(inner)))
    assert sorted(schemas.name_conflicts(schema)) == [("a", "A"), ("deep.x", "deep.X")]
    with pytest.raises(ValueError):
        schemas.check_names(schema)


def test_inferred_rows(spark):
    rows = [{"points": [{"xmin": 1, "ymin": 3}, {"xmin": 5, "ymin": 8}]}, {"points": []}]
    df = load.from_rows(spark, rows)
    assert df.schema["points"].dataType.simpleString() == "array<struct<xmin:bigint,ymin:bigint>>"
    assert load.to_rows(df) == rows
    with pytest.raises(ValueError):
        load.from_rows(spark, df, schemas.record(a="string"))
    assert [r.value for r in load.from_values(spark, [1, 2, None]).collect()] == [1, 2, None]


def test_arrow_dictionary_becomes_enum(spark):
    codes = pa.array(["cat", "dog", None, "cat"]).dictionary_encode()
    df = load.from_arrow(spark, pa.table({"i": [0, 1, 2, 3], "kind": codes}))
    assert df.schema["kind"].metadata["values"] == ["cat", "dog"]
    assert query(df, lambda x: x["kind"] == "cat").count() == 2
    with pytest.raises(KeyError):
        query(df, lambda x: x["kind"] == "cow")
    pdf = load.to_pandas(df.orderBy("i"))
    assert list(pdf["kind"].cat.categories) == ["cat", "dog"]
    struct = pa.StructArray.from_arrays([pa.array([1, 2])], names=["a"])
    assert load.from_arrow(spark, struct).count() == 2


@pytest.mark.parametrize(
    "column",
    [
        pa.array([1], pa.int8()),
        pa.array([1], pa.uint32()),
        pa.array([[("a", 1)]], pa.map_(pa.string(), pa.int64())),
        pa.array([1], pa.decimal128(5, 0)),
        pa.array([1], pa.time32("s")),
    ],
)
def test_unsupported_arrow_types(spark, column):
    with pytest.raises(TypeError):
        load.from_arrow(spark, pa.table({"c": column}))


def test_pandas_round_trip(spark):
    pdf = pd.DataFrame(
        {
            "A": np.arange(10),
            "B": [f"data{i}" for i in range(10)],
            "C": [bool(i % 2) for i in range(10)],
        }
    )
    df = load.from_pandas(spark, pdf)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["bigint", "string", "boolean"]
    pd.testing.assert_frame_equal(load.to_pandas(df.orderBy("A")), pdf)
    many = pd.DataFrame([[1, 2]], columns=pd.MultiIndex.from_tuples([("a", "b"), ("a", "c")]))
    with pytest.raises(NotImplementedError):
        load.from_pandas(spark, many)


def test_add_column_example(spark):
    df = load.from_rows(spark, [{"filename": f"{n}.jpg"} for n in "abc"])
    captions = load.from_rows(
        spark, [{"filename": f"{n}.jpg", "caption": n} for n in "abc"]
    )
    df = columns.attach_column(df, "caption", captions, "filename")
    df = edit.backfill_column(
        df,
        "category",
        schemas.enum(["cat", "dog"]),
        load.from_rows(
            spark,
            [{"filename": f"{n}.jpg", "category": c} for n, c in zip("abc", ["cat", "dog", "cat"])],
        ),
        "filename",
    )
    rows = [tuple(r) for r in df.orderBy("filename").collect()]
    assert rows == [("a.jpg", "a", "cat"), ("b.jpg", "b", "dog"), ("c.jpg", "c", "cat")]
    assert query(df, lambda x: x["category"] == "cat").count() == 2
    with pytest.raises(NotImplementedError):
        columns.add_column(df, "Caption", F.lit(1))
    short = captions.limit(2)
    assert checks.unmatched_keys(df, short, "filename").count() == 1


def test_column_edits_keep_null_records(spark):
    schema = schemas.record(id="int64", r=schemas.record(a="int32", b=schemas.record(c="int32")))
    df = load.from_rows(
        spark, [{"id": 1, "r": {"a": 1, "b": {"c": 2}}}, {"id": 2, "r": None}, {"id": 3, "r": {"a": 4}}], schema
    )
    renamed = columns.rename(df, "r.b.c", "d")
    assert load.to_rows(renamed.orderBy("id")) == [
        {"id": 1, "r": {"a": 1, "b": {"d": 2}}},
        {"id": 2, "r": None},
        {"id": 3, "r": {"a": 4, "b": None}},
    ]
    dropped = columns.drop(columns.astype(df, "r.a", "int64"), "r.b")
    assert dropped.schema["r"].dataType.simpleString() == "struct<a:bigint>"
    assert load.to_rows(dropped.orderBy("id"))[1] == {"id": 2, "r": None}
    assert columns.flatten(df).columns == ["id", "r_a", "r_b_c"]
    assert columns.insert(df, 0, "note", "string").columns == ["note", "id", "r"]
    with pytest.raises(KeyError):
        columns.rename(df, "r.q", "z")


def test_enum_codes_invert(spark):
    for values in (["a", "b", "c"], {5: "a", 9: "b", -1: "c"}):
        df = load.from_rows(
            spark,
            [{"e": v} for v in ["a", "b", "c", None]],
            schemas.record(e=schemas.enum(values)),
        )
        coded = columns.with_codes(df, "e")
        back = columns.from_codes(coded, "e_code", "again", values)
        assert back.where(~F.col("e").eqNullSafe(F.col("again"))).isEmpty()
        expected = [0, 1, 2] if isinstance(values, list) else [5, 9, -1]
        assert [r.e_code for r in back.collect()] == [*expected, None]


def test_large_enums(spark, plan):
    values = [f"label {i}" for i in range(1000)]
    df = load.from_rows(
        spark, [{"i": i, "e": values[i % 1000]} for i in range(3000)] + [{"i": 9999}],
        schemas.record(i="int64", e=schemas.enum(values)),
    )
    coded = columns.with_codes(df, "e")
    assert "BroadcastHashJoin" in plan(coded)
    back = columns.from_codes(coded, "e_code", "again", values)
    assert back.count() == 3001
    assert back.where(~F.col("e").eqNullSafe(F.col("again"))).isEmpty()
    assert {r.i: r.e_code for r in coded.collect()} == {**{i: i % 1000 for i in range(3000)}, 9999: None}


def test_write_refuses_bad_sheets(spark, tmp_path):
    schema = schemas.record(e=schemas.enum(["a"]))
    good = load.from_rows(spark, [{"e": "a"}, {"e": None}], schema)
    write_sheet(good, str(tmp_path), "good")
    again = read_sheet(spark, str(tmp_path), "good")
    assert again.schema["e"].metadata["values"] == ["a"]
    bad = load.from_rows(spark, [{"e": "z"}], schema, check=False)
    assert checks.bad_enums(bad, "e").count() == 1
    with pytest.raises(Exception, match="undeclared value in e"):
        write_sheet(bad, str(tmp_path), "bad")


def test_declarations_hold_at_every_depth(spark, tmp_path):
    kind = schemas.enum(["x", "y"])
    schema = schemas.record(
        id="int64",
        boxes=schemas.array(schemas.record(kind=kind, tags=schemas.array(kind))),
        point=schemas.array("float64", length=2),
    )
    good = [
        {"id": 0, "boxes": [{"kind": "x", "tags": ["y", None]}, None], "point": [1.0, 2.0]},
        {"id": 1, "boxes": None, "point": None},
        {"id": 2, "boxes": []},
    ]
    df = load.from_rows(spark, good, schema)
    write_sheet(df, str(tmp_path), "good")
    again = read_sheet(spark, str(tmp_path), "good")
    assert schemas.same_schema(again.schema, schema)
    assert load.to_rows(again.orderBy("id")) == load.to_rows(df.orderBy("id"))
    for i, row in enumerate(
        [
            {"boxes": [{"kind": "z"}]},
            {"boxes": [{"kind": "x", "tags": ["x", "q"]}]},
            {"point": [1.0]},
        ]
    ):
        bad = load.from_rows(spark, [{"id": 9, **row}], schema)
        with pytest.raises(Exception, match="undeclared value in"):
            write_sheet(bad, str(tmp_path), f"bad{i}")
    assert checks.bad_enums(df, "boxes").count() == 0
    assert checks.bad_lengths(df, "point").count() == 0


def test_extend(spark):
    df = load.from_rows(
        spark,
        [{"name": "Ada", "profile": {"x": 1, "y": 1}}, {"name": "Bo", "profile": {"x": 2, "y": 2}}],
    )
    more = load.from_rows(spark, [{"name": "Cy", "profile": {"x": 3, "y": 3}}])
    assert edit.extend(df, more).count() == 3
    assert edit.extend(df, df).count() == 4
    for wrong in (
        load.from_rows(spark, [{"name": 1, "profile": {"x": 3, "y": 3}}]),
        load.from_rows(spark, [{"profile": {"x": 3, "y": 3}, "name": "c"}]),
        load.from_rows(spark, [{"name": "c", "profile": {"x": 3}}]),
    ):
        with pytest.raises(TypeError):
            edit.extend(df, wrong)
    keyed = df.withColumn("__record_key", F.col("name"))
    rows = edit.extend(keyed, more, key="__record_key")
    assert [r["__record_key"] for r in rows.where("name = 'Cy'").collect()] == [None]
    assert checks.schema_differences(df.schema, more.drop("profile").schema) == [
        ("1", "profile: struct<x:bigint,y:bigint>", "")
    ]


def test_measures(spark):
    df = load.from_rows(spark, [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}])
    assert tuple(measures.shape(df).first()) == (2, 2, 4)
    assert measures.row_count(df).first()[0] == 2
