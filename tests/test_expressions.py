"""Row functions on worked examples and on edge rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark import schema as schemas
from sheetspark.functions.criteria import CriteriaError
from sheetspark.operators.query import apply, query, search, select
from sheetspark.sources.load import from_rows


KINDS = ["net", "discount", "tax"]


@pytest.fixture(scope="module")
def invoices(spark):
    """Three invoices with their charges: one has a tax, one only net amounts, one none at all."""
    charge = {"type": "record", "fields": [
        {"name": "kind", "type": "enum", "values": KINDS}, {"name": "amount", "type": "float64"},
    ]}
    schema = schemas.record(number="string", charges=schemas.array(charge))
    charges = {
        "i1": [("net", 40.0), ("tax", 7.6)],
        "i2": [("net", 12.5), ("net", 30.0)],
        "i3": [],
    }
    rows = [
        {"number": number, "charges": [{"kind": k, "amount": v} for k, v in items]}
        for number, items in charges.items()
    ]
    return from_rows(spark, rows, schema)


def names(df):
    return sorted(r.number for r in df.collect())


def test_searches_of_arrays(invoices):
    assert names(query(invoices, lambda x: x["number"] == "i2")) == ["i2"]
    net = lambda x: x["charges"]["kind"] == "net"
    assert names(query(invoices, lambda x: net(x).any())) == ["i1", "i2"]
    assert names(query(invoices, lambda x: net(x).all())) == ["i2", "i3"]
    taxes = apply(invoices, lambda x: x["charges"].query(lambda c: c["kind"] == "tax"))
    assert taxes.columns == ["apply_result"]
    assert sorted(len(r.apply_result) for r in taxes.collect()) == [0, 0, 1]
    large = apply(
        query(invoices, lambda x: (x["charges"]["amount"] > 35).any()),
        lambda x: x["charges"].query(lambda c: c["amount"] < 10),
    ).collect()
    assert [[c.amount for c in r.apply_result] for r in large] == [[7.6]]


def test_enum_literal_must_be_declared(invoices):
    with pytest.raises(KeyError):
        query(invoices, lambda x: (x["charges"]["kind"] == "fee").any())
    with pytest.raises(TypeError):
        query(invoices, lambda x: (x["charges"]["kind"] > "net").any())


def test_saved_search_uses_enum_codes(invoices):
    found = search(invoices, {"where": {"$any_match": ["$.charges", {"$eq": ["$.kind", 2]}]}})
    assert names(found) == ["i1"]
    chosen = search(
        invoices,
        {
            "where": {"$all_match": ["$.charges", {"$gte": ["$.amount", 10]}]},
            "select": ["$.number", {"sizes.all": {"$size": ["$.charges"]}}],
        },
    )
    assert chosen.schema["sizes"].dataType == T.StructType(
        [T.StructField("all", T.LongType(), True)]
    )
    assert chosen.count() == 2


@pytest.mark.parametrize(
    "criteria",
    [
        {"where": {"$like": ["$.number", "a"]}},
        {"where": {"$eq": ["$.missing", "a"]}},
        {"select": [7]},
        {"select": ["$.number", {"number": {"$size": ["$.charges"]}}]},
        {"select": ["$.number", {"number.inner": {"$size": ["$.charges"]}}]},
    ],
)
def test_bad_searches_are_refused(invoices, criteria):
    with pytest.raises(CriteriaError):
        search(invoices, criteria)


@pytest.fixture(scope="module")
def edges(spark):
    schema = schemas.record(
        id="int64",
        n="int32",
        f="float32",
        flag="boolean",
        xs=schemas.array("int32"),
        items=schemas.array(schemas.record(a="int32", b="string", deep=schemas.record(c="float64"))),
        grid=schemas.array(schemas.array("int64")),
        inner=schemas.record(s="string"),
    )
    def item(a, b, c):
        return {"a": a, "b": b, "deep": {"c": c}}

    rows = [
        {"id": 0, "n": 7, "f": 1.5, "flag": True, "xs": [1, None, 3], "items": [item(1, "x", 0.5), None, item(5, None, 1.5)], "grid": [[1, 2], []], "inner": {"s": "p"}},
        {"id": 1, "n": 0, "f": float("nan"), "flag": None, "xs": [], "items": [], "grid": [], "inner": None},
        {"id": 2, "n": None, "f": None, "flag": False, "xs": None, "items": None, "grid": None, "inner": {"s": None}},
        {"id": 3, "n": -7, "f": 2.0, "flag": False, "xs": [9], "items": [item(9, "y", None)], "grid": [[5], None], "inner": {"s": "q"}},
    ]
    return from_rows(spark, rows, schema)


def values(df, function):
    return [r.v for r in apply(df, function, "v", keep=["id"]).orderBy("id").collect()]


def test_null_and_empty_arrays(edges):
    assert values(edges, lambda x: (x["xs"] > 2).any()) == [True, False, None, True]
    assert values(edges, lambda x: (x["xs"] > 0).all()) == [None, True, None, True]
    assert values(edges, lambda x: (x["xs"] == 3).any()) == [True, False, None, False]
    assert values(edges, lambda x: (x["items"]["b"] == "x").any()) == [True, False, None, False]
    assert values(edges, lambda x: (x["items"]["b"] == "y").any()) == [None, False, None, True]
    assert values(edges, lambda x: x["xs"].size()) == [3, 0, None, 1]
    assert values(edges, lambda x: x["xs"].sum()) == [4, 0, None, 9]
    assert values(edges, lambda x: x["xs"].max()) == [3, None, None, 9]
    assert values(edges, lambda x: x["xs"].min()) == [1, None, None, 9]
    assert values(edges, lambda x: x["items"].size()) == [3, 0, None, 1]
    assert values(edges, lambda x: x["items"]["deep"]["c"].sum()) == [2.0, 0.0, None, 0.0]


def test_value_search_agrees_with_exists(edges):
    """``array_contains`` stands in for ``exists``: the same answers, nulls included."""
    for wanted in ("x", "y", "z"):
        fast = values(edges, lambda x: (x["items"]["b"] == wanted).any())
        general = [
            r.v
            for r in edges.select(
                "id", F.exists("items.b", lambda b: b == wanted).alias("v")
            ).orderBy("id").collect()
        ]
        assert fast == general
        fast = values(edges, lambda x: (x["items"]["b"] != wanted).all())
        general = [
            r.v
            for r in edges.select(
                "id", F.forall("items.b", lambda b: b != wanted).alias("v")
            ).orderBy("id").collect()
        ]
        assert fast == general


def test_element_logic_is_per_element(edges):
    same = lambda x: ((x["items"]["a"] > 2) & (x["items"]["b"] == "x")).any()
    apart = lambda x: (x["items"]["a"] > 2).any() & (x["items"]["b"] == "x").any()
    assert values(edges, same)[3] is False
    assert values(edges, apart)[0] is True
    assert values(edges, same)[0] is None  # one element's b is null


def test_array_of_arrays(edges):
    assert values(edges, lambda x: x["grid"].each(lambda g: g.size()).column) == [
        [2, 0],
        [],
        None,
        [1, None],
    ]
    assert values(edges, lambda x: x["grid"].each(lambda g: (g == 5).any()).any()) == [
        False,
        False,
        None,
        True,
    ]
    assert values(edges, lambda x: x["grid"].each(lambda g: g.sum()).sum()) == [3, 0, None, 5]


def test_filters_compose(edges):
    kept = lambda x: x["items"].query(lambda i: i["a"] > 1)["deep"]["c"].max()
    assert values(edges, kept) == [1.5, None, None, None]
    outer = lambda x: x["items"].query(lambda i: i["a"] == x["n"] - 2).size()
    assert values(edges, outer) == [1, 0, None, 0]
    assert values(edges, lambda x: x["xs"].query(lambda v: v >= 3).size()) == [1, 0, None, 1]


def test_arithmetic_types(edges):
    types = {
        "int32": lambda x: x["n"] + x["n"],
        "bigint": lambda x: x["n"] + 1,
        "float": lambda x: x["f"] * x["n"],
        "double": lambda x: x["f"] * 2.0,
        "power": lambda x: x["n"] ** 2,
        "ratio": lambda x: x["n"] / x["n"],
    }
    df = select(edges, types)
    assert [f.dataType.simpleString() for f in df.schema.fields] == [
        "int",
        "bigint",
        "float",
        "double",
        "bigint",
        "double",
    ]


def test_division_and_remainder(edges):
    assert values(edges, lambda x: x["id"] / x["n"]) == [0.0, None, None, 3 / -7]
    assert values(edges, lambda x: x["n"] % 3) == [1, 0, None, -1]
    assert values(edges, lambda x: x["id"] % (x["n"] - x["n"])) == [None] * 4
    assert values(edges, lambda x: 10 - x["n"]) == [3, 10, None, 17]
    assert values(edges, lambda x: x["xs"] * 2 + 1) == [[3, None, 7], [], None, [19]]


def test_overflow_is_an_error(spark):
    df = from_rows(spark, [{"n": 2**31 - 1}], schemas.record(n="int32"))
    with pytest.raises(Exception, match="OVERFLOW"):
        apply(df, lambda x: x["n"] + x["n"]).collect()


def test_type_families(edges):
    for bad in (
        lambda x: x["flag"] > True,
        lambda x: x["inner"]["s"] < "p",
        lambda x: x["n"] == "7",
        lambda x: x["n"] > x["flag"],
        lambda x: x["n"] & x["flag"],
        lambda x: x["inner"]["s"] + 1,
        lambda x: x["n"] == True,  # noqa: E712
        lambda x: x["n"] + 1,  # not boolean
        lambda x: x["xs"] > 1,  # not closed
    ):
        with pytest.raises(TypeError):
            query(edges, bad)
    with pytest.raises(ValueError):
        query(edges, lambda x: ((x["xs"] > 1) & (x["items"]["a"] > 1)).any())
    with pytest.raises(TypeError):
        query(edges, lambda x: (x["n"] > 1) and (x["n"] < 3))


def test_null_tests_and_negation(edges):
    assert [r.id for r in query(edges, lambda x: x["n"] == None).collect()] == [2]  # noqa: E711
    kept = query(edges, lambda x: ~x["flag"] | (x["n"] != None))  # noqa: E711
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2, 3]
    assert [r.id for r in query(edges, lambda x: x["inner"]["s"] == "q").collect()] == [3]


def test_temporal_literals(spark):
    schema = schemas.record(
        d="date",
        t={"type": "time", "unit": "ms"},
        ts={"type": "timestamp", "unit": "ms"},
        tz={"type": "timestamp", "tz": "Asia/Tokyo"},
        span={"type": "timedelta", "unit": "s"},
    )
    moment = dt.datetime(2024, 5, 6, 7, 8, 9)
    df = spark.createDataFrame(
        [(moment.date(), 25_689_000, moment, moment.replace(tzinfo=dt.timezone.utc), dt.timedelta(seconds=90))],
        schema,
    )
    tokyo = dt.timezone(dt.timedelta(hours=9))
    for right in (
        lambda x: x["d"] == dt.date(2024, 5, 6),
        lambda x: x["d"] < dt.datetime(2024, 5, 7, 1),
        lambda x: x["d"] == (dt.date(2024, 5, 6) - dt.date(1970, 1, 1)).days,
        lambda x: x["t"] == dt.time(7, 8, 9),
        lambda x: x["t"] < dt.time(7, 8, 9, 1000),
        lambda x: x["ts"] == moment,
        lambda x: x["ts"] == 1714979289000,
        lambda x: x["ts"] >= dt.date(2024, 5, 6),
        lambda x: x["tz"] == moment,
        lambda x: x["tz"] == moment.replace(hour=16, tzinfo=tokyo),
        lambda x: x["tz"] < moment.replace(hour=17, tzinfo=tokyo),
        lambda x: x["span"] == dt.timedelta(seconds=90),
        lambda x: x["span"] == 90,
        lambda x: x["span"] > dt.timedelta(minutes=1),
    ):
        assert query(df, right).count() == 1
    for wrong in (
        lambda x: x["d"] == dt.timedelta(1),
        lambda x: x["ts"] == "2024-05-06",
        lambda x: x["d"] == x["ts"],
        lambda x: x["t"] == x["span"],
        lambda x: x["span"] == dt.time(1),
    ):
        with pytest.raises(TypeError):
            query(df, wrong)


def test_names_ignore_case(edges):
    assert [r.id for r in query(edges, lambda x: x["ID"] == 3).collect()] == [3]
    assert values(edges, lambda x: x["ITEMS"]["DEEP"]["C"].size()) == [3, 0, None, 1]
    with pytest.raises(KeyError):
        query(edges, lambda x: x["nothing"] == 1)


def test_stateless_operators_accept_a_stream(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint").parquet(str(tmp_path / "in"))
    doubled = apply(query(stream, lambda x: x["id"] > 6), lambda x: x["id"] * 2)
    running = doubled.writeStream.format("memory").queryName("doubled").trigger(availableNow=True).start()
    running.awaitTermination(60)
    assert sorted(r.apply_result for r in spark.table("doubled").collect()) == [14, 16, 18]
