"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from sheetspark import plans
from sheetspark.operators import order

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query_equals_its_sql(spark, duck, name, monkeypatch):
    monkeypatch.setattr(order, "RANGE_ROWS", 50)  # many ranges even on small tables
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    assert sql is not None, "every query here has a SQL form"
    assert differences(df, duck, sql) is None


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())
