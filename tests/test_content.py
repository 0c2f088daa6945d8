"""Contents stored once, and keys that are leased."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from sheetspark.sources import content, keys
from sheetspark.sources.claims import Conflict, claim


def files_of(spark, *texts):
    rows = [(None if t is None else bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(rows, "content binary")


def stored(spark, root):
    return {r.key: bytes(r.content) for r in content.stored_contents(spark, root).collect()}


def test_equal_bytes_are_stored_once(spark, tmp_path):
    root = str(tmp_path / "contents")
    assert stored(spark, root) == {}
    content.put_contents(spark, root, files_of(spark, "a", "b", "a", "", None))
    first = stored(spark, root)
    assert first == {hashlib.sha1(t).hexdigest(): t for t in (b"a", b"b", b"")}
    batch = content.write_contents(spark, root, files_of(spark, "b", "a", "a"))
    assert spark.read.schema(content.STORED).parquet(f"{root}/batches/batch={batch}").isEmpty()
    content.put_contents(spark, root, files_of(spark, "b", "c"))
    assert set(stored(spark, root).values()) == {b"a", b"b", b"c", b""}


def test_a_put_that_broke_off_shows_nothing(spark, tmp_path):
    root = str(tmp_path / "contents")
    content.put_contents(spark, root, files_of(spark, "a"))
    lost = content.write_contents(spark, root, files_of(spark, "b", "c"))
    assert set(stored(spark, root).values()) == {b"a"}
    content.put_contents(spark, root, files_of(spark, "b", "c"))
    assert set(stored(spark, root).values()) == {b"a", b"b", b"c"}
    content.publish_contents(spark, root, lost)  # late, by a writer that was thought lost
    rows = content.stored_contents(spark, root).collect()
    assert sorted(bytes(r.content) for r in rows) == [b"a", b"b", b"c"]
    references = spark.createDataFrame([(hashlib.sha1(b"b").hexdigest(),), ("gone",)], "key string")
    assert [r.key for r in content.missing_keys(spark, root, references).collect()] == ["gone"]


def test_a_name_is_taken_once(spark, tmp_path):
    claim(spark, str(tmp_path / "name"), "mine")
    with pytest.raises(Conflict):
        claim(spark, str(tmp_path / "name"), "theirs")
    assert (tmp_path / "name").read_text() == "mine\n"


def test_leases_are_disjoint(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "keys")
    assert keys.lease(spark, root, 10, start=7) == 7
    assert keys.lease(spark, root, 5) == 17
    assert keys.lease(spark, root, 0) == keys.lease(spark, root, 1) == 22
    with pytest.raises(ValueError):
        keys.lease(spark, root, -1)
    read, stale = keys.high_water, iter([keys.high_water(spark, root)])
    keys.lease(spark, root, 4)  # by another writer, after the mark was read
    monkeypatch.setattr(keys, "high_water", lambda *a: next(stale, None) or read(*a))
    assert keys.lease(spark, root, 2) == 27


def test_appends_under_leased_keys(spark, tmp_path):
    root = str(tmp_path / "keys")
    sheet = spark.createDataFrame([("x", "00000000000000000004")], "v string, __record_key string")
    batch = spark.createDataFrame([("c",), ("a",), ("b",)], "v string")
    once = keys.append_leased(sheet, batch, "v", root, start=5)
    twice = keys.append_leased(once, batch.withColumn("v", F.upper("v")), "v", root)
    rows = {int(r["__record_key"]): r.v for r in twice.collect()}
    assert rows == {4: "x", 5: "a", 6: "b", 7: "c", 8: "A", 9: "B", 10: "C"}
