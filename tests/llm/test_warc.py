"""WARC: an exact round trip, the same files every time, files that are whole or not there."""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import pytest

from sheetspark.llm import warc
from sheetspark.llm.warc import read_warc, rewritten, write_warc
from sheetspark.runtime import fresh_path


def plain(rows, least=0):
    payloads = [(html or "").encode() for _, _, html in rows]
    largest = {}
    for (page_id, _, _), payload in zip(rows, payloads):
        if len(payload) >= least:
            known = largest.get(payload, page_id)
            largest[payload] = known if page_id is None else max(page_id, known or page_id)
    out = []
    for (page_id, _, _), payload in zip(rows, payloads):
        first = largest.get(payload, page_id)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        own = first == page_id
        out.append(
            (page_id, len(payload), digest, "response" if own else "revisit", None if own else first)
        )
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files_of(folder):
    from pathlib import Path

    return {p.name: p.read_bytes() for p in Path(folder).glob("*.warc.gz")}


def test_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    assert got(rewritten(df, fresh_path(spark, "warc"))) == plain(rows)


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 20_000)
    rows = [(7 * i % 101, f"http://x/{i}", f"<p>{i % 40}é</p>" * (i % 30)) for i in range(101)]
    rows += [(200 + i, None, "same" * 900) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder, again = fresh_path(spark, "warc"), fresh_path(spark, "warc")
    manifest = write_warc(df, folder, file_bytes=2_000).collect()
    assert got(read_warc(spark, folder)) == plain(rows)
    write_warc(df.repartition(5), again, file_bytes=2_000)
    files = files_of(folder)
    assert files == files_of(again) and len(files) > 5
    assert {m.file: m.bytes for m in manifest} == {n: len(d) for n, d in files.items()}
    assert sum(m.records for m in manifest) == len(rows)
    ids = []
    for name in sorted(files):
        data = gzip.decompress(files[name])  # any reader of gzip sees one stream of records
        ids += [int(x.split(b"\r\n")[0]) for x in data.split(b"X-Page-ID: ")[1:]]
    assert ids == sorted(ids)


def test_edges(spark):
    rows = [
        (1, "u", None), (2, "u", ""), (None, None, "x"), (4, "a b\r\nWARC-Type: c", "x"),
        (5, "u", "WARC/1.1\r\n\r\n" * 3), (5, "u", "WARC/1.1\r\n\r\n" * 3), (6, "u", "z" * 20_000_000),
    ]
    df = spark.createDataFrame([(*r, 9) for r in rows], "page_id long, url string, html string, digest int")
    assert got(rewritten(df, fresh_path(spark, "warc"))) == plain(rows)
    folder = fresh_path(spark, "warc")
    write_warc(df, folder, least=1)
    assert got(read_warc(spark, folder)) == plain(rows, least=1)
    with pytest.raises(Exception, match="exists"):
        write_warc(df, folder)
    assert rewritten(df.limit(0), fresh_path(spark, "warc")).count() == 0


def test_damage_is_seen(spark):
    from pathlib import Path

    df = spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string")
    folder = fresh_path(spark, "warc")
    write_warc(df, folder)
    (name, data), = files_of(folder).items()
    inside = zlib.decompressobj(31).decompress(data)
    with pytest.raises(ValueError):
        list(warc.parse(data[:-4]))
    with pytest.raises(ValueError):
        list(warc.parse(gzip.compress(inside.replace(b"text\r\n", b"tuxt\r\n"))))
    Path(folder, name).unlink()
    with pytest.raises(RuntimeError):
        read_warc(spark, folder)
