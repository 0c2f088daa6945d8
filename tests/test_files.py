"""Files, references and image headers."""

from __future__ import annotations

import hashlib
import struct

import pytest
from pyspark.sql import functions as F

from sheetspark import schema as schemas
from sheetspark.operators import edit, files
from sheetspark.operators.measures import pending_counts
from sheetspark.operators.query import query
from sheetspark.sources.files import (
    extract_files,
    file_table,
    image_record,
    image_table,
    map_files,
    read_files,
)
from sheetspark.sources.load import from_rows


def test_file_table(spark, tmp_path):
    contents = {
        "a.txt": b"one",
        "deep/b.tar.gz": b"two",
        "deep/c.gz": b"one",
        "deep/.hidden": b"",
        "noext": b"x" * 1000,
        "dot.": b"d",
        "q.r/s": b"s",
        "archive.csv.bz2": b"t",
    }
    for name, data in contents.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)
    rows = {
        r.path.split(str(tmp_path) + "/")[1]: (r.extension, r.size, r.checksum)
        for r in file_table(read_files(spark, str(tmp_path))).collect()
    }
    suffixes = {
        "a.txt": ".txt",
        "deep/b.tar.gz": ".tar.gz",
        "deep/c.gz": ".gz",
        "noext": "",
        "dot.": "",
        "q.r/s": "",
        "archive.csv.bz2": ".csv.bz2",
        "deep/.hidden": "",
    }
    for name, row in rows.items():
        data = contents[name]
        assert row == (suffixes[name], len(data), hashlib.sha1(data).hexdigest())
    assert set(contents) - {"deep/.hidden"} <= set(rows)
    keyed = read_files(spark, str(tmp_path)).withColumn(
        "key", files.content_key(F.col("content"), "p/")
    )
    copies = files.distinct_files(keyed).where(F.col("n_copies") == 2).collect()
    assert [r.key for r in copies] == ["p/" + hashlib.sha1(b"one").hexdigest()]


def _jpeg(height, width, segments=1):
    app = segments * (b"\xff\xe1" + struct.pack(">H", 5000) + bytes(4998))
    table = b"\xff\xc4" + struct.pack(">H", 19) + bytes(17)
    padded = b"\xff\xff\xff\xdb" + struct.pack(">H", 4) + b"\xff\xc0"
    return b"\xff\xd8" + app + table + padded + b"\xff\xc1\x00\x11\x08" + struct.pack(">HH", height, width)


def _tiff(height, width, order, kind):
    code = {"<": b"II*\0", ">": b"MM\0*"}[order]
    form, width_of = {3: ("H", 2), 4: ("L", 4), 1: ("B", 1)}[kind], 4
    def entry(tag, value):
        packed = struct.pack(order + form[0], value).ljust(width_of, b"\0")
        return struct.pack(order + "HHL", tag, kind, 1) + packed
    entries = entry(254, 0) + entry(257, height) + entry(256, width)
    return code + struct.pack(order + "L", 20) + bytes(12) + struct.pack(order + "H", 3) + entries


def _webp(chunk, body):
    return b"RIFF\0\0\0\0WEBP" + chunk + body


IMAGES = {
    "jpeg": (_jpeg(480, 640), 480, 640),
    "jpeg long": (_jpeg(481, 641, 300), 481, 641),
    "png": (b"\x89PNG\r\n\x1a\n\0\0\0\rIHDR" + struct.pack(">LL", 640, 480), 480, 640),
    "png-old": (b"\x89PNG\r\n\x1a\n" + struct.pack(">LL", 640, 480) + b"", 480, 640),
    "gif": (b"GIF87a" + struct.pack("<HH", 640, 480), 480, 640),
    "jpeg2000": (b"\0\0\0\x0cjP  \r\n\x87\n" + bytes(36) + struct.pack(">LL", 480, 640), 480, 640),
    "bmp": (b"BM" + bytes(12) + struct.pack("<Iii", 40, 640, -480), 480, 640),
    "bmp os2": (b"BM" + bytes(12) + struct.pack("<IHH", 12, 640, 480) + bytes(4), 480, 640),
    "tiff le": (_tiff(480, 640, "<", 3), 480, 640),
    "tiff be": (_tiff(480, 640, ">", 4), 480, 640),
    "tiff bytes": (_tiff(48, 64, ">", 1), 48, 64),
    "ico": (b"\0\0\1\0\1\0\x40\x30", 48, 64),
    "ico full": (b"\0\0\1\0\1\0\0\0", 256, 256),
    "webp lossy": (_webp(b"VP8 ", bytes(7) + b"\x9d\x01\x2a" + struct.pack("<HH", 640 | 0x4000, 480)), 480, 640),
    "webp lossless": (_webp(b"VP8L", bytes(4) + b"\x2f" + struct.pack("<L", 639 | 479 << 14)), 480, 640),
    "webp extended": (_webp(b"VP8X", bytes(8) + (69999).to_bytes(3, "little") + (479).to_bytes(3, "little")), 480, 70000),
    "flif": (b"FLIF31" + b"\x84\x7f" + b"\x83\x5f" + bytes(8), 480, 640),
    "flif small": (b"FLIF31" + b"\x0f\x07" + bytes(8), 8, 16),
}


def test_image_sizes(spark, plan):
    rows = [(name, bytearray(data)) for name, (data, _, _) in IMAGES.items()]
    df = spark.createDataFrame(rows, "path string, content binary")
    assert "Python" not in plan(image_table(df))
    for r in image_table(df).collect():
        _, height, width = IMAGES[r.path]
        assert (r.path, r.height, r.width) == (r.path, height, width)
        assert r.format == r.path.split(" ")[0]


def test_image_reference(spark):
    data = bytearray(IMAGES["gif"][0])
    df = spark.createDataFrame([("d/a.gif", data), ("b.txt", bytearray(b"no"))], "path string, content binary")
    rows = df.select(image_record(F.col("path"), F.col("content")).alias("image")).collect()
    assert [tuple(r.image) for r in rows] == [
        ("d/a.gif", ".gif", 10, 480, 640),
        ("b.txt", ".txt", 2, None, None),
    ]


@pytest.mark.parametrize(
    "data",
    [
        b"",
        b"plain text, no image at all",
        b"\xff\xd8\xff\xe0",
        b"\xff\xd8\xff\xe0\xff\xff" + bytes(20),
        b"\xff\xd8" + bytes(30),
        b"GIF89a" + bytes(2),
        b"II*\0" + struct.pack("<L", 5_000_000) + bytes(20),
        _webp(b"VP8 ", bytes(20)),
        b"BM" + bytes(12) + struct.pack("<I", 20) + bytes(20),
        b"FLIF31" + b"\xff" * 30,
        _jpeg(10, 10)[:-2],
        _jpeg(10, 10, 300)[:-2],
        b"\xff\xd8" + b"\xff" * 5000,
    ],
)
def test_broken_images_have_no_size(spark, data):
    df = spark.createDataFrame([("p", bytearray(data)), ("n", None)], "path string, content binary")
    assert [(r.height, r.width) for r in image_table(df).collect()] == [(None, None)] * 2


def test_references_at_any_depth(spark):
    file = {"type": "file.File"}
    schema = schemas.record(
        id="int64",
        image={"type": "file.Image"},
        deep=schemas.record(mask={"type": "label.Mask"}, n="int32"),
        many=schemas.array(file),
        boxes=schemas.array(schemas.record(crop=file, grid=schemas.array(schemas.array(file)))),
        text="string",
    )

    def ref(key):
        return {"key": key, "extension": ".x", "size": len(key)}

    rows = [
        {
            "id": 0,
            "image": {**ref("i"), "height": 3, "width": 4},
            "deep": {"mask": ref("m"), "n": 1},
            "many": [ref("a"), None, ref("bb")],
            "boxes": [{"crop": ref("c"), "grid": [[ref("g1"), ref("g2")], []]}, {"crop": None, "grid": None}],
        },
        {"id": 1},
        {"id": 2, "many": [], "boxes": []},
    ]
    df = from_rows(spark, rows, schema)
    found = sorted((r.id, r.path, r.key, r.size) for r in extract_files(df, ["id"]).collect())
    assert found == [
        (0, "boxes.crop", "c", 1),
        (0, "boxes.grid", "g1", 2),
        (0, "boxes.grid", "g2", 2),
        (0, "deep.mask", "m", 1),
        (0, "image", "i", 1),
        (0, "many", "a", 1),
        (0, "many", "bb", 2),
    ]
    assert tuple(pending_counts(df).first()) == (3, 7, schemas.leaf_count(schema))
    assert tuple(pending_counts(df.select("id", "text")).first()) == (3, 0, 2)
    assert query(df, lambda x: x["image"]["size"] >= 1).count() == 1
    moved = map_files(df, lambda file: F.concat(F.lit("new/"), file.getField("key")))
    assert schemas.same_schema(moved.schema, df.schema)
    again = sorted((r.id, r.path, r.key, r.size) for r in extract_files(moved, ["id"]).collect())
    assert again == [(i, path, "new/" + key, size) for i, path, key, size in found]


def test_copies(spark):
    df = spark.createDataFrame(
        [(None, "k0", "w"), ("t", "p/k1", "w"), ("o", "p/q/k2", "w")],
        "dataset string, key string, workspace string",
    )
    problem = files.copy_problem(F.col("workspace"), F.lit("s"), "w", "s")
    copied = files.copy_references(df, "key", "dataset", "t", "n/", problem)
    assert sorted(r.key for r in copied.collect()) == ["k0", "n/k2", "p/k1"]
    refused = files.copy_problem(F.col("workspace"), F.lit("s"), "elsewhere", "s")
    with pytest.raises(Exception, match="other workspace"):
        files.copy_references(df, "key", "dataset", "t", "n/", refused).collect()
    mapping = spark.createDataFrame([("k0", "z")], "key string, new_key string")
    assert sorted(r.key for r in files.map_references(df, "key", mapping).collect()) == [
        "p/k1",
        "p/q/k2",
        "z",
    ]


def test_hot_keys(spark, plan):
    """A third of the rows refer to one object, and one key is deleted a great many times."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
        refs = spark.range(60_000).select("id", hot.alias("key"))
        mapping = refs.select("key", F.concat(F.lit("new/"), "key").alias("new_key")).distinct()
        moved = files.map_references(refs, "key", mapping)
        assert moved.count() == 60_000
        assert moved.where(F.col("key") == "new/hot").count() == 20_000
        copies = files.distinct_files(refs.withColumn("path", F.col("id").cast("string")))
        assert copies.where(F.col("n_copies") > 1).collect()[0].n_copies == 20_000
        base = spark.range(100).select(F.col("id").cast("string").alias("key"))
        gone = edit.delete_by_key(base.union(refs.limit(0).select("key")), refs, "key")
        assert gone.count() == 100 - 66
        text = plan(gone)
        assert text.index("HashAggregate") < text.rindex("Exchange") < text.rindex("HashAggregate")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
