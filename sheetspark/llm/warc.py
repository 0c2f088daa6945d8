"""Web pages as a sharded WARC archive, and back.

Pages are dealt out to ranges of their ids and sorted; each range writes its records, each a gzip
member of its own, into files that are closed by compressed size.  The same pages always give the
same files.  A payload that another page has too is stored once; the others revisit it.

The files are written by Spark's own writer, so any store that Spark writes to will do: under
temporary names first, by task attempt, then in a folder of a temporary name together with a
manifest, and that folder is renamed when all is there.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetspark.llm.common import plain_id, solid_id, stored

#: Compressed bytes after which a file is closed, and payload bytes of a range of ids.
FILE_BYTES, RANGE_BYTES = 8 << 20, 32 << 20
#: Ranges at most, and ids that are looked at to cut them.
RANGES, SAMPLE = 20_000, 40_000
LEVEL = 4
# Names of the format.
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = "1970-01-01T00:00:00Z"
SUFFIX = ".warc.gz"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _record_id(page_id: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the payload's digest and length but not the payload."""
    digest = _base32(hashlib.sha1(payload).digest())
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head + payload if refers_to is None else head
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{page_id}")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {EPOCH}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{_base32(hashlib.sha1(block).digest())}",
        f"X-Page-ID: {page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [
            f"WARC-Profile: {REVISIT}",
            f"WARC-Refers-To: {_record_id(refers_to, digest)}",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def parse(data: bytes) -> Iterator[tuple[int, int, str, str, int | None]]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of a file's records.

    Members are unpacked one at a time; lengths and digests are checked.
    """
    view, at = memoryview(data), 0
    while at < len(data):
        unpack = zlib.decompressobj(31)
        member = unpack.decompress(view[at:])
        if not unpack.eof:
            raise ValueError("a record is cut off")
        at = len(data) - len(unpack.unused_data)
        if not member:
            continue
        head, _, rest = member.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        block = rest[:length]
        if rest[length:] != b"\r\n\r\n":
            raise ValueError("a block is not as long as it says")
        if f"sha1:{_base32(hashlib.sha1(block).digest())}" != fields["WARC-Block-Digest"]:
            raise ValueError("a block differs from its digest")
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = fields["WARC-Type"]
        if kind == "response":
            if len(payload) != size or _base32(hashlib.sha1(payload).digest()) != digest:
                raise ValueError("a payload differs from its digest")
        refers_to = fields.get("X-Refers-To-Page-ID")
        yield int(fields["X-Page-ID"]), size, digest, kind, refers_to and int(refers_to)


def _bounds(keys: DataFrame) -> np.ndarray:
    """Ids that cut the pages into ranges of about RANGE_BYTES.

    They come from a sample that depends on the ids alone, of about SAMPLE ids.
    """
    total = keys.agg(F.count("*"), F.sum("n_bytes")).first()
    count, bytes_ = total[0], total[1] or 0
    ranges = int(min(RANGES, max(1, bytes_ // RANGE_BYTES)))
    every = max(1, count // SAMPLE)
    sample = keys.where(F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0)
    rows = sample.groupBy("page_id").agg(F.sum("n_bytes")).limit(4 * SAMPLE).collect()
    rows.sort()
    ends = np.cumsum([r[1] for r in rows]) if rows else np.zeros(0)
    wanted = [np.searchsorted(ends, ends[-1] * k / ranges) for k in range(1, ranges)] if rows else []
    return np.unique(np.array([rows[i][0] for i in wanted], dtype=np.int64))


def _revisits(keys: DataFrame, least: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a page of a larger id has too."""
    shared = (
        keys.where(F.col("n_bytes") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "refers_to")
    )
    return (
        keys.where(F.col("n_bytes") >= least)
        .join(stored(shared, "warc-shared"), "digest")
        .where("page_id != refers_to")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def write_warc(
    pages: DataFrame, folder: str, least: int = 0, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write ``page_id``, ``url``, ``html`` as WARC files into ``folder``; the manifest.

    Of pages with equal payloads of at least ``least`` bytes, that with the largest page_id is
    a response and the others revisit it; a null html is an empty payload.  Rows that repeat a
    page are written each, and a null page_id sorts first.  ``folder`` must not exist; it appears,
    whole, at the end.  The manifest has ``file``, ``records`` and ``bytes``.
    """
    spark = pages.sparkSession
    rows = pages.select(
        solid_id(F.col("page_id")).alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    known = rows.withColumn("digest", F.sha1("html"))
    keys = stored(
        known.select("page_id", "digest", F.octet_length("html").cast("bigint").alias("n_bytes")),
        "warc-keys",
    )
    revisits = _revisits(keys, least)
    cuts = _bounds(keys)

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, ids.to_numpy(), side="left").astype(np.int32))

    # Before a page, sorted with it, comes what is known of its payload.
    notes = revisits.select(
        "page_id",
        "digest",
        F.lit(0).alias("kind"),
        "refers_to",
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("html"),
    )
    records = known.select(
        "page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("refers_to"), "url", "html"
    )
    sorted_rows = (
        notes.unionByName(records)
        .withColumn("range", range_of("page_id"))
        .repartitionById(len(cuts) + 1, F.col("range"))
        .sortWithinPartitions("range", "page_id", "digest", "kind", "url")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        note, number, place = (None, None, None), 0, None
        parts: list[bytes] = []
        size = count = 0

        def closed() -> pa.RecordBatch:
            nonlocal parts, size, count, number
            data = b"".join(parts)
            if data[-1]:  # the writer ends a file with a zero byte; so does an empty member
                data += _member(b"")
            name = f"{place:06d}-{number:05d}"
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.array([count], pa.int64()),
                    pa.array([len(data)], pa.int64()),
                    pa.array([data[:-1]], pa.binary()),
                ],
                ["shard", "records", "bytes", "data"],
            )
            parts, size, count, number = [], 0, 0, number + 1
            return out

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "digest", "kind", "refers_to", "range", "url")]
            html = batch.column("html")
            for i, (page_id, digest, kind, refers_to, where, url) in enumerate(
                zip(*(c.to_pylist() for c in columns))
            ):
                if kind == 0:
                    note = (page_id, digest, refers_to)
                    continue
                place = where
                target = note[2] if note[:2] == (page_id, digest) else None
                member = _member(record(page_id, url, html[i].as_py().encode(), target))
                if parts and size + len(member) > file_bytes:
                    yield closed()
                parts.append(member)
                size += len(member)
                count += 1
        if parts:
            yield closed()

    temporary = f"{folder}.writing-{uuid.uuid4().hex}"
    shards = sorted_rows.mapInArrow(run, "shard string, records bigint, bytes bigint, data binary")
    (
        shards.select(
            F.col("data").cast("string").alias("value"),
            F.concat_ws("_", "shard", "records", "bytes").alias("shard"),
        )
        .write.partitionBy("shard")
        .option("lineSep", "\0")
        .text(f"{temporary}/parts")
    )
    return _commit(spark, temporary, folder)


def _commit(spark: SparkSession, temporary: str, folder: str) -> DataFrame:
    """Give the written files their names, write the manifest, and rename the folder."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    files = path(temporary).getFileSystem(conf)
    manifest = []
    for shard in files.listStatus(path(f"{temporary}/parts")):
        name = shard.getPath().getName()
        if not name.startswith("shard="):
            continue
        number, records, size = name.removeprefix("shard=").split("_")
        written = [s for s in files.listStatus(shard.getPath()) if not s.getPath().getName().startswith((".", "_"))]
        if len(written) != 1 or written[0].getLen() != int(size):
            raise RuntimeError(f"{name} is not whole")
        if not files.rename(written[0].getPath(), path(f"{temporary}/{number}{SUFFIX}")):
            raise RuntimeError(f"{name} can't be renamed")
        manifest.append((f"{number}{SUFFIX}", int(records), int(size)))
    files.delete(path(f"{temporary}/parts"), True)
    spark.createDataFrame(sorted(manifest), "file string, records bigint, bytes bigint").coalesce(
        1
    ).write.json(f"{temporary}/manifest")
    if files.exists(path(folder)) or not files.rename(path(temporary), path(folder)):
        raise RuntimeError(f"{folder} exists or can't be made")
    return _manifest(spark, folder)


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("file string, records bigint, bytes bigint").json(f"{folder}/manifest")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the files that the manifest names.

    Per record: ``page_id``, ``payload_bytes`` and ``payload_digest`` of the full payload,
    ``record_type`` and ``refers_to``.  Lengths and digests are checked; a file that is missing
    or of another size is an error.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches:
            for content in batch.column("content"):
                found = list(parse(content.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*found), kinds)], names
                )

    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{SUFFIX}")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(folder)
    )
    there = files.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes")
    )
    listed = _manifest(spark, folder).select("file", "bytes")
    if not listed.exceptAll(there).isEmpty() or not there.exceptAll(listed).isEmpty():
        raise RuntimeError(f"the files of {folder} are not those of its manifest")
    return (
        files.select("content")
        .mapInArrow(
            run,
            "page_id bigint, payload_bytes bigint, payload_digest string, record_type string,"
            " refers_to bigint",
        )
        .select(
            plain_id(F.col("page_id")).alias("page_id"),
            "payload_bytes",
            "payload_digest",
            "record_type",
            plain_id(F.col("refers_to")).alias("refers_to"),
        )
    )


def rewritten(pages: DataFrame, folder: str) -> DataFrame:
    """``pages`` written to ``folder`` and read back; see ``write_warc`` and ``read_warc``."""
    write_warc(pages, folder)
    return read_warc(pages.sparkSession, folder)
