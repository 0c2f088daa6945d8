"""Byte-level BPE over a corpus: every distinct word is encoded once.

1. Texts are cut into pre-tokens.  Some consecutive texts are a block: its distinct words are its
   dictionary, and its positions are places in the dictionary, word after word.
2. Dictionaries, not positions, are dealt out by word: a word occurs once a block there, however
   common it is.  Where all blocks' entries of a word meet, it is encoded once.
3. The ids go back to the blocks, where they are put in the place of the words, position by position.
4. Decoding joins ids with the table of the tokens' bytes.  That table has a row for each token of
   the vocabulary file, so it is joined where the ids are.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.common import id_text, slices, small_batches
from sheetspark.runtime import fresh_path

#: Bytes of text in a block, and in what is cut into words at a time; a longer text is alone.
BLOCK, SLICE = 1 << 24, 1 << 20
#: Dictionary entries aimed at in one bucket of words.
BUCKET = 1 << 19
#: Words or ids that are put together at a time.
PART = 1 << 18

BLOCK_SCHEMA = (
    "block bigint, doc_ids array<bigint>, counts array<int>, places binary, words array<string>"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks, which are their ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the adjacent pair of lowest rank is merged, the first of equals."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    parts = [word[i : i + 1] for i in range(len(word))]
    last = len(parts)
    following, before = list(range(1, last + 1)), list(range(-1, last - 1))
    heap = []
    for i in range(last - 1):
        rank = ranks.get(parts[i] + parts[i + 1])
        if rank is not None:
            heap.append((rank, i))
    heapify(heap)
    while heap:
        rank, i = heappop(heap)
        j = following[i]
        if j == last or not parts[i]:
            continue
        pair = parts[i] + parts[j]
        if ranks.get(pair) != rank:  # the pair here has changed since
            continue
        parts[i], parts[j] = pair, b""
        following[i] = after = following[j]
        if after != last:
            before[after] = i
            rank = ranks.get(pair + parts[after])
            if rank is not None:
                heappush(heap, (rank, i))
        if (left := before[i]) >= 0:
            rank = ranks.get(parts[left] + pair)
            if rank is not None:
                heappush(heap, (rank, left))
    return [ranks[p] for p in parts if p]


def word_hashes(words: list[str]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False)


class _Block:
    """The words of consecutive texts, gathered slice by slice."""

    def __init__(self) -> None:
        self.slots: dict[str, int] = {}
        self.places: list[np.ndarray] = []
        self.ids: list[pa.Array] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[str], cut) -> None:
        words: list[str] = []
        for text in texts:
            found = cut(text)
            self.counts.append(len(found))
            words += found
            self.size += len(text.encode())
        self.ids.append(ids)
        if words:
            coded = pa.array(words, pa.string()).dictionary_encode()
            slots = self.slots
            known = [slots.setdefault(w, len(slots)) for w in coded.dictionary.to_pylist()]
            self.places.append(np.array(known, dtype="<u4")[coded.indices.to_numpy()])

    def row(self, block: int) -> pa.RecordBatch:
        """The block as one row, its dictionary in order of the words' hashes."""
        words = list(self.slots)
        order = np.argsort(word_hashes(words), kind="stable") if words else np.zeros(0, np.int64)
        place = np.empty(len(words), dtype="<u4")
        place[order] = np.arange(len(words), dtype="<u4")
        places = place[np.concatenate(self.places)] if self.places else np.zeros(0, "<u4")
        planes = np.ascontiguousarray(places.view(np.uint8).reshape(-1, 4).T)
        packed = zstandard.ZstdCompressor(level=3).compress(planes.tobytes())
        ids = pa.concat_arrays(self.ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.ListArray.from_arrays([0, len(ids)], ids),
                pa.array([self.counts], pa.list_(pa.int32())),
                pa.array([packed], pa.binary()),
                pa.array([[words[k] for k in order]], pa.list_(pa.string())),
            ],
            ["block", "doc_ids", "counts", "places", "words"],
        )


def _packed(array: pa.Array) -> bytes:
    """An array as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, pa.schema([("x", array.type)]), options=options) as writer:
        writer.write_batch(pa.RecordBatch.from_arrays([array], ["x"]))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_next_batch().column(0)


def _gathered(picks: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray):
    """The picked stretches of ``flat`` end to end, and where each begins (one more at the end)."""
    long = sizes[picks]
    ends = np.concatenate([[0], np.cumsum(long)])
    index = np.arange(ends[-1]) + np.repeat(starts[picks] - ends[:-1], long)
    return flat[index], ends


def _parts(counts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows with about ``size`` items; a longer one is alone."""
    ends, at, done = np.cumsum(counts), 0, 0
    while at < len(counts):
        last = max(int(np.searchsorted(ends, done + size, side="right")), at + 1)
        yield at, last
        at, done = last, int(ends[last - 1])


def _places(packed: bytes, total: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, total).T).view("<u4").ravel()


def _blocks(df: DataFrame, pattern: str) -> DataFrame:
    """Blocks of texts, in a table bucketed by block: it is read beside others without a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut, number = regex.compile(pattern).findall, TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            for part in slices(batch, SLICE):
                block.add(part.column("doc_id"), part.column("text").to_pylist(), cut)
                if block.size >= BLOCK:
                    yield block.row(number)
                    number, block = number + 1, _Block()
        if block.ids:
            yield block.row(number)

    spark = df.sparkSession
    rows = id_text(df).mapInArrow(run, BLOCK_SCHEMA)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"bpe_blocks_{uuid.uuid4().hex}"
    with small_batches(spark):
        writer = rows.write.option("path", fresh_path(spark, "bpe-blocks")).option("compression", "zstd")
        writer.bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def _dealt(blocks: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, start, words): consecutive dictionary entries whose hashes share high bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words in zip(batch.column("block").to_pylist(), batch.column("words")):
                flat = words.values
                if not len(flat):
                    continue
                buckets = (word_hashes(flat.to_pylist()) >> np.uint64(64 - bits)).astype(np.int64)
                starts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1])
                sizes = np.diff(np.append(starts, len(flat)))
                packed = [_packed(pa.concat_arrays([flat.slice(a, n)])) for a, n in zip(starts, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(buckets[starts]),
                        pa.array(np.full(len(starts), block)),
                        pa.array(starts, pa.int32()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["bucket", "block", "start", "words"],
                )

    return blocks.select("block", "words").mapInArrow(
        run, "bucket bigint, block bigint, start int, words binary"
    )


def _encoded_words(dealt: DataFrame, path: str) -> DataFrame:
    """(block, start, codes): the ids of dictionary entries, every word of a bucket encoded once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, known, current = read_ranks(path), {}, None
        kind = pa.list_(pa.uint16() if max(ranks.values()) < 1 << 16 else pa.uint32())
        for batch in batches:
            codes = []
            for bucket, words in zip(batch.column("bucket").to_pylist(), batch.column("words")):
                if bucket != current:
                    known, current = {}, bucket
                found = []
                for word in _unpacked(words.as_py()).to_pylist():
                    code = known.get(word)
                    if code is None:
                        code = known[word] = tuple(encode_word(word.encode(), ranks))
                    found.append(code)
                codes.append(_packed(pa.array(found, kind)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("start"), pa.array(codes, pa.binary())],
                ["block", "start", "codes"],
            )

    rows = dealt.repartition("bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "block bigint, start int, codes binary")


def _reassembled(left: pa.Table, right: pa.Table) -> pa.Table:
    """The ids of a block's texts from its positions and its dictionary."""
    codes = [_unpacked(c) for c in right.sort_by("start").column("codes").to_pylist()]
    codes = pa.concat_arrays(codes) if codes else pa.array([], pa.list_(pa.uint16()))
    flat = codes.flatten().to_numpy().astype(np.int32)
    sizes = pc.list_value_length(codes).to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    doc_ids = left.column("doc_ids").combine_chunks().values
    counts = left.column("counts").combine_chunks().values.to_numpy().astype(np.int64)
    places = _places(left.column("places")[0].as_py(), int(counts.sum()))
    lists, done = [], 0
    for at, last in _parts(counts, PART):
        edges = np.concatenate([[0], np.cumsum(counts[at:last])])
        ids, ends = _gathered(places[done : done + edges[-1]], starts, sizes, flat)
        lists.append(pa.ListArray.from_arrays(pa.array(ends[edges], pa.int32()), pa.array(ids)))
        done += edges[-1]
    return pa.table({"doc_id": doc_ids, "ids": pa.chunked_array(lists, pa.list_(pa.int32()))})


def encode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per row: ``doc_id`` and ``ids``, the ids of its text by the ranks at ``path``.

    Each match of ``pattern`` is encoded alone, as the tiktoken library does; strings of special
    tokens are plain text.  A null or empty text has no ids.  Repeated rows and null ids are rows
    of their own; other columns of ``df`` are not read.
    """
    blocks = _blocks(df, pattern)
    entries = blocks.agg(F.sum(F.size("words")).alias("n")).head().n or 0
    bits = max(6, (entries // BUCKET).bit_length())
    words = _encoded_words(_dealt(blocks, bits), path)
    sides = blocks.drop("words").groupBy("block").cogroup(words.groupBy("block"))
    return sides.applyInArrow(_reassembled, "doc_id bigint, ids array<int>")


def decode(df: DataFrame, path: str) -> DataFrame:
    """``df`` with ``decoded``, the bytes of its ``ids`` end to end.

    Null ids give null, no ids no bytes; an id that the table does not have fails the job.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        table = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            table[rank] = token
        sizes = np.fromiter(map(len, table), np.int64, len(table))
        starts, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(table), np.uint8)
        for batch in batches:
            counts = pc.fill_null(pc.list_value_length(batch.column("ids")), 0).to_numpy()
            for at, last in _parts(counts, PART):
                part = batch.slice(at, last - at)
                lists = part.column("ids")
                ids = lists.flatten().to_numpy()
                if len(ids) and (ids.min() < 0 or ids.max() >= len(sizes) or not sizes[ids].all()):
                    raise ValueError("an id without a token")
                text, ends = _gathered(ids, starts, sizes, flat)
                edges = ends[np.concatenate([[0], np.cumsum(counts[at:last])])]
                decoded = pa.Array.from_buffers(
                    pa.large_binary(), len(lists), [None, pa.py_buffer(edges), pa.py_buffer(text)]
                ).cast(pa.binary())
                if lists.null_count:
                    decoded = pc.if_else(lists.is_null(), pa.scalar(None, pa.binary()), decoded)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, decoded], [*part.schema.names, "decoded"]
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, decoded binary")


def digests(df: DataFrame) -> DataFrame:
    """Per row of ids and decoded bytes: ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy().astype("<u4")
            counts = pc.list_value_length(lists).to_numpy()
            ends = np.cumsum(counts)
            sums = [hashlib.sha256(flat[e - c : e]).hexdigest() for e, c in zip(ends, counts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums), batch.column("decoded")],
                ["doc_id", "n_tokens", "ids_sha256", "decoded"],
            )

    rows = df.select("doc_id", "ids", "decoded").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded binary"
    )
    return rows.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
