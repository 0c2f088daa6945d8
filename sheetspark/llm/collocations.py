"""Collocations from suffix subtrees that are built apart from one another.

1. Texts are cut into pieces and words.  Some consecutive texts are a block: a dictionary of its
   words with their counts, and its text as places in it.  Dictionaries are dealt out in ranges of
   the words' hashes; where all entries of a word meet, it is counted, and a frequent one gets a
   code that goes back to the blocks.
2. Words of candidates are as frequent as the candidates, so a suffix ends before a rarer word.  So
   are their pairs of neighbouring words: a block counts its pairs in buckets of their hashes, the
   counts are added up over all blocks, and a suffix ends between two words whose bucket is
   rarer, since a pair is no more frequent than its bucket.
3. Vertical partitioning: suffixes of two to ``longest`` words are dealt out by a prefix.  That
   is the first word, and, where its frequency is over the budget of a prefix, the next one too, and
   so on: no prefix is more frequent than its last word, so all are within the budget but those
   of frequent words only, at full depth, which are one leaf.  Prefixes are dealt into as many
   groups as keep the suffixes of one within the budget of memory.
4. A group's suffixes, sorted, are the leaves of its subtrees: the count of a node is the total of the
   leaves under it.  Only nodes above a prefix that had to be lengthened get counts from more than
   one group; they are added up.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetspark.llm.byte_bpe import word_hashes
from sheetspark.llm.common import slices, small_batches, stored
from sheetspark.runtime import fresh_path

#: Bytes of text in a block, and in what is cut into words at a time; a longer text is alone.
BLOCK, SLICE = 1 << 24, 1 << 20
#: Suffixes of a block that are sorted and counted at a time.
PART = 1 << 18
#: Suffixes that a group may hold, and the part of a group that one prefix may fill.
BUDGET, SHARE = 1 << 21, 4
#: Dictionary entries aimed at in one range of words' hashes, and buckets in one range of pairs.
ENTRIES, PAIRS = 1 << 19, 1 << 22
#: Occurrences of pairs aimed at in a bucket.
LOAD = 4
#: Parts into which a language's phrases are dealt to find its first ones.
SALTS = 64
#: What ends a piece.  Fixed value.
ENDS = "[.,;:!?\n-\r]+"

BLOCK_SCHEMA = (
    "block bigint, places binary, n bigint, distinct bigint, langs array<struct<lang string, n bigint>>,"
    " entries array<struct<lang string, word string, n bigint>>"
)
CODED_SCHEMA = (
    "bucket int, block bigint, start int, codes binary,"
    " words array<struct<lang string, word string, f bigint>>"
)
CODED = pa.schema(
    [
        ("bucket", pa.int32()),
        ("block", pa.int64()),
        ("start", pa.int32()),
        ("codes", pa.binary()),
        (
            "words",
            pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("f", pa.int64())])),
        ),
    ]
)


def _planes(values: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed byte by byte."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _flat(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


def _packed(batch: pa.RecordBatch) -> bytes:
    """A batch as one compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


class _Block:
    """Words of consecutive texts; place 0 stands between pieces."""

    def __init__(self) -> None:
        self.slots: dict[tuple, int] = {}
        self.places: list[np.ndarray] = []
        self.size = 0

    def add(self, langs: pa.Array, texts: pa.Array) -> None:
        self.size += int(pc.sum(pc.binary_length(texts)).as_py() or 0)
        marked = pc.replace_substring_regex(pc.ascii_lower(texts), ENDS, " . ")
        lists = pc.ascii_split_whitespace(marked)
        coded = lists.flatten().dictionary_encode()
        if not len(coded):
            return
        codes = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_pylist()
        counts = pc.list_value_length(lists).to_numpy()
        named = langs.dictionary_encode()
        of_word = np.repeat(named.indices.to_numpy().astype(np.int64), counts)
        pairs, inverse = np.unique(of_word * len(words) + codes, return_inverse=True)
        names, slots, known = named.dictionary.to_pylist(), self.slots, []
        for lang, word in zip((pairs // len(words)).tolist(), (pairs % len(words)).tolist()):
            word = words[word]
            if word in ("", "."):
                known.append(0)
            else:
                known.append(slots.setdefault((names[lang], word), len(slots) + 1))
        found = np.array(known, dtype="<u4")[inverse]
        starts = np.cumsum(counts) - counts  # a piece also ends where a text does
        self.places.append(np.insert(found, starts, 0))

    def row(self, block: int) -> pa.RecordBatch:
        """The block as one row, its dictionary in order of the words' hashes."""
        langs, words = zip(*self.slots) if self.slots else ((), ())
        order = np.argsort(word_hashes(list(words)), kind="stable") if words else np.zeros(0, np.int64)
        place = np.zeros(len(words) + 1, dtype="<u4")
        place[order + 1] = np.arange(1, len(words) + 1, dtype="<u4")
        places = place[np.concatenate([*self.places, np.zeros(1, "<u4")])]
        counts = np.bincount(places, minlength=len(words) + 1)[1:]
        entries = pa.StructArray.from_arrays(
            [
                pa.array([langs[k] for k in order], pa.string()),
                pa.array([words[k] for k in order], pa.string()),
                pa.array(counts, pa.int64()),
            ],
            ["lang", "word", "n"],
        )
        sizes: dict[str, int] = {}
        for k, n in zip(order.tolist(), counts.tolist()):
            sizes[langs[k]] = sizes.get(langs[k], 0) + n
        sizes = pa.StructArray.from_arrays(
            [pa.array(sizes.keys(), pa.string()), pa.array(sizes.values(), pa.int64())], ["lang", "n"]
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.array([_planes(places)], pa.binary()),
                pa.array([int(counts.sum())], pa.int64()),
                pa.array([len(words)], pa.int64()),
                pa.ListArray.from_arrays([0, len(sizes)], sizes),
                pa.ListArray.from_arrays([0, len(entries)], entries),
            ],
            ["block", "places", "n", "distinct", "langs", "entries"],
        )


def _blocks(df: DataFrame) -> DataFrame:
    """Blocks of texts, in a table bucketed by block: it is read beside others without a shuffle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, SLICE):
                block.add(part.column("lang"), part.column("text"))
                if block.size >= BLOCK:
                    yield block.row(number)
                    block, number = _Block(), number + 1
        if block.places:
            yield block.row(number)

    spark = df.sparkSession
    rows = df.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInArrow(run, BLOCK_SCHEMA)
    name = f"phrase_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with small_batches(spark):
        writer = rows.write.option("path", fresh_path(spark, "phrase-blocks"))
        writer.option("compression", "zstd").bucketBy(buckets, "block").saveAsTable(name)
    return spark.table(name)


def _dealt(blocks: DataFrame, bits: int) -> DataFrame:
    """(bucket, block, start, words): consecutive dictionary entries whose hashes share high bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, entries in zip(batch.column("block").to_pylist(), batch.column("entries")):
                if not len(entries):
                    continue
                langs, words, counts = entries.values.flatten()
                hashes = word_hashes(words.to_pylist())
                buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                starts = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1])
                own = pa.RecordBatch.from_arrays(
                    [langs.dictionary_encode(), words, counts], ["lang", "word", "n"]
                )
                sizes = np.diff(np.append(starts, len(words)))
                packed = [_packed(own.slice(a, n)) for a, n in zip(starts.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(buckets[starts], pa.int32()),
                        pa.array(np.full(len(starts), block)),
                        pa.array(starts, pa.int32()),
                        pa.array(packed, pa.binary()),
                    ],
                    ["bucket", "block", "start", "words"],
                )

    return blocks.select("block", "entries").mapInArrow(
        run, "bucket int, block bigint, start int, words binary"
    )


def _coded(dealt: DataFrame, least: int, budget: int) -> DataFrame:
    """Per bucket of words, a row without a block: its frequent words, which have the codes 1, 2, ...

    And a row for each block: twice the code of each of its entries, 0 for a rare word, and one more for
    a word over the budget.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("start", "ascending")])
        parts = [
            pa.ipc.open_stream(x).read_next_batch() for x in table.column("words").to_pylist()
        ]
        lang = pa.concat_arrays([p.column("lang").dictionary_decode() for p in parts])
        lang, word = (
            x.dictionary_encode() for x in (lang, pa.concat_arrays([p.column("word") for p in parts]))
        )
        n = np.concatenate([p.column("n").to_numpy() for p in parts])
        of_lang = lang.indices.to_numpy().astype(np.int64)
        keys, entry = np.unique(
            of_lang * len(word.dictionary) + word.indices.to_numpy(), return_inverse=True
        )
        f = np.zeros(len(keys), dtype=np.int64)
        np.add.at(f, entry, n)
        often = np.flatnonzero(f >= least)
        code = np.zeros(len(keys), dtype=np.uint32)
        code[often] = (np.arange(1, len(often) + 1) << 1) + (f[often] > budget)
        own = code[entry]
        edges = np.cumsum([0] + [p.num_rows for p in parts])
        codes = [_planes(own[a:b]) for a, b in zip(edges, edges[1:])]
        words = pa.StructArray.from_arrays(
            [
                lang.dictionary.take(pa.array(keys[often] // len(word.dictionary))),
                word.dictionary.take(pa.array(keys[often] % len(word.dictionary))),
                pa.array(f[often]),
            ],
            ["lang", "word", "f"],
        )
        bucket = table.column("bucket")[0].as_py()
        first = [[bucket], [None], [None], [None], pa.ListArray.from_arrays([0, len(words)], words)]
        rest = [table.column("bucket"), table.column("block"), table.column("start"), codes, [None] * len(parts)]
        return pa.concat_tables(
            pa.Table.from_arrays(
                [pa.array(x, f.type) if isinstance(x, list) else x for x, f in zip(columns, CODED)], schema=CODED
            )
            for columns in (first, rest)
        )

    return dealt.groupBy("bucket").applyInArrow(run, CODED_SCHEMA)


class _Text:
    """A block's text in local codes, which are in the order of the codes of the corpus; 0 is an end."""

    def __init__(self, places: bytes, codes: pa.Table, bases: dict[int, int], longest: int):
        at = _flat(places)
        values = np.zeros(int(at.max(initial=0)) + 1, dtype=np.int64)
        wide = np.zeros(len(values), dtype=bool)
        columns = (codes.column(c).to_pylist() for c in ("part", "start", "data"))
        for bucket, start, data in zip(*columns):
            own = _flat(data).astype(np.int64)
            slots = slice(start + 1, start + 1 + len(own))
            values[slots] = np.where(own > 0, (own >> 1) + bases[bucket], 0)
            wide[slots] = own & 1
        order = np.flatnonzero(values)
        order = order[np.argsort(values[order])]
        local = np.zeros(len(values), dtype=np.uint32)
        local[order] = np.arange(1, len(order) + 1, dtype=np.uint32)
        self.code = np.concatenate([[0], values[order]])
        self.wide = np.concatenate([[False], wide[order]])
        self.words = np.concatenate([local[at], np.zeros(longest, np.uint32)])
        #: Where two frequent words follow one another.
        self.pairs = np.flatnonzero((self.words[:-1] > 0) & (self.words[1:] > 0))

    def buckets(self, size: int) -> np.ndarray:
        """Which of ``size`` buckets each pair is in."""
        code = self.code.astype(np.uint64)
        mixed = code[self.words[self.pairs]] * np.uint64(0x9E3779B97F4A7C15)
        mixed += code[self.words[self.pairs + 1]]
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        return (mixed % np.uint64(size)).astype(np.int64)


def _beside(blocks: DataFrame, sent: DataFrame):
    """Blocks, each with what was sent to it."""
    sent = sent.toDF("block", "pairs", "part", "start", "data")  # other columns than those of the blocks
    return blocks.select("block", "places").groupBy("block").cogroup(sent.groupBy("block"))


def _frequent_pairs(
    blocks: DataFrame, codes: DataFrame, bases: dict[int, int], size: int, span: int, least: int
) -> DataFrame:
    """Per block and range of ``span`` buckets: which of its buckets have ``least`` pairs in all blocks."""

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        text = _Text(left.column("places")[0].as_py(), right, bases, 1)
        buckets, counts = np.unique(text.buckets(size), return_counts=True)
        parts = np.unique(buckets // span)
        edges = np.searchsorted(buckets, np.append(parts, parts[-1:] + 1) * span)
        cuts = list(zip(parts.tolist(), edges.tolist(), edges[1:].tolist()))
        return pa.table(
            [
                pa.array([part for part, _, _ in cuts], pa.int32()),
                pa.array([left.column("block")[0].as_py()] * len(cuts), pa.int64()),
                pa.array(
                    [_planes(np.diff(buckets[a:b], prepend=part * span)) for part, a, b in cuts], pa.binary()
                ),
                pa.array([_planes(counts[a:b]) for _, a, b in cuts], pa.binary()),
            ],
            ["part", "block", "steps", "counts"],
        )

    def summed(table: pa.Table) -> pa.Table:
        total = np.zeros(span, dtype=np.int64)
        steps = table.column("steps").to_pylist()
        for own, n in zip(steps, table.column("counts").to_pylist()):
            total[np.cumsum(_flat(own))] += _flat(n)
        often = total >= least
        bits = [np.packbits(often[np.cumsum(_flat(own))]).tobytes() for own in steps]
        packer = zstandard.ZstdCompressor(level=3)
        return pa.table(
            [
                table.column("block"),
                table.column("part"),
                pa.array([packer.compress(x) for x in bits], pa.binary()),
            ],
            ["block", "part", "bits"],
        )

    own = _beside(blocks, codes).applyInArrow(
        counted, "part int, block bigint, steps binary, counts binary"
    )
    return own.groupBy("part").applyInArrow(summed, "block bigint, part int, bits binary")


def _followed(text: _Text, bits: pa.Table, size: int, span: int) -> np.ndarray:
    """Whether the pair that begins at a place may be frequent."""
    followed = np.zeros(len(text.words), dtype=bool)
    of_pair = text.buckets(size)
    buckets = np.unique(of_pair)
    often = np.zeros(len(buckets), dtype=bool)
    for part, data in zip(bits.column("part").to_pylist(), bits.column("data").to_pylist()):
        a, b = np.searchsorted(buckets, [part * span, (part + 1) * span])
        found = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        often[a:b] = np.unpackbits(found, count=b - a)
    followed[text.pairs] = np.isin(of_pair, buckets[often])
    return followed


def _counted(text: _Text, followed: np.ndarray, at: np.ndarray, longest: int) -> tuple:
    """Counts of the distinct suffixes that begin at some places of a text, the suffixes, their cuts."""
    words = np.zeros((len(at), longest + longest % 2), dtype=np.uint32)
    alive = np.ones(len(at), dtype=bool)
    for k in range(longest):
        if k:
            alive &= followed[at + k - 1]
        words[alive, k] = text.words[at[alive] + k]
    keys = [
        words[:, k].astype(np.uint64) << np.uint64(32) | words[:, k + 1]
        for k in range(0, words.shape[1], 2)
    ]
    words = words[np.lexsort(keys[::-1]), :longest]
    starts = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)]))
    counts, words = np.diff(np.append(starts, len(words))), words[starts]
    present = words > 0
    depth = present.sum(axis=1)
    light = present & ~text.wide[words]
    cut = np.where(light.any(axis=1), light.argmax(axis=1) + 1, np.minimum(depth + 1, longest))
    return counts, words, cut


def _group(codes: np.ndarray, cut: np.ndarray, groups: int) -> np.ndarray:
    """The group of each prefix of ``cut`` words."""
    mixed = np.zeros(len(codes), dtype=np.uint64)
    for k in range(codes.shape[1]):
        mixed ^= np.where(cut > k, codes[:, k], 0).astype(np.uint64)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(groups)).astype(np.int64)


def _suffixes(
    blocks: DataFrame, sent: DataFrame, bases: dict[int, int], size: int, span: int, groups: int, longest: int
) -> DataFrame:
    """(group, rows): the distinct suffixes that a block has for a group, column by column: how often each
    is there, its ``cut`` and the codes of its words.

    ``cut`` words are the prefix by which a suffix is dealt out; one more than it has if all its
    words are over the budget, since nodes are then above the prefixes of longer suffixes.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, bits = (right.filter(x) for x in (pc.invert(right.column("pairs")), right.column("pairs")))
        text = _Text(left.column("places")[0].as_py(), codes, bases, longest)
        followed = _followed(text, bits, size, span)
        at = np.flatnonzero(followed)
        found = [_counted(text, followed, at[k : k + PART], longest) for k in range(0, len(at), PART)]
        if not found:
            return pa.table([pa.array([], pa.int32()), pa.array([], pa.binary())], ["group", "rows"])
        counts, words, cut = (np.concatenate(x) for x in zip(*found))
        paths = text.code.astype(np.uint32)[words]
        rows = np.column_stack([counts.astype(np.uint32), cut.astype(np.uint32), paths])
        group = _group(paths, cut, groups)
        order = np.argsort(group, kind="stable")
        starts = np.flatnonzero(np.diff(group[order], prepend=-1))
        packed = [_planes(rows[own].T.ravel()) for own in np.split(order, starts[1:])]
        return pa.table(
            [pa.array(group[order[starts]], pa.int32()), pa.array(packed, pa.binary())], ["group", "rows"]
        )

    return _beside(blocks, sent).applyInArrow(run, "group int, rows binary")


def _nodes(suffixes: DataFrame, width: int, longest: int, least: int) -> DataFrame:
    """(path, f): every phrase of two words or more with ``least`` occurrences, from the subtrees of all
    groups.  A path has ``width`` bytes a word.
    """

    def run(table: pa.Table) -> pa.Table:
        parts = [_flat(x).reshape(longest + 2, -1) for x in table.column("rows").to_pylist()]
        n, cut, *codes = np.concatenate(parts, axis=1)
        order = np.lexsort(codes[::-1])
        codes = [x[order] for x in codes]
        cut, n = cut[order], n[order].astype(np.int64)
        changes = np.concatenate([[True], codes[0][1:] != codes[0][:-1]])
        paths, counts = [pa.array([], pa.binary())], [np.zeros(0, np.int64)]
        for k in range(1, longest):  # words are counted already
            changes[1:] |= codes[k][1:] != codes[k][:-1]
            starts = np.flatnonzero(changes)
            sums = np.add.reduceat(n, starts)
            shared = cut[starts] > k + 1  # other groups count this node too
            shown = (codes[k][starts] > 0) & ((sums >= least) | shared)
            rows = starts[shown]
            keys = np.stack([x[rows] for x in codes[: k + 1]], axis=1).astype(">u8")
            keys = keys.view(np.uint8).reshape(len(rows), k + 1, 8)[:, :, 8 - width :]
            flat = pa.py_buffer(np.ascontiguousarray(keys).ravel())
            edges = np.arange(len(rows) + 1, dtype=np.int32) * ((k + 1) * width)
            paths.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(edges), flat]))
            counts.append(sums[shown])
        return pa.table([pa.concat_arrays(paths), pa.array(np.concatenate(counts))], ["path", "n"])

    nodes = suffixes.groupBy("group").applyInArrow(run, "path binary, n bigint")
    return nodes.groupBy("path").agg(F.sum("n").alias("f")).where(F.col("f") >= least)


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), in decimals of 38 digits."""

    def times(x: Column, y: Column) -> Column:
        return x.cast("decimal(19,0)") * y.cast("decimal(19,0)")

    quotient = F.call_function("div", times(a, n) * F.lit(1000).cast("decimal(4,0)"), times(left, right))
    return quotient.cast("bigint")


def collocations(
    df: DataFrame, least: int = 100, longest: int = 5, percent: int = 100, top: int = 2000
) -> DataFrame:
    """Per language its first phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    A-Z count as a-z; a piece ends at one of ``.,;:!?`` or a line end, words at spaces and tabs.  A
    candidate has 2 to ``longest`` words and ``a`` >= ``least`` occurrences; ``l`` and ``r`` are those
    of its two parts at the cut of the lowest ``score``.  A candidate goes if a longer one that contains
    it has ``percent`` % of its occurrences or more.  A null language is ``und``; null and empty texts
    have no words; repeated rows count each; an empty table, or one without a candidate, gives no rows;
    other columns are not read.
    """
    spark = df.sparkSession
    blocks = _blocks(df)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = blocks.agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct")).head()
    groups = max(math.ceil((held.n or 0) / BUDGET), partitions)
    budget = max(1, (held.n or 0) // (groups * SHARE))
    bits = max(1, (max(partitions, (held.distinct or 0) // ENTRIES) - 1).bit_length())
    coded = stored(_coded(_dealt(blocks, bits), least, budget), "phrase-codes")
    frequent = coded.where(F.col("block").isNull()).select("bucket", "words")
    counts = frequent.select(
        "bucket",
        F.size("words").alias("n"),
        F.aggregate("words", F.lit(0).cast("bigint"), lambda t, x: t + x["f"]).alias("f"),
    ).collect()  # one row a bucket
    bases, known, total = {}, 0, 0
    for row in sorted(counts):
        bases[row.bucket] = known
        known, total = known + row.n, total + row.f
    width = max(1, (known.bit_length() + 7) // 8)
    base = spark.createDataFrame(list(bases.items()), "bucket int, base bigint")
    sizes = blocks.select(F.inline("langs")).groupBy("lang").agg(F.sum("n").alias("n"))
    words = stored(
        frequent.join(base, "bucket")
        .select("base", F.posexplode("words").alias("at", "word"))
        .select("word.*", (F.col("base") + F.col("at") + 1).alias("code"))
        .join(sizes, "lang"),
        "phrase-words",
    )
    size = max(1, total // LOAD)
    span = min(PAIRS, math.ceil(size / partitions))
    codes = coded.where(F.col("block").isNotNull()).select(
        "block", F.lit(False).alias("pairs"), F.col("bucket").alias("part"), "start", F.col("codes").alias("data")
    )
    pairs = _frequent_pairs(blocks, codes, bases, size, span, least).select(
        "block", F.lit(True).alias("pairs"), "part", F.lit(0).alias("start"), F.col("bits").alias("data")
    )
    suffixes = _suffixes(blocks, codes.union(pairs), bases, size, span, groups, longest)
    single = F.unhex(F.lpad(F.hex("code"), 2 * width, "0")).alias("path")
    phrases = stored(
        _nodes(suffixes, width, longest, least).union(words.select(single, "f")), "phrases"
    )

    def piece(start: Column | int, size: Column | int) -> Column:
        """``size`` words of a path from word ``start`` on."""
        start = F.lit(start) if isinstance(start, int) else start
        size = F.lit(size) if isinstance(size, int) else size
        return F.substring(F.col("path"), start * width + 1, size * width)

    m = (F.octet_length("path") / width).cast("int")
    candidates = phrases.select("path", F.col("f").alias("a"), m.alias("m")).where("m >= 2")
    parts = candidates.select(
        "path",
        "a",
        F.explode(
            F.flatten(
                F.transform(
                    F.sequence(F.lit(1), F.col("m") - 1),
                    lambda k: F.array(
                        F.struct(k.alias("k"), F.lit(True).alias("left"), piece(0, k).alias("part")),
                        F.struct(k.alias("k"), F.lit(False).alias("left"), piece(k, F.col("m") - k).alias("part")),
                    ),
                )
            )
        ).alias("part"),
    ).select("path", "a", "part.*")
    cuts = stored(parts.join(phrases.withColumnRenamed("path", "part"), "part"), "phrase-cuts")
    inside = (
        cuts.where(F.octet_length("part") >= 2 * width)
        .where(F.col("a").cast("decimal(19,0)") * 100 >= F.col("f").cast("decimal(19,0)") * percent)
        .select(F.col("part").alias("path"))
        .distinct()
    )
    counted = [
        F.max(F.when((F.col("k") == k) & (F.col("left") == side), F.col("f"))).alias(f"{name}{k}")
        for k in range(1, longest)
        for side, name in ((True, "l"), (False, "r"))
    ]
    kept = stored(
        cuts.groupBy("path", "a").agg(*counted).join(inside, "path", "left_anti"), "phrase-kept"
    )
    code = F.conv(F.hex(F.col("word_code")), 16, 10).cast("bigint")
    spelled = (
        kept.select(
            "path",
            F.posexplode(
                F.transform(
                    F.sequence(F.lit(0), (F.octet_length("path") / width).cast("int") - 1),
                    lambda i: piece(i, 1),
                )
            ).alias("at", "word_code"),
        )
        .select("path", "at", code.alias("code"))
        .join(words.drop("f"), "code")
        .groupBy("path")
        .agg(
            F.concat_ws(" ", F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"])).alias("phrase"),
            F.first("lang").alias("lang"),
            F.first("n").alias("n"),
        )
    )
    cut = F.array_min(
        F.filter(
            F.array(
                *(
                    F.when(
                        F.col(f"l{k}").isNotNull(),
                        F.struct(
                            _score(F.col("a"), F.col("n"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"),
                            F.lit(k).alias("k"),
                            F.col(f"l{k}").alias("l"),
                            F.col(f"r{k}").alias("r"),
                        ),
                    )
                    for k in range(1, longest)
                )
            ),
            lambda x: x.isNotNull(),
        )
    )
    scored = kept.join(spelled, "path").select("lang", "phrase", "a", "n", cut.alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = Window.partitionBy("lang", "salt").orderBy(*order)
    first = salted.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranks = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return (
        first.withColumn("rank", ranks.cast("bigint"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
