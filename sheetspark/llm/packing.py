"""Documents packed into token sequences along a space-filling curve.

A document's tokens are hashed into a vector of a few dimensions; documents are ordered by their
place on a Hilbert curve through that space, so neighbours on the curve have similar words.  The
ordered stream of tokens is cut into full sequences.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, takewhile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.common import plain_id, slices, solid_id, stored
from sheetspark.llm.hilbert import cells, hilbert_keys

#: Tokens of a sequence, and the id that ends a document.
LENGTH, END = 4096, 2
#: Dimensions and bits of the curve.
DIMENSIONS, BITS = 4, 12
#: Distinct words whose ids a worker remembers; beyond it the memory starts anew.
REMEMBERED = 300_000
#: Letters of which normalizing changes only the case, and that next to one another stay together.
LETTERS = "a-zß-öø-ÿ"
#: Texts are encoded in slices of about so many bytes.
SLICE = 1 << 22


class WordEncoder:
    """Ids of texts as the tokenizers library gives them, remembering words.

    The normalizer, the splitting and the merges of the vocabulary never look across white space,
    so the ids of a text are those of its words.  A text with the string of an added token is one
    word.  A word of LETTERS is one piece of the splitting, so its ids are those that the library's
    model gives for its bytes; all others go through the whole library.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size()
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        letters = "".join(c for c in map(chr, range(256)) if re.fullmatch(f"[{LETTERS}]", c))
        pieces = self.library.pre_tokenizer.pre_tokenize_str
        self.whole = self.library.normalizer.normalize_str(letters) == letters and len(pieces(letters)) == 1
        self.signs = {ord(c): pieces(c)[0][0] for c in letters}
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # What an added token begins with before its first letter is the same in either case.
        self.stems = {"".join(takewhile(lambda c: c.lower() == c.upper(), t)) for t in self.added}
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.starts = np.zeros(1, dtype=np.int64)
        self.flat = np.zeros(0, dtype=self.kind)

    def _learn(self, words: list[str]) -> None:
        merge, plain = self.library.model.tokenize, re.compile(f"[{LETTERS}]+").fullmatch
        one = [self.whole and plain(w) is not None for w in words]
        rest = [w for w, whole in zip(words, one) if not whole]
        others = iter(self.library.encode_batch_fast(rest, add_special_tokens=False))
        ids = [
            [t.id for t in merge(w if w.isascii() else w.translate(self.signs))] if whole else next(others).ids
            for w, whole in zip(words, one)
        ]
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        values = np.fromiter(chain.from_iterable(ids), dtype=self.kind, count=int(sizes.sum()))
        first = len(self.slots)
        self.slots.update(zip(words, range(first, first + len(words))))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, values])

    def _marked(self, texts: pa.Array) -> pa.Array:
        """Whether a text has the string of an added token."""
        marks = pa.array(np.zeros(len(texts), dtype=bool))
        if not any(pc.any(pc.match_substring(texts, stem)).as_py() for stem in self.stems):
            return marks
        for added in self.added:
            marks = pc.or_(marks, pc.match_substring(texts, added, ignore_case=True))
        return marks

    def _words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts, and how many each text has."""
        marks = self._marked(texts)
        if pc.any(marks).as_py():
            pairs = zip(texts.to_pylist(), marks.to_pylist())
            lists = [[t] if whole else re.split("[ \t-\r]+", t) for t, whole in pairs]
            lists = pa.array(lists, pa.list_(pa.string()))
        else:
            # A space between a letter and a sign changes no id, and the same words return more often.
            lists = pc.ascii_split_whitespace(
                pc.replace_substring_regex(texts, "([A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?])", "\\1 \\2")
            )
        return lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)

    @staticmethod
    def _lowered(words: pa.Array) -> pa.Array:
        """ASCII words and those of LETTERS in lower case, which changes none of their ids."""
        plain = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
        words = pc.if_else(plain, pc.ascii_lower(words), words)
        letters = pc.match_substring_regex(words, f"^[{LETTERS}A-ZÀ-ÖØ-Þ]+$")
        return pc.if_else(letters, pc.utf8_lower(words), words)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and how many each text has."""
        if len(self.slots) > REMEMBERED:
            self._forget()
        words, counts = self._words(texts)
        coded = words.dictionary_encode()
        distinct = self._lowered(coded.dictionary).to_pylist()
        self._learn(list(dict.fromkeys(w for w in distinct if w not in self.slots)))
        known = np.fromiter(map(self.slots.__getitem__, distinct), np.int64, len(distinct))
        slots = known[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.int64)
        sizes = self.starts[slots + 1] - self.starts[slots]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        index = np.arange(ends[-1]) + np.repeat(self.starts[slots] - ends[:-1], sizes)
        edges = np.concatenate([[0], np.cumsum(counts)])
        return self.flat[index], np.diff(ends[edges])


def _projection(size: int) -> np.ndarray:
    """What a token id adds to each dimension."""
    return np.random.default_rng(9).normal(size=(size, DIMENSIONS)).astype(np.float32)


def _keys(ids: np.ndarray, counts: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """The Hilbert key of each document; every document has at least one id."""
    starts = np.cumsum(counts) - counts
    vectors = np.add.reduceat(projection[ids], starts, axis=0).astype(np.float64)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return hilbert_keys(cells(vectors, -1.0, 1.0, BITS), BITS)


def tokenized(df: DataFrame, path: str) -> DataFrame:
    """(id, key, n, ids): the ids of each row's text and its end, little-endian, and their key."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        projection = _projection(max(encoder.size, END + 1))
        for batch in batches:
            for part in slices(batch, SLICE):
                ids, counts = encoder.encode(part.column("text"))
                ids = np.insert(ids, np.cumsum(counts), END)
                counts = counts + 1
                edges = np.concatenate([[0], np.cumsum(counts)]) * ids.itemsize
                packed = pa.Array.from_buffers(
                    pa.large_binary(),
                    len(counts),
                    [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(ids)],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(_keys(ids, counts, projection)),
                        pa.array(counts.astype(np.int64)),
                        packed.cast(pa.binary()),
                    ],
                    ["id", "key", "n", "ids"],
                )

    rows = df.select(
        solid_id(F.col("doc_id")).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(run, "id bigint, key bigint, n bigint, ids binary")


def _placed(tokens: DataFrame) -> DataFrame:
    """(row, part, before): tokens before each row in its part of the ordered stream."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            sizes = batch.column("n").to_numpy()
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.full(len(sizes), part, dtype=np.int64)),
                    pa.array(ends - sizes),
                    pa.array(ends),
                ],
                ["row", "part", "before", "upto"],
            )
            before = int(ends[-1]) if len(ends) else before

    ordered = (
        tokens.select("row", "key", "id", "n")
        .repartitionByRange("key", "id", "row")
        .sortWithinPartitions("key", "id", "row")
    )
    return ordered.mapInArrow(run, "row bigint, part bigint, before bigint, upto bigint")


def sequence_bounds(total: int, length: int) -> tuple[int, np.ndarray]:
    """How many full sequences a stream has, and where the others end.

    What is left behind the full ones becomes sequences of powers of two, which need no padding.
    """
    full, rest = divmod(total, length)
    sizes = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return full, full * length + np.cumsum([0, *sizes])


def _cuts(start: int, size: int, full: int, tail: np.ndarray, length: int):
    """(from, to, sequence, offset) of the pieces of tokens [start, start + size) of the stream."""
    at, end = start, start + size
    while at < end:
        if at < full * length:
            sequence, offset = divmod(at, length)
            stop = at - offset + length
        else:
            k = int(np.searchsorted(tail, at, side="right")) - 1
            sequence, offset, stop = full + k, at - int(tail[k]), int(tail[k + 1])
        stop = min(stop, end)
        yield at - start, stop - start, sequence, offset
        at = stop


def pack(df: DataFrame, path: str, length: int = LENGTH) -> DataFrame:
    """Per piece of a document: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id`` and ``offset``.

    A document is the ids of its text by the tokenizers file at ``path`` without added special
    tokens, and the id 2; a null or empty text has only that.  Documents follow one another by
    their place on the curve, then doc_id (null first); sequence k holds tokens k * length onwards
    of that stream.  Nothing is padded: what is left at the end makes sequences of powers of two.
    Rows that repeat are documents of their own; other columns are not read.
    """
    tokens = stored(
        tokenized(df, path).withColumn("row", F.monotonically_increasing_id()), "pack-tokens"
    )
    placed = stored(_placed(tokens), "pack-places")
    sums = placed.groupBy("part").agg(F.max("upto").alias("n")).collect()  # one row a part
    bases, total = {}, 0
    for row in sorted(sums):
        bases[row.part] = total
        total += row.n
    full, tail = sequence_bounds(total, length)
    kind = WordEncoder(path).kind

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("id", "n", "part", "before", "ids")]
            for doc_id, n, part, before, data in zip(*columns):
                wide = np.frombuffer(data, dtype=kind).astype("<u4")
                for a, b, sequence, offset in _cuts(bases[part] + before, n, full, tail, length):
                    out.append((doc_id, a, b - a, zlib.crc32(wide[a:b]), n, sequence, offset))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in zip(*out)], list(names)
                )

    pieces = tokens.join(placed, "row").select("id", "n", "part", "before", "ids")
    return pieces.mapInArrow(
        run,
        "id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
        " sequence_id bigint, offset bigint",
    ).select(
        plain_id(F.col("id")).alias("doc_id"),
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
    )
