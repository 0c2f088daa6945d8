"""Token counts by byte-pair merging with a heap and a linked list.

The library reads the vocabulary file; the counting is done here and makes no
identifiers: a text has as many tokens as initial symbols minus merges.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sheetspark.llm.common import id_text

SPACE = "▁"
#: Distinct chunks whose counts a worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000


def merge_count(symbols: list[str], ranks: dict[str, int], pieces: list[str]) -> int:
    """How many merges a sequence of symbols undergoes.

    The heap holds adjacent pairs by rank, then place, each as one integer; neighbours
    are linked by index.  An entry is stale when the pair at its place reads differently
    now (a merged right symbol is empty, and its left neighbour's link skips it).
    """
    get = ranks.get
    heap = []
    left = symbols[0]
    for i, right in enumerate(symbols[1:]):
        rank = get(left + right)
        if rank is not None:
            heap.append(rank << 32 | i)
        left = right
    if not heap:
        return 0
    heapify(heap)
    last = len(symbols)
    following = list(range(1, last + 1))
    before = list(range(-1, last - 1))
    symbols.append("")
    merges = 0
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFF
        pair = pieces[top >> 32]
        j = following[i]
        if j == last or not symbols[i] or symbols[i] + symbols[j] != pair:
            continue
        symbols[i], symbols[j] = pair, ""
        following[i] = after = following[j]
        merges += 1
        if after != last:
            before[after] = i
            rank = get(pair + symbols[after])
            if rank is not None:
                heappush(heap, rank << 32 | i)
        previous = before[i]
        if previous >= 0:
            rank = get(symbols[previous] + pair)
            if rank is not None:
                heappush(heap, rank << 32 | previous)
    return merges


class PieceCounter(dict):
    """Token counts of chunks, computed on first use.

    Two characters that are adjacent in no piece are never merged, so a text is cut
    between them and each part counted alone; the same parts return again and again.
    """

    def __init__(self, model: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = library.get_piece_size()
        normal = [
            (library.id_to_piece(i), library.get_score(i))
            for i in range(size)
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))
        ]
        ordered = sorted(range(len(normal)), key=lambda k: -normal[k][1])
        self.pieces = [normal[k][0] for k in ordered]
        self.ranks = {piece: rank for rank, piece in enumerate(self.pieces)}
        self.adjacent = {p[i : i + 2] for p in self.ranks for i in range(len(p) - 1)}
        if any(c not in self.ranks for piece in self.ranks for c in piece):
            raise ValueError("a piece has a character that is no piece: counts would not add up")
        if any(c != SPACE and pair[1] == SPACE for pair in self.adjacent for c in pair[0]):
            raise ValueError("a piece has a space after another character")
        inside = {c for piece in self.ranks for c in piece}
        newline = "" if "\n" in inside else "\n"
        self.simple = re.compile(f"{SPACE}?[^{SPACE}{newline}]+")
        self.general = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.newline = newline
        self.parts: dict[str, int] = {}

    def part(self, part: str) -> int:
        found = self.parts.get(part)
        if found is None:
            ranks = self.ranks
            found = len(part)
            if not ranks.keys() >= set(part):  # such a character is spelled in bytes
                found += sum(len(c.encode()) - 1 for c in part if c not in ranks)
            if len(part) > 1:
                found -= merge_count(list(part), ranks, self.pieces)
            if len(self.parts) >= REMEMBERED:
                self.parts.clear()
            self.parts[part] = found
        return found

    def __missing__(self, chunk: str) -> int:
        total, start = 0, 0
        for i in range(1, len(chunk)):
            if chunk[i - 1 : i + 1] not in self.adjacent:
                total += self.part(chunk[start:i])
                start = i
        total += self.part(chunk[start:])
        if len(chunk) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = total
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = SPACE + text.replace(" ", SPACE)
        if text[-1] == SPACE or 2 * SPACE in text or f"{SPACE}\n" in text:
            return sum(map(self.__getitem__, self.general.findall(text)))
        lines = text.count("\n") if self.newline else 0
        return lines + sum(map(self.__getitem__, self.simple.findall(text)))


def count_tokens(df: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    Counts equal the sentencepiece library's for the BPE ``model`` with its default
    handling of spaces and byte fallback, without begin or end tokens; strings such as
    ``</s>`` inside a text are plain text.  A null or empty text has no bytes and no
    tokens; repeated rows are counted each; other columns of ``df`` are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model)
        for batch in batches:
            texts = batch.column("text")
            counts = pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pc.binary_length(texts).cast(pa.int64()),
                    counts,
                    pc.greater(counts, limit),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return id_text(df).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
