"""Secrets in texts: one automaton for all rules, one pass over the bytes.

The rules are mirrored, joined into one minimal automaton and run from the end of
a text to its start; the automaton then stands in an accepting state exactly where
a match begins.  From there a rule's own automaton walks to the longest end.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sheetspark.llm.automaton import (
    BREAK,
    Walker,
    compile_patterns,
    either,
    many,
    mirrored,
    one_of,
    optional,
    scan,
    seq,
    some,
    times,
    word,
)
from sheetspark.llm.common import id_text, text_bytes


@dataclass(frozen=True)
class Rule:
    """A kind of secret; a match of fewer than ``least`` characters is dropped.

    ``assigned``: only the value behind the separator is measured.
    """

    kind: str
    pattern: tuple
    least: int = 0
    assigned: bool = False


ALNUM = "A-Za-z0-9"
VALUE = ALNUM + "+/_.=-"
_quote, _blank = optional(one_of("\"'")), many(one_of(" "))
_named = either(
    word("password", True),
    word("passwd", True),
    word("secret", True),
    word("token", True),
    seq(word("api", True), optional(one_of("_")), word("key", True)),
)
_url_part = one_of(ALNUM + "_-")

# The formats of well-known credentials.
BASE_RULES = (
    Rule(
        "assign",
        seq(_named, _quote, _blank, one_of(":="), _blank, _quote, some(one_of(VALUE))),
        6,
        assigned=True,
    ),
    Rule("access", seq(word("AKIA"), some(one_of("A-Z0-9"))), 20),
    Rule("hex", seq(times(one_of("0-9a-f"), 24), many(one_of("0-9a-f"))), 24),
)
MORE_RULES = (
    Rule("github", seq(word("gh"), one_of("pousr"), word("_"), some(one_of(ALNUM))), 40),
    Rule("slack", seq(word("xox"), one_of("abprs"), word("-"), some(one_of(ALNUM + "-"))), 15),
    Rule("google", seq(word("AIza"), some(_url_part)), 39),
    Rule("stripe", seq(one_of("sr"), word("k_live_"), some(one_of(ALNUM))), 32),
    Rule(
        "jwt",
        seq(word("eyJ"), some(_url_part), word("."), some(_url_part), word("."), some(_url_part)),
        40,
    ),
    Rule(
        "private_key",
        seq(word("-----BEGIN "), many(one_of("A-Z ")), word("PRIVATE KEY-----")),
    ),
    Rule("bearer", seq(word("bearer ", True), some(one_of("~" + VALUE))), 27),
)
RULES = BASE_RULES + MORE_RULES


class SecretScanner:
    """Finds the spans of all rules in batches of texts."""

    def __init__(self, rules=RULES):
        self.rules = rules
        self.starts = compile_patterns([mirrored(r.pattern) for r in rules], anywhere=True)
        self.walkers = [Walker(compile_patterns([r.pattern], anywhere=False)) for r in rules]

    def spans(self, flat: np.ndarray, offsets: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """For each text with a span: its (start, rule, end) in code points, sorted.

        Matches of a rule are taken leftmost first and do not overlap; one that is too short
        is dropped after it has used up its bytes.
        """
        size, texts = len(flat), len(offsets) - 1
        joined = np.full(size + texts, BREAK, dtype=np.uint8)
        for i in range(texts):
            joined[offsets[i] + i : offsets[i + 1] + i] = flat[offsets[i] : offsets[i + 1]]
        places, bits = scan(self.starts, joined[::-1])
        places, bits = (len(joined) - 1 - places)[::-1], bits[::-1]
        begins = offsets[:-1] + np.arange(texts)
        owner = np.searchsorted(begins, places, side="right") - 1
        found: dict[int, list[tuple[int, int, int]]] = {}
        edges = np.flatnonzero(np.diff(owner)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(owner)]) if len(owner) else ():
            text = int(owner[lo])
            data = flat[offsets[text] : offsets[text + 1]].tobytes()
            inside = self._of_text(data, places[lo:hi] - begins[text], bits[lo:hi])
            if inside:
                found[text] = _in_code_points(data, inside)
        return found

    def _of_text(self, data: bytes, places: np.ndarray, bits: np.ndarray):
        inside = []
        for number, rule in enumerate(self.rules):
            starts = places[(bits >> number) & 1 == 1].tolist()
            i = 0
            while i < len(starts):
                start = starts[i]
                end = self.walkers[number].longest(data, start)
                length = end - (_value_start(data, start) if rule.assigned else start)
                if length >= rule.least:
                    inside.append((start, number, end))
                i = bisect_left(starts, end, i + 1)
        return sorted(inside)


def _value_start(data: bytes, start: int) -> int:
    """Where the value of an assignment begins: after the first separator and what may follow."""
    at = start
    while data[at] not in b":=":
        at += 1
    at += 1
    while data[at] == 0x20:
        at += 1
    return at + (data[at] in b"\"'")


def _in_code_points(data: bytes, spans):
    if data.isascii():
        return spans
    lead = (np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])
    return [(int(before[s]), k, int(before[e])) for s, k, e in spans]


def _joined(spans, rules) -> str:
    return ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in spans)


def find_secrets(df: DataFrame) -> DataFrame:
    """Per row of ``df``: counts of the base kinds, a digest of their spans, and all spans.

    ``spans`` is ``kind:start:end`` by start, then kind in the order of the rules, joined by
    commas; offsets are code points, the end is exclusive.  A null or empty text has no spans:
    zero counts, the digest of nothing and an empty string.  Repeated rows are scanned each;
    other columns are not read.  A text of any length is scanned whole.
    """
    base = len(BASE_RULES)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = SecretScanner()
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            flat, offsets = text_bytes(batch.column("text"))
            rows = batch.num_rows
            counts = np.zeros((rows, base), dtype=np.int64)
            digests, spans = [nothing] * rows, [""] * rows
            for row, inside in scanner.spans(flat, offsets).items():
                own = [x for x in inside if x[1] < base]
                for _, kind, _ in own:
                    counts[row, kind] += 1
                digests[row] = hashlib.sha256(_joined(own, RULES).encode()).hexdigest()
                spans[row] = _joined(inside, RULES)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array(counts[:, k]) for k in range(base)),
                    pa.array(digests),
                    pa.array(spans),
                ],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return id_text(df).mapInArrow(
        run,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint,"
        " base_sha256 string, spans string",
    )
