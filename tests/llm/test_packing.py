"""Packing: ids against the library, an exact round trip, little padding, the curve."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sheetspark.llm import packing
from sheetspark.llm.hilbert import cells, hilbert_keys
from sheetspark.llm.packing import WordEncoder, pack

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "a", "B", "É", "J̌", "é", "\x1c",
    "\x85", "\xa0", " ", "\n", "\x0b", "日本", "'s", "'S", "1", "23", "!!", "<|", "|>", "İ", "Σ",
    "ΑΣ", " ", "́", "ﬁ", "\x00", "ǅ", ".", ",", "x.", "Word,",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_library(library):
    encoder, rng = WordEncoder(PATH), random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 9))) for _ in range(6000)]
    for at in range(0, len(texts), 50):
        part = texts[at : at + 50]
        ids, counts = encoder.encode(pa.array(part, pa.string()))
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in want]
        assert ids.tolist() == [i for x in want for i in x]


class Counted:
    """The library, and the words that went through all of it."""

    def __init__(self, library):
        self.library, self.seen = library, []

    def __getattr__(self, name):
        return getattr(self.library, name)

    def encode_batch_fast(self, words, **how):
        self.seen += words
        return self.library.encode_batch_fast(words, **how)


def test_words_of_letters_need_only_the_merges(library):
    letters = [chr(c) for c in range(0x21, 0x180) if chr(c).isalpha()]
    signs, rng = ["̌", "̈", "'s", "1", ".", ",", ";", "×", "÷"], random.Random(4)
    texts = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(2000)]
    texts += ["".join(rng.choices(letters + signs * 9, k=rng.randint(1, 9))) for _ in range(2000)]
    texts += [f"{a}{b}" for a in letters for b in [*signs, "ş.", "ΐ"]]
    texts += ["Émentier chê. ENTSPRÄCHE,größe ÿ Straße;señor", "naïve café! CAFÉ"]
    encoder = WordEncoder(PATH)
    encoder.library = Counted(library)
    ids, _ = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    encoder.library.seen.clear()
    encoder.encode(pa.array(["Bärig, émentierx! Foo. blaéx: größex"]))
    assert set(encoder.library.seen) <= {",", "!", ".", ":"}


def check(rows, pieces, library, length):
    """Every id is in one piece, sequences have no gap, and only powers of two are short."""
    ids = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]
    wanted = sorted(
        ((d, len(x), zlib.crc32(np.array(x, dtype="<u4"))) for d, x in ids), key=str
    )
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    total = sum(len(x) for _, x in ids)
    assert sum(p.length for p in pieces) == total
    tokens = {}
    for d, x in ids:
        tokens.setdefault((d, len(x)), []).append(x)
    for key, parts in by_doc.items():
        for p in parts:
            assert any(
                zlib.crc32(np.array(x[p.start : p.start + p.length], dtype="<u4")) == p.ids_crc32
                for x in tokens[key]
            )
        spans = sorted((p.start, p.start + p.length) for p in parts)
        copies = len(tokens[key])
        assert sum(b - a for a, b in spans) == copies * key[1]
        if copies == 1:
            assert [a for a, _ in spans] == [0] + [b for _, b in spans[:-1]]
    filled = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == filled.get(p.sequence_id, 0)
        filled[p.sequence_id] = p.offset + p.length
    assert sorted(filled) == list(range(len(filled)))
    assert all(n == length or n < length and n & (n - 1) == 0 for n in filled.values())
    assert wanted


def test_round_trip(spark, library, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    check(rows, pack(df, PATH).collect(), library, 4096)


def test_edges(spark, library):
    rows = [
        (1, None, 1), (2, "", 2), (None, "a b", 3), (4, "word " * 30_000, 4), (5, "x y", 5),
        (5, "x y", 5), (6, "<|endoftext|> z", 6),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    check([r[:2] for r in rows], pack(df, PATH, 64).collect(), library, 64)
    assert pack(df.limit(0), PATH).count() == 0


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = WordEncoder(PATH)
    for n in range(5):
        encoder.encode(pa.array([f"word{n} other{n} more{n}"]))
        assert len(encoder.slots) <= 8


@pytest.mark.parametrize("dims,bits", [(2, 5), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    grid = np.indices((1 << bits,) * dims).reshape(dims, -1).T.astype(np.uint64)
    keys = hilbert_keys(grid, bits)
    assert sorted(keys.tolist()) == list(range(len(grid)))
    path = grid[np.argsort(keys)].astype(int)
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    assert cells(np.array([-2.0, -1.0, 0.0, 1.0]), -1, 1, 4).tolist() == [0, 0, 8, 15]
