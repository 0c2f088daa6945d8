"""Ids and bytes against the tiktoken library."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from sheetspark.llm import byte_bpe
from sheetspark.llm.byte_bpe import decode, digests, encode, encode_word, read_ranks

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = [
    "a", "b", " the", "é", "日本", "\x00", "\t", "\n", "  ", "<|endoftext|>", "'s", "'ll", "12", ".",
    "ing", "\r\n", "\xa0", "​", "　", "𝄞", "½", "²", "ß", "\x1c", "\x85", "é", "!!!",
]


@pytest.fixture(scope="module")
def library():
    ranks = read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_words(library):
    ranks, rng = read_ranks(PATH), random.Random(11)
    for _ in range(5_000):
        word = "".join(rng.choices(PARTS, k=rng.randint(1, 14))).encode()
        assert encode_word(word, ranks) == library._encode_single_piece(word)


def test_long_word(library):
    ranks, rng = read_ranks(PATH), random.Random(12)
    word = "".join(rng.choices("abcdefghi", k=60_000)).encode()
    assert encode_word(word, ranks) == library._encode_single_piece(word)


def test_every_character_is_cut_alike(library):
    """Two Unicode tables meet here: each character next to a letter, a digit and a space."""
    import regex

    cut, ranks = regex.compile(PATTERN).findall, read_ranks(PATH)
    known = {}
    for start in range(0, 0x110000, 64):
        points = [c for c in range(start, start + 64) if not 0xD800 <= c <= 0xDFFF]
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}b" for c in points)
        ids = []
        for word in cut(text):
            if word not in known:
                known[word] = encode_word(word.encode(), ranks)
            ids += known[word]
        assert ids == library.encode_ordinary(text), hex(start)


def check(df, library):
    rows = df.select("doc_id", "text").collect()
    want = []
    for row in rows:
        ids = library.encode_ordinary(row.text or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append(
            (row.doc_id, len(ids), hashlib.sha256(packed).hexdigest(),
             hashlib.sha256((row.text or "").encode()).hexdigest())
        )
    got = [tuple(r) for r in digests(decode(encode(df, PATH, PATTERN), PATH)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_documents(spark, library):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), library)


def test_small_blocks_and_buckets(spark, library, monkeypatch):
    """Many blocks, many buckets: words meet from everywhere, and blocks get their own back."""
    monkeypatch.setattr(byte_bpe, "BLOCK", 3_000)
    monkeypatch.setattr(byte_bpe, "SLICE", 700)
    monkeypatch.setattr(byte_bpe, "BUCKET", 50)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5), library)


def test_edges(spark, library):
    rng = random.Random(13)
    odd = "".join(rng.choices(PARTS, k=20_000))
    long = "word " * 30_000 + "x" * 5_000
    rows = [(1, None, 5), (2, "", 6), (None, "a a", 7), (None, None, 8), (4, long, 8), (4, long, 8), (5, odd, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    check(df, library)
    check(df.where("doc_id < 3"), library)
    check(df.limit(0), library)


def test_decode_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [0, 5])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in decode(df, PATH).collect()}
    tokens = {rank: token for token, rank in read_ranks(PATH).items()}
    assert got == {1: None, 2: b"", 3: tokens[0] + tokens[5]}
