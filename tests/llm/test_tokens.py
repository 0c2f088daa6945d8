"""Token counts against the library that owns the vocabulary file."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from sheetspark.llm import tokens
from sheetspark.llm.tokens import PieceCounter, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [
    "▁", " ", "  ", "\n", "a", "b", "the", "é", "日", "\x00", "\t", "<s>", "</s>", "<unk>", "𝄞",
    "<0x0A>", "1", ".", " x", "er", "in", "ting", "\r", "\xa0", "​", "tion", "é",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_random_texts(library):
    counter, rng = PieceCounter(MODEL), random.Random(3)
    for _ in range(15_000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 12)))
        assert counter.count(text) == len(library.encode(text)), repr(text)


def test_documents(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
    for r in count_tokens(df, MODEL).collect():
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library.encode(text)))
        assert r.over_limit == (r.n_tokens > 4096)


def test_edges(spark, library, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    long = "word " * 30_000 + "x" * 5_000
    rows = [(1, None, 5), (2, "", 6), (None, "a a", 7), (4, long, 8), (4, long, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, MODEL).collect()}
    n = len(library.encode(long))
    assert got == {(1, 0, 0, False), (2, 0, 0, False), (None, 3, 2, False), (4, 155_000, n, True)}
    assert count_tokens(df, MODEL).count() == 5
    assert count_tokens(df.limit(0), MODEL).count() == 0
