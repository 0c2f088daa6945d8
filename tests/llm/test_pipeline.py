"""The pipeline against brute force, stage by stage, on its own rows."""

from __future__ import annotations

import random

import public_tokenizers
import pyarrow as pa
import pytest
from test_decontaminate import plain as plain_windows
from test_line_dedup import plain as plain_lines
from test_near_duplicates import families
from test_near_duplicates import plain as plain_groups
from test_packing import check
from tokenizers import Tokenizer

import corpus_pipeline
from sheetspark.llm import language as lg
from sheetspark.llm.common import text_bytes

FOLDER = "/root/testdata/sf0.001"
NAMES = ["language_id", "line_dedup", "near_dedup", "decontamination", "packing"]


@pytest.fixture(scope="module")
def documents(spark):
    """Documents, with copies, repeated lines, passages of the benchmark and texts to reject."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in given.limit(60).collect()]
    rng = random.Random(3)
    texts = families(rng, 12, words=60)
    texts += [rows[i][1].split("\n", 1)[-1] + "\ntail" for i in range(10)]
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").limit(5).collect()]
    texts += [f"some words before {t} and some behind" for t in items]
    texts += [rows[0][1], rows[1][1], "123 ???", "", None, "?", "the and of the"]
    rows += [(1000 + i, t, "en", "src1", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, given.schema)


def run_stage(spark, documents, number):
    """What stages 1 to ``number`` give, written and read again as the pipeline does it."""
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:number]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), f"test-{name}")
    return docs


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_have_their_names_and_columns(spark, documents):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), "test")
        assert docs.schema == documents.schema


def test_each_stage_equals_brute_force(spark, documents):
    before = documents
    rows = rows_of(before)
    net = lg.train(lg.labelled_windows(before))
    tables = net.pair_tables()

    def known(text):
        if not text or not any(c.isalpha() for c in text):
            return False
        return lg.predict(net, *text_bytes(pa.array([text])), tables).max() >= 0.4

    rows = [r for r in rows if known(r[1])]
    first = run_stage(spark, before, 1)
    assert rows_of(first) == rows and len(rows) < before.count()

    cleaned = {d: (gone, text) for d, _, gone, text in plain_lines([r[:2] for r in rows])}
    want = []
    for doc_id, text, lang, source, n in rows:
        gone, left = cleaned[doc_id]
        if gone and not left.strip():
            continue
        want.append((doc_id, left, lang, source, len(left) if gone else n))
    rows = sorted(want, key=str)
    second = run_stage(spark, first, 0)
    second = corpus_pipeline.stored(corpus_pipeline.line_dedup(spark, second, FOLDER), "test")
    assert rows_of(second) == rows

    kept = {d for d, _, _, keep in plain_groups([r[:2] for r in rows], 5, 80) if keep}
    assert 0 < len(kept) < len(rows)
    rows = [r for r in rows if r[0] in kept]
    third = corpus_pipeline.stored(corpus_pipeline.near_dedup(spark, second, FOLDER), "test")
    assert rows_of(third) == rows

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r[0] for r in plain_windows([r[:2] for r in rows], items) if not r[5]}
    assert 0 < len(clean) < len(rows)
    rows = [r for r in rows if r[0] in clean]
    fourth = corpus_pipeline.stored(corpus_pipeline.decontamination(spark, third, FOLDER), "test")
    assert rows_of(fourth) == rows

    pieces = corpus_pipeline.packing(spark, fourth, FOLDER).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check([r[:2] for r in rows], pieces, library, 4096)


def test_edges(spark, documents):
    """Null ids and columns, repeated rows, clashing extra columns, no rows."""
    from pyspark.sql import functions as F

    text = documents.where("length(text) > 500").first().text
    rows = [(None, text, None, None, None), (2005, text, "en", None, 1), (2005, text, "en", None, 1)]
    rows += [(None, None, None, None, None), (2006, "", "en", "s", 0), (2007, text.upper(), "en", "s", 9)]
    few = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    docs = few.withColumn("n", F.lit(1)).withColumn("id", F.lit("x")).withColumn("spans", F.lit(2))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), f"test-{name}")
        assert docs.columns == columns
        if name == "near_dedup":
            ids = [r.doc_id for r in docs.collect()]
            assert len(ids) == len(set(ids))  # of rows that repeat, one stays
    assert corpus_pipeline.packing(spark, docs, FOLDER).count() > 0
    docs = documents.limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), f"test-{name}")
    assert corpus_pipeline.packing(spark, docs, FOLDER).count() == 0


def test_near_copies_under_one_id_or_none(spark, documents):
    """One document of each group stays, even if near copies share the smallest id."""
    from pyspark.sql import functions as F

    rng = random.Random(9)
    bases = [[f"b{b}x{i}" for i in rng.sample(range(900), 80)] for b in range(6)]

    def copies(base, many):
        return [" ".join([*bases[base], f"end{k}"]) for k in range(many)]

    ids = [None, None, 7, 7, 8, 9]  # two groups without an id, two under one id, two under several
    rows = [(ids[b], t, "en", f"g{b}", 1) for b in range(6) for t in copies(b, 5)]
    rows += [(20 + b, t.upper(), "en", f"g{b}", 1) for b in range(6) for t in copies(b, 3)]
    rows += [(7, bases[2][0], "en", "one", 1), (None, "", "en", "no words", 1), (7, None, "en", "null", 1)]
    rows += rows[:9]
    docs = spark.createDataFrame(rows, documents.schema)
    for parts in (1, 7):
        kept = rows_of(corpus_pipeline.near_dedup(spark, docs.repartition(parts), FOLDER))
        assert sorted(r[3] for r in kept) == sorted(
            [*(f"g{b}" for b in range(6)), "no words", "null", "one"]
        )
        assert all(r[0] == ids[int(r[3][1])] for r in kept if r[3][0] == "g")
        hashed = docs.withColumn("version", F.xxhash64("text"))
        for r in kept:
            if r[3][0] == "g":
                same = hashed.where((F.col("source") == r[3]) & F.col("doc_id").eqNullSafe(r[0]))
                assert same.orderBy("version").first().text == r[1]
