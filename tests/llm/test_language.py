"""The byte network: gradients, held-out accuracy, edges."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from sheetspark.llm import language as lg
from sheetspark.llm.common import text_bytes

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def net(documents):
    return lg.train(lg.labelled_windows(documents))


def test_held_out_accuracy(documents, net):
    rows = lg.identify_language(documents, net).collect()
    known = {r.doc_id: (r.lang, r.text) for r in documents.collect()}
    assert len(rows) == len(known)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id][0] for r in held) / len(held) > 0.97


def test_sample_is_bounded_and_leaves_held_out_rows(spark, documents):
    sample = lg.labelled_windows(documents, per_label=20, windows=1)
    assert 0 < len(sample) <= 2 * 20 * len({label for _, label in sample})
    held = documents.where(lg.is_held_out(documents["doc_id"]))
    assert lg.labelled_windows(held) == []
    assert lg.train([]) is None


def test_every_window_counts(net):
    """A text's probabilities are the mean over windows that cover all of its bytes."""
    text = ("the and of " * 200 + "und der die nicht ist ein " * 300)[:5000]
    tables = net.pair_tables()
    flat, offsets = text_bytes(pa.array([text, "x" * lg.WINDOW, "", "the"]))
    got = lg.predict(net, flat, offsets, tables)
    data = text.encode()
    parts = [data[i : i + lg.WINDOW] for i in range(0, max(1, len(data) - 3), lg.STRIDE)]
    want = np.zeros(len(net.labels))
    for part in parts:
        x = np.zeros((1, lg.WINDOW), dtype=np.int64)
        x[0, : len(part)] = lg.CLASSES[np.frombuffer(part, dtype=np.uint8)]
        want += net.probabilities(x, tables)[0] * len(part)
    assert np.allclose(got[0], want / len(data), atol=1e-5)
    assert got.shape == (4, len(net.labels))


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = lg.ByteNet.fresh(["a", "b", "c"], 4, rng)
    x = rng.integers(0, lg.KINDS, (6, lg.WINDOW))
    y, weight = np.array([0, 1, 2, 0, 1, 2]), np.ones(6, np.float32)

    def loss():
        p = net.probabilities(x, net.pair_tables())
        return -np.log(p[np.arange(6), y]).mean()

    for p, g in zip(net.parameters(), lg._gradients(net, x, y, weight)):
        cell = np.unravel_index(np.abs(g).argmax(), g.shape)
        base = p[cell]
        p[cell] = base + 1e-2
        up = loss()
        p[cell] = base - 1e-2
        down = loss()
        p[cell] = base
        assert abs((up - down) / 2e-2 - g[cell]) < 0.05 * abs(g[cell]) + 1e-3


def test_edges(spark, documents, net):
    german = documents.where("lang = 'de' and length(text) > 3000").orderBy("doc_id").first().text
    long = german * (150_000 // len(german) + 1)
    rows = [
        (1, None, "en", 1.0), (2, "", "en", 1.0), (3, "123 !?", "de", 1.0),
        (None, "the and of that", None, 1.0), (5, long, "xx", None),
        (5, long, "xx", None),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = lg.identify_language(df, net).collect()
    assert len(got) == 6
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (1, 2, 3))
    assert by_id[None].lang_pred == "en" and by_id[None].held_out is False
    assert by_id[5].lang_pred == "de"
    assert {r.lang_pred for r in lg.identify_language(df, None).collect()} == {"und"}
    assert lg.identify_language(df.limit(0), net).count() == 0
    assert lg.labelled_windows(df.limit(0)) == []


def test_labels_beyond_the_bound_are_not_learned(spark):
    """The most frequent labels are learned, and every text is predicted."""
    many = {"de": 40, "en": 60, "fr": 40, "es": 40, **{f"typo{i:03}": 1 + i % 2 for i in range(520)}}
    labels = [label for label, n in many.items() for _ in range(n)]
    rows = [(4 * i, f"text {i} of {label}", label) for i, label in enumerate(labels)]
    free = [(i, t, x) for i, t, x in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    times = {x: sum(r[2] == x for r in free) for x in many}
    ranked = sorted((x for x in many if times[x]), key=lambda x: (-times[x], x))
    assert len(ranked) > 350
    sample = lg.labelled_windows(df, most_labels=3)
    assert {x for _, x in sample} == set(ranked[:3])
    assert sorted(sample) == sorted((t.encode(), x) for _, t, x in free if x in ranked[:3])
    got = lg.identify_language(df, lg.train(sample)).collect()
    assert len(got) == len(rows) and {r.lang_pred for r in got} <= set(ranked[:3])


def plain_chances(net, text):
    """Convolution, pooling and softmax of the whole text, written out filter by filter."""
    data = text.encode()
    total = np.zeros(len(net.labels))
    for start in range(0, max(1, len(data) - max(lg.WIDTHS) + 1), lg.STRIDE):
        part = data[start : start + lg.WINDOW]
        classes = [int(lg.CLASSES[b]) for b in part] + [0] * (lg.WINDOW - len(part))
        pooled = []
        for width, weights in zip(lg.WIDTHS, net.filters):
            for k in range(weights.shape[2]):
                sums = [
                    sum(float(weights[j, classes[i + j], k]) for j in range(width))
                    for i in range(lg.WINDOW - width + 1)
                ]
                pooled.append(max(sums))
        hidden = np.maximum(np.array(pooled) + net.shift, 0)
        logits = hidden @ net.dense.astype(float) + net.bias
        chances = np.exp(logits - logits.max())
        total += chances / chances.sum() * len(part)
    return total / max(1, len(data))


def test_predictions_equal_a_plain_forward_pass(net):
    texts = ["the cat", "und der die das " * 30, "é" * 150 + " xyz", "1 2 3"]
    flat, offsets = text_bytes(pa.array(texts))
    got = lg.predict(net, flat, offsets, net.pair_tables())
    for row, text in zip(got, texts):
        assert np.allclose(row, plain_chances(net, text), atol=1e-4)


def test_numerals_and_marks_are_no_letters(spark, net):
    texts = ["½ ² ²", "① Ⅷ 3", "́ _ -", "x ½", "日", "ǅ", "ª"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in lg.identify_language(df, net).collect()}
    for i, text in enumerate(texts):
        lettered = any(c.isalpha() for c in text)
        assert (got[i] != ("und", 0.0)) == lettered
    kept = {r.doc_id for r in lg.with_known_language(df, net, least=0.0).collect()}
    assert kept == {3, 4, 5, 6}
