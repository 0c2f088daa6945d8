"""Language identification with a convolutional network over bytes, in numpy.

Filters of several widths slide over fixed-length windows of bytes; their maxima feed a
softmax.  Every window of a text is looked at and the probabilities are averaged.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.common import slices, text_bytes

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
STRIDE = WINDOW - max(WIDTHS) + 1
#: Windows that are scored together.
GROUP = 512
#: Texts are scored in slices of about so many bytes.
SLICE = 1 << 20

LETTER = regex.compile(r"\p{L}")


def _byte_classes() -> np.ndarray:
    """Padding 0, letters without case, white space, digits, other ASCII, each byte from 128."""
    classes = np.full(256, 29, dtype=np.int64)
    for i in range(26):
        classes[ord("a") + i] = classes[ord("A") + i] = 1 + i
    classes[[ord(c) for c in " \t\n\r\x0b\x0c"]] = 27
    classes[ord("0") : ord("9") + 1] = 28
    classes[128:] = np.arange(30, 158)
    return classes


CLASSES = _byte_classes()
KINDS = int(CLASSES.max()) + 1
NARROW = CLASSES.astype(np.int32)


@dataclass
class ByteNet:
    """``filters[i][k]``: what a byte class adds at place k of the filters of width i."""

    labels: list[str]
    filters: list[np.ndarray]
    shift: np.ndarray
    dense: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, labels: list[str], filters: int, rng: np.random.Generator) -> ByteNet:
        total = filters * len(WIDTHS)
        return cls(
            labels,
            [rng.normal(0, 0.3, (w, KINDS, filters)).astype(np.float32) for w in WIDTHS],
            np.zeros(total, np.float32),
            rng.normal(0, 0.3, (total, len(labels))).astype(np.float32),
            np.zeros(len(labels), np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [*self.filters, self.shift, self.dense, self.bias]

    def pair_tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width, what two neighbouring bytes add, and what the third or the next two add."""

        def pairs(a, b):
            return (a[:, None, :] + b[None, :, :]).reshape(KINDS * KINDS, -1)

        two, three, four = self.filters
        return [
            (pairs(two[0], two[1]), None),
            (pairs(three[0], three[1]), three[2]),
            (pairs(four[0], four[1]), pairs(four[2], four[3])),
        ]

    def responses(self, x: np.ndarray, tables) -> list[np.ndarray]:
        """Per width: windows x places x filters."""
        pair = x[:, :-1] * KINDS + x[:, 1:]
        (two, _), (three, third), (four, rest) = tables
        out = [np.take(two, pair, axis=0)]
        values = np.take(three, pair[:, :-1], axis=0)
        values += np.take(third, x[:, 2:], axis=0)
        out.append(values)
        values = np.take(four, pair[:, :-2], axis=0)
        values += np.take(rest, pair[:, 2:], axis=0)
        out.append(values)
        return out

    def probabilities(self, x: np.ndarray, tables) -> np.ndarray:
        pooled = np.concatenate([r.max(axis=1) for r in self.responses(x, tables)], axis=1)
        hidden = np.maximum(pooled + self.shift, 0)
        return softmax(hidden @ self.dense + self.bias)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    samples: list[tuple[bytes, str]],
    filters: int = 16,
    rounds: int = 10,
    batch: int = 64,
    rate: float = 0.01,
    seed: int = 7,
) -> ByteNet | None:
    """A network fitted to (bytes, label) samples by Adam; None without samples.

    Samples are cut to random lengths as they come, so that short texts are learned too,
    and labels weigh the same however many samples they have.
    """
    if not samples:
        return None
    rng = np.random.default_rng(seed)
    labels = sorted({label for _, label in samples})
    number = {label: i for i, label in enumerate(labels)}
    x = np.zeros((len(samples), WINDOW), dtype=np.int64)
    size = np.zeros(len(samples), dtype=np.int64)
    for i, (data, _) in enumerate(samples):
        data = np.frombuffer(data[:WINDOW], dtype=np.uint8)
        x[i, : len(data)] = CLASSES[data]
        size[i] = len(data)
    y = np.array([number[label] for _, label in samples])
    weight = (len(y) / len(labels) / np.bincount(y, minlength=len(labels)))[y].astype(np.float32)
    net = ByteNet.fresh(labels, filters, rng)
    means = [np.zeros_like(p) for p in net.parameters()]
    squares = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            cut = rng.uniform(0, 1, len(rows))
            keep = np.where(cut < 0.5, size[rows], np.maximum(4, size[rows] * cut**2)).astype(int)
            part = np.where(np.arange(WINDOW) < keep[:, None], x[rows], 0)
            gradients = _gradients(net, part, y[rows], weight[rows])
            step += 1
            pace = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for p, g, m, s in zip(net.parameters(), gradients, means, squares):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= pace * m / (np.sqrt(s) + 1e-8)
    return net


def _gradients(net: ByteNet, x, y, weight) -> list[np.ndarray]:
    filters = net.filters[0].shape[2]
    responses = net.responses(x, net.pair_tables())
    places = [r.argmax(axis=1) for r in responses]
    pooled = np.concatenate([r.max(axis=1) for r in responses], axis=1) + net.shift
    hidden = np.maximum(pooled, 0)
    slope = softmax(hidden @ net.dense + net.bias)
    slope[np.arange(len(y)), y] -= 1
    slope *= (weight / len(y))[:, None]
    back = (slope @ net.dense.T) * (pooled > 0)
    rows, columns = np.arange(len(x))[:, None], np.arange(filters)[None, :]
    out = []
    for i, width in enumerate(WIDTHS):
        part = back[:, i * filters : (i + 1) * filters].astype(np.float64).reshape(-1)
        gradient = np.empty_like(net.filters[i])
        for k in range(width):
            cell = x[rows, places[i] + k] * filters + columns
            gradient[k] = np.bincount(
                cell.reshape(-1), weights=part, minlength=KINDS * filters
            ).reshape(KINDS, filters)
        out.append(gradient)
    return [*out, back.sum(axis=0), hidden.T @ slope, slope.sum(axis=0)]


def predict(net: ByteNet, flat: np.ndarray, offsets: np.ndarray, tables) -> np.ndarray:
    """Mean probabilities over all windows of each text, weighted by their bytes."""
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-(lengths - (WINDOW - STRIDE)) // STRIDE))
    total = np.zeros((len(lengths), len(net.labels)))
    owner = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = offsets[:-1][owner] + nth * STRIDE
    filled = np.minimum(WINDOW, offsets[1:][owner] - begin)
    flat = flat if len(flat) else np.zeros(1, np.uint8)
    ramp = np.arange(WINDOW)
    for at in range(0, len(owner), GROUP):
        here = slice(at, at + GROUP)
        index = np.minimum(begin[here, None] + ramp, len(flat) - 1)
        x = np.where(ramp < filled[here, None], NARROW[flat[index]], 0)
        share = net.probabilities(x, tables) * filled[here, None]
        np.add.at(total, owner[here], share)
    return total / np.maximum(lengths, 1)[:, None]


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_windows(
    df: DataFrame, per_label: int = 600, windows: int = 2, most_labels: int = 500
) -> list[tuple[bytes, str]]:
    """A bounded sample for training: about ``per_label`` texts of each label, at most
    ``windows`` windows of each.  Of more than ``most_labels`` labels the most frequent are
    learned, of equally frequent ones those that sort first.

    Rows that are held out, or have no id, text or label, are left out.  Which rows and which
    windows are taken depends on the ids alone, not on the partitions.
    """
    rows = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col("lang").cast("string")
    ).where(
        F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull()
        & (F.length("text") > 0)
        & ~is_held_out(F.col("doc_id"))
    )
    frequent = (
        rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_labels)
    )
    counts = {r.lang: r.n for r in frequent.collect()}
    if not counts:
        return []
    span = 1_000_000
    shares = F.create_map(
        *(
            F.lit(x)
            for label, n in sorted(counts.items())
            for x in (label, min(span, -(-span * per_label // n)))
        )
    )
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(span))
    room = F.greatest(F.length("text") - WINDOW + 1, F.lit(1))
    cuts = [
        F.substring("text", (F.pmod(F.xxhash64("doc_id", F.lit(i)), room) + 1).cast("int"), F.lit(WINDOW))
        for i in range(windows)
    ]
    sample = (
        rows.where(draw < shares[F.col("lang")])
        .select("doc_id", "lang", F.explode(F.array_distinct(F.array(*cuts))).alias("part"))
        .limit(2 * per_label * windows * len(counts))
        .collect()
    )
    # Bytes behind a window's end are cut off in training.
    return [(r.part.encode(), r.lang) for r in sorted(sample)]


def identify_language(df: DataFrame, net: ByteNet | None) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``.

    Only the text is an input of the prediction.  A null text or one without a letter is
    ``und`` with score 0, and so is every text if nothing could be learned.  Repeated rows are
    predicted each; a tie goes to the label that sorts first; other columns are not read.
    """
    rows = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        is_held_out(F.col("doc_id").cast("bigint")).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else None
        for part in (part for batch in batches for part in slices(batch, SLICE)):
            texts = part.column("text")
            lettered = np.array([LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            labels = np.full(len(texts), UNKNOWN, dtype=object)
            scores = np.zeros(len(texts))
            if net:
                chances = predict(net, *text_bytes(texts), tables)
                best = chances.argmax(axis=1)
                labels = np.where(lettered, np.array(net.labels, dtype=object)[best], UNKNOWN)
                scores = np.where(lettered, chances[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("held_out"),
                    pa.array(labels.tolist(), pa.string()),
                    pa.array(np.clip(scores, 0, 1)),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def with_known_language(df: DataFrame, net: ByteNet | None, least: float = 0.4) -> DataFrame:
    """The rows of ``df`` whose language is known with a score of ``least``, with all columns.

    Texts without a letter are rejected, and those for which no language stands out.  If nothing
    could be learned, no text with a letter is rejected.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.pair_tables() if net else None
        for part in (part for batch in batches for part in slices(batch, SLICE)):
            texts = pc.fill_null(part.column(part.schema.get_field_index("text")), "")
            keep = np.array([LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            if net:
                keep &= predict(net, *text_bytes(texts), tables).max(axis=1) >= least
            yield part.filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)
