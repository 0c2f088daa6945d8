"""Repeated runs of lines, found by winnowing over line hashes.

Of every window of neighbouring line pairs the pair with the smallest hash is a fingerprint, so
any run of three lines that stands in two places has the same fingerprint in both.  Places of a
fingerprint are joined together with the line on either side: a match that extends by one line
to the left or to the right is a repeated run.  Runs of fewer lines count if they are long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.common import solid_id, stored
from sheetspark.llm.words import places, runs, word_count

#: Lines of a fingerprint, and fingerprints of a window: together the lines of a repeated run.
PAIR, WINDOW = 2, 2
LINES = PAIR + WINDOW - 1
#: A run of fewer lines counts if it has so many words.
WORDS = 50


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _window_minima(size: Column) -> Column:
    """Places of the smallest of ``pairs`` in each window; the last one of equals."""
    if WINDOW != 2:
        raise NotImplementedError("windows of two pairs")
    return F.array_distinct(
        F.transform(
            places(size - LINES + 1),
            lambda i: F.when(F.get("pairs", i + 1) <= F.get("pairs", i), i + 1).otherwise(i),
        )
    )


def _marks(texts: DataFrame) -> DataFrame:
    """(key, id, version, start, size): the runs of lines that are compared with one another.

    The key of a run is the hash of its lines; runs of one size never meet those of another.
    """
    hashed = (
        texts.select(
            "id",
            "version",
            F.transform(_lines(F.col("text")), lambda x: F.xxhash64(x)).alias("hashes"),
            F.transform(_lines(F.col("text")), lambda x: word_count(x)).alias("words"),
        )
        .withColumn("size", F.size("hashes"))
        .withColumn("pairs", runs(F.col("hashes"), PAIR))
    )

    def run(start: Column, size: int) -> Column:
        key = F.xxhash64(F.lit(size), *(F.get("hashes", start + k) for k in range(size)))
        return F.struct(
            start.cast("int").alias("start"), F.lit(size).alias("size"), key.alias("key")
        )

    extended = F.filter(
        F.array_distinct(
            F.flatten(F.transform(_window_minima(F.col("size")), lambda i: F.array(i - 1, i)))
        ),
        lambda i: (i >= 0) & (i + LINES <= F.col("size")),
    )
    parts = [F.transform(extended, lambda i: run(i, LINES))]
    parts += [_long_runs(size, run) for size in range(1, LINES)]
    return hashed.select("id", "version", F.explode(F.concat(*parts)).alias("run")).select(
        F.col("run.key").alias("key"),
        "id",
        "version",
        F.col("run.start").alias("start"),
        F.col("run.size").alias("size"),
    )


def _long_runs(size: int, run) -> Column:
    """The runs of so many lines that have enough words."""

    def said(i: Column) -> Column:
        total = F.get("words", i)
        for k in range(1, size):
            total = total + F.get("words", i + k)
        return total >= WORDS

    starts = F.filter(places(F.col("size") - size + 1), lambda i: said(i))
    return F.transform(starts, lambda i: run(i, size))


def repeated_runs(texts: DataFrame) -> DataFrame:
    """(id, version, start, end): lines [start, end) stand at an earlier place as well.

    ``texts`` has id, version (equal for equal texts) and text, not null.
    """
    marks = stored(_marks(texts), "line-marks")
    firsts = (
        marks.groupBy("key")
        .agg(F.min(F.struct("id", "version", "start")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("key", "first")
    )
    return (
        marks.join(stored(firsts, "line-firsts"), "key")
        .where(F.struct("id", "version", "start") != F.col("first"))
        .select("id", "version", "start", (F.col("start") + F.col("size")).alias("end"))
    )


def without_repeats(df: DataFrame) -> DataFrame:
    """``df`` with ``text`` as ``deduplicate_lines`` leaves it, and ``__lines`` and ``__removed``.

    All columns of ``df`` stay; the two that are added count the lines before and the removed.
    """
    marked = df.withColumn("__id", solid_id(F.col("doc_id"))).withColumn(
        "__version", F.xxhash64("text")
    )
    texts = marked.where(F.col("text").isNotNull()).select(
        F.col("__id").alias("id"), F.col("__version").alias("version"), "text"
    )
    spans = (
        repeated_runs(texts)
        .groupBy("id", "version")
        .agg(F.collect_set(F.struct("start", "end")).alias("__spans"))
        .withColumnsRenamed({"id": "__id", "version": "__version"})
    )
    joined = marked.join(stored(spans, "line-spans"), ["__id", "__version"], "left")
    gone = F.array_distinct(
        F.flatten(F.transform("__spans", lambda s: F.sequence(s["start"], s["end"] - 1)))
    )
    changed = joined.withColumn("__split", _lines(F.col("text"))).withColumn("__gone", gone)
    left = F.transform(
        F.array_except(places(F.size("__split")), F.col("__gone")),
        lambda i: F.get("__split", i),
    )
    has = F.col("__gone").isNotNull()
    text = F.when(has, F.array_join(left, "\n")).otherwise(F.col("text"))
    lines = F.when(F.col("text").isNull(), 0).otherwise(F.size("__split")).cast("bigint")
    removed = F.when(has, F.size("__gone")).otherwise(0).cast("bigint")
    return changed.select(
        *((text.alias("text") if c == "text" else F.col(f"`{c}`")) for c in df.columns),
        lines.alias("__lines"),
        removed.alias("__removed"),
    )


def deduplicate_lines(df: DataFrame) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``n_lines``, ``n_removed`` and the ``text`` that is left.

    Texts are cut at line feeds.  A line is removed if it is part of a run of lines that has three
    lines, or fewer with fifty words or more, and that stands at an earlier place as well: in a
    text of a smaller doc_id (null is the smallest), or earlier in the same text.  So a line that
    is removed is still there in an earlier place.

    A null text stays null and has no lines; an empty one has one empty line; a text without lines
    left is empty.  Rows that repeat doc_id and text are one document and stay equal; rows that
    repeat only the doc_id are ordered by a hash of the text.  Other columns are not read.
    """
    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return without_repeats(rows).select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__removed").alias("n_removed"),
        "text",
    )
