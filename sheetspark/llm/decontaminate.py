"""Passages of a benchmark inside documents, found by winnowing.

Of every window of words the smallest run hash is a fingerprint, so a shared window has a
shared fingerprint.  Selected fingerprints of documents are joined with the distinct ones of
the items.  A hit is extended to the windows around it, and each of these counts if all of its
words are an item's.  Every join has one row a key on the items' side, so no number of items
or documents with a common passage multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.common import plain_id, solid_id, stored
from sheetspark.llm.words import places, runs, window_minima, words

#: Words of a window: what is shared at least.
WINDOW = 10
#: Words of a run that is hashed.
RUN = 5
#: Fingerprints and windows of items, a hash each, up to which all executors get them.
BROADCAST = 200_000


def _shape(window: int) -> tuple[int, int]:
    """Words of a run, and runs of a window, for a window of so many words."""
    run = min(RUN, -(-window // 2))
    return run, window - run + 1


def _with_minima(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """``rows`` with ``minima<n>``, the fingerprint of each window of n words, for all lengths."""
    for run in sorted({_shape(n)[0] for n in lengths}):
        rows = rows.withColumn(f"runs{run}", runs(F.col("hashes"), run))
    for n in lengths:
        run, width = _shape(n)
        rows = rows.withColumn(f"minima{n}", window_minima(F.col(f"runs{run}"), width))
    return rows


def _window_key(hashes: Column, place: Column, n: Column) -> Column:
    """A hash of a whole window.

    It is compared only where a fingerprint agrees too, so two different windows are taken for one
    only if both hashes of 64 bits agree.
    """
    return F.xxhash64(n, F.slice(hashes, place + 1, n))


def _item_windows(items: DataFrame, lengths: list[int]) -> DataFrame:
    """(fingerprint, key, item_id) of every window of every item."""
    n = F.least(F.size("hashes"), F.lit(WINDOW))
    minima = F.array().cast("array<bigint>")
    for length in lengths:
        minima = F.when(n == length, F.col(f"minima{length}")).otherwise(minima)
    return (
        _with_minima(items, lengths)
        .select("item_id", "hashes", n.alias("n"), F.posexplode(minima).alias("k", "fingerprint"))
        .select(
            "fingerprint",
            _window_key(F.col("hashes"), F.col("k"), F.col("n")).alias("key"),
            "item_id",
        )
        .distinct()
    )


def _mark(n: Column, start: Column, fingerprint: Column) -> Column:
    return F.struct(n.alias("n"), start.alias("start"), fingerprint.alias("fingerprint"))


def _selected(n: int) -> Column:
    """(n, start, fingerprint) of each window whose fingerprint is not the last window's.

    A fingerprint stands for at most as many windows as can share a run: the next block of so
    many selects it again.
    """
    minima, width = F.col(f"minima{n}"), _shape(n)[1]
    starts = F.filter(
        places(F.size(minima)),
        lambda i: (i % width == 0) | (F.get(minima, i) != F.get(minima, i - 1)),
    )
    return F.transform(starts, lambda i: _mark(F.lit(n), i, F.get(minima, i)))


def _extended(matched: DataFrame) -> DataFrame:
    """The windows that a selected fingerprint stands for: ``place`` and ``key`` added."""
    n, start = F.col("n"), F.col("start")
    width = n - F.least(F.lit(RUN), F.ceil(n / 2).cast("int")) + 1
    last = F.least(start - start % width + width - 1, F.size("hashes") - n)
    around = F.when(n == 0, F.array(F.lit(0))).otherwise(F.sequence(start, last))
    keyed = F.transform(
        around,
        lambda k: F.struct(k.alias("place"), _window_key(F.col("hashes"), k, n).alias("key")),
    )
    return matched.select("id", "version", "n", "n_words", F.explode(keyed).alias("w")).select(
        "id", "version", "n", "n_words", "w.place", "w.key"
    )


def _word_hashes(texts: DataFrame) -> DataFrame:
    hashes = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    return texts.withColumn("hashes", hashes).drop("text")


def _hits(
    texts: DataFrame, windows: DataFrame, lengths: list[int], broadcast: int, counting: bool
) -> tuple[DataFrame, DataFrame | None]:
    """(id, version, n, place, key) of the texts' windows that are an item's, and with
    ``counting`` (id, version, n_words) of each row of ``texts``, from the same scan."""
    prints = stored(windows.select("fingerprint").distinct(), "bench-fingerprints")
    keys = stored(windows.select("key").distinct(), "bench-keys")
    small = keys.count() <= broadcast
    hashed = _word_hashes(texts)
    parts = [_selected(n) for n in lengths]
    zero = F.lit(0)
    counted = None
    if small:
        if counting:
            # A mark of no words goes along for each text and carries its number of words.
            parts.insert(0, F.array(_mark(zero, zero, zero.cast("bigint"))))
            prints = prints.union(prints.sparkSession.range(1).toDF("fingerprint"))
        marks = _with_minima(hashed, lengths).select(
            "id", "version", "hashes", F.explode(F.concat(*parts)).alias("mark")
        )
        matched = marks.select("id", "version", "hashes", "mark.*").join(
            F.broadcast(prints), "fingerprint", "left_semi"
        )
    else:
        marks = _with_minima(hashed, lengths).select(
            "id", "version", F.explode(F.concat(*parts)).alias("mark")
        )
        marks = marks.select("id", "version", "mark.*")
        found = stored(marks, "bench-marks").join(prints, "fingerprint", "left_semi")
        starts = found.select("id", "version", "n", "start").distinct()
        matched = hashed.join(stored(starts, "bench-starts"), ["id", "version"])
        counted = hashed.select("id", "version", F.size("hashes").cast("bigint").alias("n_words"))
    matched = matched.withColumn("n_words", F.size("hashes").cast("bigint"))
    near = stored(_extended(matched), "bench-windows")
    if counting and small:
        counted = near.where("n = 0").select("id", "version", "n_words")
    hits = (
        near.where("n > 0")
        .select("id", "version", "n", "place", "key")
        .join(F.broadcast(keys) if small else keys, "key", "left_semi")
    )
    return hits, counted


def _covered(spans: Column) -> Column:
    """How many words a set of (start, end) covers."""
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(
        F.array_sort(spans),
        nothing,
        lambda seen, s: F.struct(
            (
                seen["n"]
                + F.greatest(s["end"] - F.greatest(s["start"], seen["upto"]), F.lit(0))
            ).alias("n"),
            F.greatest(s["end"], seen["upto"]).alias("upto"),
        ),
        lambda seen: seen["n"],
    )


def _classes(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, class), windows in the same items being one class, and (class, item) without nulls."""
    members = windows.where(F.col("item_id").isNotNull()).select(
        "key", F.col("item_id").cast("string").alias("item")
    )
    classed = members.groupBy("key").agg(
        F.bit_xor(F.xxhash64("item")).alias("a"),
        F.bit_xor(F.xxhash64("item", F.lit(1))).alias("b"),
        F.count("*").alias("c"),
        F.min("key").alias("one"),
    )
    by_key = classed.select("key", F.xxhash64("a", "b", "c").alias("class"))
    one = classed.groupBy(F.xxhash64("a", "b", "c").alias("class")).agg(F.min("one").alias("key"))
    return stored(by_key, "bench-classes"), one.join(members, "key").select("class", "item")


def _judged(hits: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, version, n_hit, n_items, items_sha256) of the texts with a hit.

    Only the spans of one text come together, and its classes of windows; the items of a set of
    classes are put together once, for all texts that have that set.
    """
    by_key, members = _classes(windows)
    span = F.struct(F.col("place").alias("start"), (F.col("place") + F.col("n")).alias("end"))
    spans = hits.select("id", "version", span.alias("span"), "key")
    per_text = stored(
        spans.join(by_key, "key", "left")
        .groupBy("id", "version")
        .agg(
            _covered(F.collect_set("span")).alias("n_hit"),
            F.sort_array(F.collect_set("class")).alias("classes"),
        )
        .withColumn("set", F.xxhash64("classes")),
        "bench-texts",
    )
    sets = per_text.groupBy("set").agg(F.first("classes").alias("classes"))
    named = (
        sets.select("set", F.explode("classes").alias("class"))
        .join(members, "class")
        .groupBy("set")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .select(
            "set",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        )
    )
    return per_text.drop("classes").join(stored(named, "bench-sets"), "set", "left").drop("set")


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(
        solid_id(F.col("doc_id")).alias("id"),
        F.xxhash64("text").alias("version"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _benchmark(benchmark: DataFrame) -> tuple[DataFrame | None, list[int]]:
    """The windows of all items and the lengths that they have, at most one a word of a window."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    items = stored(_word_hashes(items), "bench-items")
    sizes = items.select(F.least(F.size("hashes"), F.lit(WINDOW)).alias("n")).distinct()
    lengths = sorted(r.n for r in sizes.collect() if r.n)
    if not lengths:
        return None, lengths
    return stored(_item_windows(items, lengths), "bench-item-windows"), lengths


def contamination(
    documents: DataFrame, benchmark: DataFrame, broadcast: int = BROADCAST
) -> DataFrame:
    """Per row of ``documents``: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``,
    ``items_sha256`` and ``contaminated``.

    Words are runs of letters, digits and non-ASCII characters; A-Z count as a-z.  A window is
    ten consecutive words of an item; an item of fewer words, but some, is one window.  A word
    inside any occurrence of a window is hit.  A null or empty text has no words, and a null or
    empty item no window.  Rows of ``documents`` are judged each, also repeated ones; items that
    repeat an item_id are one item, an item without id has windows but is not counted.  Other
    columns are not read.
    """
    texts = _texts(documents)
    windows, lengths = _benchmark(benchmark)
    zero, empty = F.lit(0).cast("bigint"), F.sha2(F.lit(""), 256)
    if windows is None:
        counted = _word_hashes(texts).select("id", F.size("hashes").cast("bigint").alias("n_words"))
        flagged = counted.select(
            "*", zero.alias("n_hit"), zero.alias("n_items"), empty.alias("items_sha256")
        )
    else:
        hits, counted = _hits(texts, windows, lengths, broadcast, counting=True)
        judged = stored(_judged(stored(hits, "bench-hits"), windows), "bench-judged")
        flagged = counted.join(judged, ["id", "version"], "left")
    n_hit = F.coalesce("n_hit", zero)
    return flagged.select(
        plain_id(F.col("id")).alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", empty).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that ``contamination`` finds nothing in, with all columns."""
    windows, lengths = _benchmark(benchmark)
    if windows is None:
        return documents
    hits, _ = _hits(_texts(documents), windows, lengths, BROADCAST, counting=False)
    hit = stored(hits.select("id", "version").distinct(), "bench-hit")
    marked = documents.withColumn("__id", solid_id(F.col("doc_id"))).withColumn(
        "__version", F.xxhash64("text")
    )
    hit = hit.withColumnsRenamed({"id": "__id", "version": "__version"})
    return marked.join(hit, ["__id", "__version"], "left_anti").select(*documents.columns)
