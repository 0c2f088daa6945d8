"""Near-duplicate documents by MinHash signatures and an inverted join over their coordinates.

1. Equal shingle sets form a class; only classes go on.  A class has a signature of minima.
2. A class is posted under its coordinate-value pairs that other classes have too.  Two classes
   above the similarity agree in at least ``agree`` coordinates, so a class with fewer pairs in
   common with anyone is done, and the others are posted under their rarest pairs only: of each
   class ``COORDINATES - agree + 1`` pairs, in one order for all, so that two such classes meet
   in a list; the longest lists are skipped unless a class has nothing rarer.
3. A list is not paired with itself.  Its most typical member is its pivot and is compared with
   every other member on the full sets.
4. Members of a pivot that are about as large get second pivots, which they are compared with; that
   is repeated while it finds many links.  Two members x, y of a pivot p that are still in different
   components are left to compare only if their sets can overlap enough: within p they share at most min(|x & p|, |y & p|) shingles, outside
   it only shingles that both have added.  Such pairs come from a range join over sizes and from
   a join over added shingles (those that very many have added count as the pivot's), and are compared on the full sets too.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetspark.llm.common import plain_id, slices, solid_id, stored, text_bytes
from sheetspark.llm.components import components
from sheetspark.llm.shingles import mixed, shingle_hashes, word_hashes

#: Minima of a signature, and the chance that two sets of exactly the least similarity have fewer
#: of them in common than is asked for; it falls steeply above that similarity.
COORDINATES = 64
MISSED = 4e-6
#: Texts are hashed in slices of about so many bytes.
SLICE = 1 << 21
#: Sizes that differ by less than this factor share a bucket of the range join.
STEP = 1.05
#: Members of a pivot that share an added shingle, from which on it counts as the pivot's.
WIDE = 32
#: Second pivots of a window at a time; they are chosen anew while at least the given part of the pairs
#: that they make are links, which spares more comparisons later than it costs.
SECONDS, WORTH = 4, 4

_FACTORS = np.random.default_rng(8).integers(1, 2**63, COORDINATES, dtype=np.uint64) * 2 + 1


def agreement(percent: int) -> int:
    """Coordinates that sets of this similarity agree in, but for a chance of MISSED."""
    p, below, agree = percent / 100, 0.0, 0
    while True:
        below += math.comb(COORDINATES, agree) * p**agree * (1 - p) ** (COORDINATES - agree)
        if below > MISSED:
            return agree
        agree += 1


def _sets(column: pa.Array, shingle: int):
    """Sorted distinct shingle hashes, text by text."""
    hashes, counts = shingle_hashes(*word_hashes(*text_bytes(column)), shingle)
    ends = np.cumsum(counts)
    return [np.unique(hashes[e - c : e]) for e, c in zip(ends, counts)]


def _digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    filled = [s for s in sets if len(s)]
    out = np.zeros((len(filled), COORDINATES), dtype=np.int32)
    if filled:
        flat = np.concatenate(filled)
        starts = np.cumsum([0, *map(len, filled[:-1])])
        for k in range(COORDINATES):
            least = np.minimum.reduceat(flat * _FACTORS[k], starts)
            out[:, k] = (mixed(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def _features(df: DataFrame, shingle: int) -> DataFrame:
    """Per row: solid id, version, size and digest of its set, signature (null if empty)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                sets = _sets(part.column("text"), shingle)
                signatures = iter(_signatures(sets).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("version"),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array(
                            [next(signatures) if len(s) else None for s in sets],
                            pa.list_(pa.int32()),
                        ),
                    ],
                    ["id", "version", "n", "digest", "signature"],
                )

    return df.mapInArrow(run, "id bigint, version bigint, n int, digest binary, signature array<int>")


def _full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """The sets of classes, from rows (text, node, digest); rows of another class are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SLICE):
                sets = _sets(part.column("text"), shingle)
                own = [
                    i
                    for i, (s, digest) in enumerate(zip(sets, part.column("digest").to_pylist()))
                    if len(s) and _digest(s) == digest
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("node").take(pa.array(own, pa.int64())),
                        pa.array([sets[i].view(np.int64) for i in own], pa.list_(pa.int64())),
                    ],
                    ["node", "members"],
                )

    return texts.mapInArrow(run, "node bigint, members array<bigint>")


def _similar(overlap: Column, sizes: Column, percent: int) -> Column:
    """100 * overlap >= percent * union, for two sets of ``sizes`` members together."""
    return (100 + percent) * overlap >= percent * sizes


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with both full sets.

    The set of b travels to a: if a is in very many pairs, these are large rows that adaptive
    execution splits by their bytes.
    """
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("b_set"))
    left = sets.select(F.col("node").alias("a"), F.col("members").alias("a_set"))
    return pairs.join(right, "b").join(left, "a")


def grouped(df: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(id, version, n, component, root) of every row; see ``near_duplicates``.

    ``id`` is never null, and ``version`` is a hash of the text.  ``root`` tells components with
    the same smallest id apart; it is null for a text that is linked with nothing.
    """
    agree = agreement(percent)
    texts = df.select(
        solid_id(F.col("doc_id")).alias("id"),
        F.xxhash64("text").alias("version"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    features = stored(_features(texts, shingle), "near-features")
    classes = stored(_classes(features), "near-classes")
    filled = features.where(F.col("digest").isNotNull())
    rows = filled.drop("signature").join(classes, "digest").select("id", "version", "n", "node")
    signatures = (
        filled.join(classes, "digest")
        .where(F.col("id") == F.col("first_id"))
        .select("node", "signature")
    )
    lists = stored(_rare_lists(signatures, agree), "near-lists")
    pivots = stored(_pivot_pairs(lists), "near-pivots")
    active = (
        pivots.select(F.col("a").alias("node"))
        .union(pivots.select("b"))
        .distinct()
        .join(classes, "node")
    )
    sets = stored(
        _full_sets(
            texts.join(active, texts["id"] == active["first_id"]).select("text", "node", "digest"),
            shingle,
        ),
        "near-sets",
    )
    members = stored(_members(pivots, sets, percent), "near-members")
    links = members.where("linked").select("a", "b")
    roots = components(links, "near-first")
    rest, roots = _undecided(members, roots, sets, percent)
    more = stored(_linked(stored(rest, "near-rest"), sets, percent), "near-more")
    if not more.isEmpty():
        roots = components(
            more.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))),
            "near-second",
        )
    labels = stored(_labels(classes, roots), "near-labels")
    linked = rows.join(labels, "node").select("id", "version", "n", "component", "root")
    alone = features.where(F.col("digest").isNull()).select(
        "id",
        "version",
        "n",
        F.col("id").alias("component"),
        F.lit(None).cast("bigint").alias("root"),
    )
    return linked.union(alone)


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``df``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Words are runs of characters other than space, tab and line breaks; A-Z count as a-z.  A
    text's set has its distinct runs of ``shingle`` words, or all its words if it has fewer.
    Texts are linked if 100 * intersection >= percent * union; ``component_id`` is the smallest
    doc_id that can be reached over links, and the row is kept if that is its own.  A text that
    is null or has no words is linked with nothing.  Rows are documents of their own even if they
    repeat a doc_id; a null doc_id sorts first.  Other columns are not read.
    """
    return grouped(df, shingle, percent).select(
        plain_id(F.col("id")).alias("doc_id"),
        F.col("n").cast("bigint").alias("n_shingles"),
        plain_id(F.col("component")).alias("component_id"),
        (F.col("id") == F.col("component")).alias("kept"),
    )


def without_near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group that ``near_duplicates`` finds, with all columns.

    It is that of the smallest doc_id (null is the smallest), and if near copies share that id,
    the one whose text has the smallest hash.  Texts that are null or have no words all stay,
    but of rows that repeat doc_id and text one.
    """
    found = stored(grouped(df, shingle, percent), "near-found")
    first = found.where("id = component AND root IS NOT NULL")
    several = (
        first.groupBy("root")
        .agg(F.min("version").alias("least"), F.max("version").alias("most"))
        .where("least != most")
    )
    others = first.join(stored(several, "near-several"), "root").where("version != least")
    dropped = (
        found.where("id != component")
        .unionByName(others.drop("least", "most"))
        .select(F.col("id").alias("__id"), F.col("version").alias("__version"))
    )
    marked = df.withColumn("__id", solid_id(F.col("doc_id"))).withColumn(
        "__version", F.xxhash64("text")
    )
    left = marked.join(stored(dropped.distinct(), "near-dropped"), ["__id", "__version"], "left_anti")
    if not found.groupBy("id", "version").count().where("count > 1").isEmpty():
        left = left.dropDuplicates(["__id", "__version"])
    return left.select(*df.columns)


def _classes(features: DataFrame) -> DataFrame:
    """One row per distinct set: digest, smallest id, node.

    The node is that id; if an id comes with several sets, all but one get a hash instead.
    """
    first = (
        features.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"))
    )
    nth = F.row_number().over(Window.partitionBy("first_id").orderBy("digest"))
    return first.withColumn("nth", nth).select(
        "digest",
        "first_id",
        F.when(F.col("nth") == 1, F.col("first_id"))
        .otherwise(F.xxhash64("first_id", "digest"))
        .alias("node"),
    )


def _rare_lists(signatures: DataFrame, agree: int) -> DataFrame:
    """Postings (key, node, weight) of every class under its rarest shared pairs.

    Pairs that no other class has come first in the order and match nothing: of the others, a
    class needs all but ``agree - 1``.  The weight tells how typical a class is.
    """
    postings = signatures.select("node", F.posexplode("signature").alias("place", "value")).select(
        "node", F.xxhash64("place", "value").alias("key")
    )
    times = postings.groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    shared = postings.join(stored(times, "near-times"), "key")
    ranked = shared.groupBy("node").agg(
        F.sort_array(F.collect_set(F.struct("times", "key"))).alias("ranked")
    )
    rare = ranked.where(F.size("ranked") >= agree).select(
        "node",
        F.aggregate("ranked", F.lit(0).cast("bigint"), lambda s, x: s + x["times"]).alias("weight"),
        F.slice("ranked", F.lit(1), F.size("ranked") - (agree - 1)).alias("rare"),
    )
    return rare.select("node", "weight", F.explode("rare").alias("item")).select(
        F.col("item.key").alias("key"), "node", "weight"
    )


def _pivot_pairs(lists: DataFrame) -> DataFrame:
    """Distinct (a, b): b is in a list of which a is the pivot."""
    pivots = (
        lists.groupBy("key")
        .agg(
            F.max(F.struct("weight", F.bitwise_not(F.col("node")).alias("turned"))).alias("top"),
            F.count("*").alias("n"),
        )
        .where("n > 1")
        .select("key", F.bitwise_not(F.col("top.turned")).alias("a"))
    )
    return (
        lists.join(stored(pivots, "near-tops"), "key")
        .select("a", F.col("node").alias("b"))
        .where("a != b")
        .distinct()
    )


def _members(pivots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members b of each pivot a: their size, what they share with it, and what they add."""
    both = _compared(pivots, sets).select(
        "a",
        "b",
        F.size("a_set").alias("pivot_size"),
        F.size("b_set").alias("size"),
        F.array_except("b_set", "a_set").alias("added"),
    )
    inside = F.col("size") - F.size("added")
    return both.select(
        "a",
        "b",
        "size",
        inside.alias("inside"),
        "added",
        _similar(inside, F.col("size") + F.col("pivot_size"), percent).alias("linked"),
    )


def _rooted(people: DataFrame, roots: DataFrame) -> DataFrame:
    """Members (pivot, node, ...) with the roots of both."""
    by_node = roots.select("node", F.col("root").alias("node_root"))
    by_pivot = roots.select(F.col("node").alias("pivot"), F.col("root").alias("own_root"))
    return (
        people.join(by_node, "node", "left")
        .join(by_pivot, "pivot", "left")
        .withColumn("root", F.coalesce("node_root", "node"))
        .withColumn("pivot_root", F.coalesce("own_root", "pivot"))
        .drop("node_root", "own_root")
    )


def _second_pivots(people: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b) of a second pivot with the members of other components about as large.

    Members of a pivot whose sizes are within the similarity share one of two overlapping windows.  A
    window with several components gets some of its members, others each turn, as second pivots; they
    are paired with the others, and those are not paired with one another.
    """
    half = math.log(100 / percent) / 2
    place = F.floor(F.log(F.col("size").cast("double")) / half)
    rows = people.withColumn("window", F.explode(F.array(place - 1, place)))
    top = F.struct("node", "root", "size", "inside")
    tops = (
        rows.groupBy("pivot", "window")
        .agg(
            *(
                F.min_by(top, F.xxhash64("node", F.lit(turn * SECONDS + k))).alias(f"top{k}")
                for k in range(SECONDS)
            ),
            F.min("root").alias("least"),
            F.max("root").alias("most"),
        )
        .where("least != most")
        .select(
            "pivot", "window", F.explode(F.array_distinct(F.array(*(f"top{k}" for k in range(SECONDS))))).alias("top")
        )
    )
    pairs = rows.join(stored(tops, "near-seconds"), ["pivot", "window"]).where(
        (F.col("root") != F.col("top.root"))
        & (
            (100 + percent) * F.least("inside", "top.inside")
            >= percent * (F.col("size") + F.col("top.size"))
        )
    )
    node, other = F.col("node"), F.col("top.node")
    return pairs.select(F.least(node, other).alias("a"), F.greatest(node, other).alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar."""
    overlap = F.size(F.array_intersect("a_set", "b_set"))
    similar = _similar(overlap, F.size("a_set") + F.size("b_set"), percent)
    return _compared(pairs, sets).where(similar).select("a", "b")


def _undecided(
    members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) under one pivot, in different components, whose sets may be similar.

    Also the roots after the links that second pivots have brought, so that what is left are pairs
    between components that hardly have links.
    """
    known = _rooted(members.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "size", "inside", "added"), roots)
    known = stored(known, "near-known")
    open_pivots = stored(
        known.where("root != pivot_root").select("pivot").distinct(), "near-open"
    )
    # Only shingles that several members of the pivot have added can be shared outside it.
    added = known.join(open_pivots, "pivot", "left_semi").select(
        "pivot", "node", F.explode_outer("added").alias("item")
    )
    added = stored(added, "near-added")
    common = (
        added.where(F.col("item").isNotNull())
        .groupBy("pivot", "item")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("pivot", "item", (F.col("n") >= WIDE).alias("wide"))
    )
    marked = added.join(stored(common, "near-common"), ["pivot", "item"], "left")
    # A shingle that very many have added counts as one of the pivot's: the bound holds for any
    # set in its place, and what is joined item by item stays linear.
    extras = stored(
        marked.groupBy("pivot", "node").agg(
            F.count(F.when(~F.col("wide"), 1)).alias("extra"),
            F.count(F.when(F.col("wide"), 1)).alias("widely"),
        ),
        "near-extras",
    )
    whole = percent + 100
    people = stored(
        known.select("pivot", "node", "size", "inside", "root", "pivot_root")
        .join(extras, ["pivot", "node"])
        .withColumn("inside", F.col("inside") + F.col("widely"))
        .drop("widely")
        .where(100 * (F.col("inside") + F.col("extra")) >= percent * F.col("size")),
        "near-people",
    )
    turn = 0
    while True:
        pairs = stored(_second_pivots(people, percent, turn), "near-turn")
        found = stored(_linked(pairs, sets, percent), "near-links")
        links = found.count()
        if not links:
            break
        stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(found.union(stars), "near-turn")
        people = stored(_rooted(people.drop("root", "pivot_root"), roots), "near-people")
        turn += 1
        if links * WORTH < pairs.count():
            break

    x, y = _named(people, "x"), _named(people, "y")
    bucket = F.floor(F.log(F.col("y_size").cast("double")) / F.log(F.lit(STEP)))
    least = F.floor(F.log(F.col("x_size") * (percent / 100)) / F.log(F.lit(STEP))) - 1
    largest = F.expr(f"x_inside * {whole}L / {percent}D - x_size")
    most = F.floor(F.log(F.greatest(largest, F.lit(1.0))) / F.log(F.lit(STEP))) + 1
    outsiders = x.where("x_root != x_pivot_root").withColumn("least", least).withColumn("most", most)
    outsiders = outsiders.where("most >= least").withColumn(
        "bucket", F.explode(F.sequence("least", "most"))
    )
    by_size = outsiders.join(y.withColumn("bucket", bucket), ["pivot", "bucket"]).where(
        (F.col("x_root") != F.col("y_root"))
        & (
            whole * F.least("x_inside", "y_inside")
            >= percent * (F.col("x_size") + F.col("y_size"))
        )
    )

    shared = stored(
        marked.where(~F.col("wide"))
        .select("pivot", "node", "item")
        .join(people, ["pivot", "node"]),
        "near-shared",
    )
    by_item = (
        _named(shared, "x", "item")
        .join(_named(shared, "y", "item"), ["pivot", "item"])
        .where(
            (F.col("x_root") != F.col("y_root"))
            & (F.col("x_node") < F.col("y_node"))
            & (
                whole * (F.least("x_inside", "y_inside") + F.least("x_extra", "y_extra"))
                >= percent * (F.col("x_size") + F.col("y_size"))
            )
        )
    )
    pair = [F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")]
    return by_size.select(*pair).union(by_item.select(*pair)).distinct(), roots


def _named(df: DataFrame, prefix: str, *same: str) -> DataFrame:
    keep = {"pivot", *same}
    return df.select(*(F.col(c).alias(c if c in keep else f"{prefix}_{c}") for c in df.columns))


def _labels(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """Per node the smallest doc_id of its component, and the component's root."""
    known = classes.join(roots, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root")
    )
    known = stored(known, "near-roots")
    least = stored(
        known.groupBy("root").agg(F.min("first_id").alias("component")), "near-least"
    )
    return known.join(least, "root").select("node", "component", "root")
