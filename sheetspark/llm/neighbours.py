"""Approximate nearest neighbours by cosine, on several shifted Hilbert curves.

Unit vectors are turned, and each group of turned coordinates, shifted, gives one ordering of all
vectors along a Hilbert curve.  An ordering is cut into blocks of neighbouring keys.  A query is
compared with the blocks around its own in every ordering, and what is found is merged.  How many
blocks that are is measured: a few queries are compared with all vectors first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetspark.llm.common import plain_id, solid_id, stored
from sheetspark.llm.hilbert import cells, hilbert_keys

#: Orderings, dimensions and bits of each; the rest of a key separates vectors of one cell.
ORDERINGS, DIMENSIONS, BITS, TIE_BITS = 8, 8, 6, 14
#: Vectors that the index is fitted on, and queries that the reach is measured with.
SAMPLE, PROBES = 20_000, 128
#: Vectors of a block, unless there would be more than BLOCKS of them.
BLOCK, BLOCKS = 2_048, 4_096
#: Share of the probes' neighbours that the reach must cover; the rest is safety over 0.9.
COVERED = 0.97


@dataclass
class CurveIndex:
    """Turns unit vectors into the numbers of their blocks, ordering by ordering."""

    turn: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    shift: np.ndarray
    cuts: list[np.ndarray]

    def keys(self, units: np.ndarray, ids: np.ndarray, ordering: int) -> np.ndarray:
        here = slice(ordering * DIMENSIONS, (ordering + 1) * DIMENSIONS)
        values = (units @ self.turn[:, here] - self.mean[here]) / self.scale[here]
        curve = hilbert_keys(cells(values + self.shift[here], -3.0, 3.0, BITS), BITS)
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TIE_BITS)
        return curve << TIE_BITS | mixed.astype(np.int64)

    def blocks(self, units: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """(vectors, orderings) of block numbers."""
        out = np.empty((len(units), ORDERINGS), dtype=np.int32)
        for o in range(ORDERINGS):
            out[:, o] = np.searchsorted(self.cuts[o], self.keys(units, ids, o), side="right")
        return out

    @property
    def last(self) -> int:
        return len(self.cuts[0])


def fit(units: np.ndarray, ids: np.ndarray, total: int, seed: int = 4) -> CurveIndex:
    """An index for ``total`` vectors from a sample of them."""
    rng = np.random.default_rng(seed)
    wanted, dims = ORDERINGS * DIMENSIONS, units.shape[1]
    turns = []
    while sum(t.shape[1] for t in turns) < wanted:  # each turn is a rotation of the whole space
        turns.append(np.linalg.qr(rng.normal(size=(dims, dims)))[0])
    turn = np.concatenate(turns, axis=1)[:, :wanted]
    values = units @ turn
    scale = np.maximum(values.std(axis=0), 1e-9)
    shift = rng.uniform(-0.5, 0.5, wanted)
    index = CurveIndex(turn, values.mean(axis=0), scale, shift, [])
    count = int(min(BLOCKS, -(-total // BLOCK)))
    for o in range(ORDERINGS):
        keys = np.sort(index.keys(units, ids, o))
        index.cuts.append(keys[[len(keys) * k // count for k in range(1, count)]])
    return index


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows of doubles."""
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(rows, -1) if rows else np.zeros((0, 1))


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that no square overflows or vanishes.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _tamed(vectors: np.ndarray) -> np.ndarray:
    """Vectors whose squares would overflow or vanish are scaled; others stay as they are."""
    largest = np.abs(vectors).max(axis=1, keepdims=True, initial=0)
    return vectors / np.where((largest > 1e120) | (largest < 1e-120), largest, 1.0)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``a`` with the same row of ``b``, summed in one fixed order."""
    a, b = _tamed(a), _tamed(b)
    dot, aa, bb = (np.zeros(len(a)) for _ in range(3))
    for i in range(a.shape[1]):
        x, y = a[:, i], b[:, i]
        dot += x * y
        aa += x * x
        bb += y * y
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def _nearest(queries: np.ndarray, others: np.ndarray, ids: np.ndarray, k: int):
    """(query row, other row, cosine) of each query's ``k`` nearest, ties to smaller ids."""
    rough = _units(queries) @ _units(others).T
    if rough.shape[1] > k:
        least = -np.partition(-rough, k - 1, axis=1)[:, k - 1 : k]
        rows, columns = np.nonzero(rough >= least - 1e-9)
    else:
        rows, columns = (x.reshape(-1) for x in np.indices(rough.shape))
    exact = np.empty(len(rows))
    for at in range(0, len(rows), 1 << 16):
        part = slice(at, at + (1 << 16))
        exact[part] = cosines(queries[rows[part]], others[columns[part]])
    order = np.lexsort((ids[columns], -exact, rows))
    rows, columns, exact = rows[order], columns[order], exact[order]
    starts = np.searchsorted(rows, rows, side="left")
    keep = np.arange(len(rows)) - starts < k
    return rows[keep], columns[keep], exact[keep]


def _valid(df: DataFrame) -> DataFrame:
    """(vec_id, vector, h1, h2) of the vectors that take part, of the most frequent length."""
    rows = df.select(solid_id(F.col("vec_id")).alias("vec_id"), F.col("embedding").alias("vector"))
    finite = F.forall(
        "vector",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    rows = rows.where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    best = sizes.orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("vector") == (best.size if best else 0))
    return rows.withColumn("h1", F.xxhash64("vector")).withColumn(
        "h2", F.xxhash64(F.lit(1), "vector")
    )


def nearest_neighbours(df: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Per query its ``k`` nearest: ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``.

    ``df`` has ``vec_id`` and ``embedding``.  Queries are the rows whose vec_id is divisible by
    ``every``; the candidates of a query are all rows but those with its own vec_id.  The score is
    the cosine in double precision; ties go to the smaller vec_id.  Vectors that are null, empty,
    zero, or have a null or non-finite component take no part, nor do those of another length than
    most have.  Equal vectors are searched once and stand for all their ids, however many.  Rows
    that repeat a vec_id and its vector are one; a null vec_id is a candidate (as the smallest)
    but no query.  Other columns are not read.
    """
    valid = _valid(df)
    same = Window.partitionBy("h1", "h2").orderBy("vec_id")
    members = (
        valid.withColumn("nth", F.dense_rank().over(same))
        .where(F.col("nth") <= k + 1)
        .groupBy("h1", "h2")
        .agg(
            F.sort_array(F.collect_set("vec_id")).alias("ids"),
            F.first("vector").alias("vector"),
        )
        .withColumn("class", F.xxhash64("h1", "h2", F.col("ids")[0]))
    )
    classes = stored(members, "near-classes")
    asked = valid.where(
        (F.col("vec_id") != F.lit(-(2**63))) & (F.col("vec_id") % every == 0)
    ).select("vec_id", "h1", "h2")
    asked = asked.distinct()
    queries = stored(
        asked.join(classes.select("h1", "h2", "class"), ["h1", "h2"]).select("vec_id", "class"),
        "near-queries",
    )
    asking = stored(
        classes.join(queries.select("class").distinct(), "class", "left_semi").select("class", "vector"),
        "near-asking",
    )
    index, reach = _fitted(classes.select("class", "vector"), asking, k + 1)
    if index is None:
        return _empty(df)
    found = _searched(classes.select("class", "vector"), asking, index, reach, k + 1)
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    best = (
        found.groupBy("query", "class")
        .agg(F.first("score").alias("score"))
        .join(classes.select("class", "ids"), "class")
        .withColumn("nth", F.row_number().over(by_query))
        .where(F.col("nth") <= k + 1)
        .groupBy("query")
        .agg(
            F.sort_array(
                F.flatten(
                    F.collect_list(
                        F.transform(
                            "ids",
                            lambda i: F.struct((-F.col("score")).alias("turned"), i.alias("vec_id")),
                        )
                    )
                )
            ).alias("near")
        )
    )
    best = stored(best.withColumnRenamed("query", "class"), "near-best")
    own = F.col("query_id")
    return (
        queries.withColumnRenamed("vec_id", "query_id")
        .join(best, "class")
        .select(
            "query_id",
            F.posexplode(
                F.slice(F.filter("near", lambda c: c["vec_id"] != own), 1, k)
            ).alias("place", "found"),
        )
        .select(
            "query_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            plain_id(F.col("found.vec_id")).alias("vec_id"),
            (-F.col("found.turned")).alias("score"),
        )
    )


def _empty(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(
        [], "query_id bigint, rank int, vec_id bigint, score double"
    )


def _fitted(vectors: DataFrame, asking: DataFrame, k: int):
    """The index, and how many blocks on either side of its own a query must look at."""
    total = vectors.count()
    if not total or asking.isEmpty():
        return None, 0
    sample = _sampled(vectors, total, SAMPLE)
    ids = np.array([r[0] for r in sample], dtype=np.int64)
    units = _units(np.array([r.vector for r in sample], dtype=np.float64))
    index = fit(units, ids, total)
    if index.last == 0:
        return index, 0
    probes = _sampled(asking, asking.count(), PROBES)
    probe_ids = np.array([r[0] for r in probes], dtype=np.int64)
    probe_vectors = np.array([r.vector for r in probes], dtype=np.float64)
    own = index.blocks(_units(probe_vectors), probe_ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.column("class").to_numpy()
            matrix = _matrix(batch.column("vector"))
            rows, columns, scores = _nearest(probe_vectors, matrix, others, k)
            blocks = index.blocks(_units(matrix[columns]), others[columns])
            away = np.abs(blocks - own[rows]).min(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows.astype(np.int32)), pa.array(others[columns]), pa.array(scores), pa.array(away)],
                ["probe", "class", "score", "away"],
            )

    nth = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "class"))
    near = vectors.mapInArrow(run, "probe int, class bigint, score double, away int")
    rows = near.withColumn("nth", nth).where(F.col("nth") <= k).select("probe", "class", "away").collect()
    away = sorted(r.away for r in rows if probe_ids[r.probe] != r["class"])
    reach = away[min(len(away) - 1, int(np.ceil(COVERED * len(away))))] if away else 0
    return index, int(reach)


def _sampled(vectors: DataFrame, total: int, wanted: int) -> list:
    """About ``wanted`` rows, chosen by a hash of their class; never more than twice as many."""
    every = max(1, total // wanted)
    rows = vectors.where(F.pmod(F.xxhash64(F.lit(5), "class"), F.lit(every)) == 0)
    found = rows.orderBy("class").limit(2 * wanted).collect()
    return found or vectors.orderBy("class").limit(wanted).collect()


def _searched(
    vectors: DataFrame, asking: DataFrame, index: CurveIndex, reach: int, k: int
) -> DataFrame:
    """(query, class, score): the ``k`` nearest of a query in each block that it looks at."""

    def dealt(name: str, around: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("class").to_numpy()
                blocks = index.blocks(_units(_matrix(batch.column("vector"))), ids)
                for o in range(ORDERINGS):
                    for step in range(-around, around + 1):
                        there = blocks[:, o] + step
                        inside = np.flatnonzero((there >= 0) & (there <= index.last))
                        if not len(inside):
                            continue
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(inside), o, dtype=np.int32)),
                                pa.array(there[inside]),
                                pa.array(ids[inside]),
                                batch.column("vector").take(pa.array(inside)),
                            ],
                            ["ordering", "block", name, "vector"],
                        )

        return run

    kind = vectors.schema["vector"].dataType.simpleString()
    rows = vectors.mapInArrow(
        dealt("class", 0), f"ordering int, block int, class bigint, vector {kind}"
    )
    looks = asking.mapInArrow(
        dealt("query", reach), f"ordering int, block int, query bigint, vector {kind}"
    )

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema(
            [("query", pa.int64()), ("class", pa.int64()), ("score", pa.float64())]
        )
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        queries, others = left["query"].to_numpy(), right["class"].to_numpy()
        matrix = _matrix(right["vector"].combine_chunks())
        asked = _matrix(left["vector"].combine_chunks())
        parts = []
        for at in range(0, len(asked), 256):
            rows, columns, scores = _nearest(asked[at : at + 256], matrix, others, k)
            parts.append((queries[at + rows], others[columns], scores))
        return pa.Table.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], schema=schema)

    keys = ("ordering", "block")
    return (
        looks.groupBy(*keys)
        .cogroup(rows.groupBy(*keys))
        .applyInArrow(compare, "query bigint, class bigint, score double")
    )
