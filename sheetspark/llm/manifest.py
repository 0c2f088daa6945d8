"""A Merkle tree over the rows of a dataset, with a proof for every row.

1. A row is hashed where it is read; only its hash goes on.  Rows get a rank in their group.
2. A block holds 2**BITS consecutive ranks.  The binary digits of a rank are columns, and they are
   grouped away one after the other, the lowest first: what has equal digits left becomes the child
   structs of one node.  Blocks are dealt out once; the groupings inside need no further shuffle.
3. Blocks are the leaves of the next rollup, until a group is one block; then the groups' roots
   are rolled up in the same way, to the root of all.
4. From the top down, the nested children are transformed and exploded level by level, each child
   with its siblings; the rows of a block that are met this way are united with the block below by
   grouping on its name.  Nothing is joined, and no row holds more than a block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetspark.llm.common import stored
from sheetspark.llm.ranks import ranked

#: Binary digits of a rank that a block covers.
BITS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
PATH = T.ArrayType(STEP)


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_hash(values: Sequence[Column]) -> Column:
    """The hash of some values: ``-`` for null, else its length in bytes, a colon and itself."""
    texts = [v.cast("string") for v in values]
    return digest(
        F.concat(
            *(
                F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                for t in texts
            )
        )
    )


def _hashed(children: Column, place: Column) -> Column:
    """Whether nodes are hashed into the parent at a place of its level.

    Not if the first place has a single node: it is all that is left of the tree.
    """
    return (F.size(children) > 1) | (place > 0)


def _blocks(nodes: DataFrame, bits: int, label: str) -> DataFrame:
    """(tree, block, hash, children) from nodes (tree, rank, hash, payload)."""
    digits = [f"digit{i}" for i in range(bits)]
    rows = nodes.select(
        "tree",
        F.shiftright("rank", bits).alias("block"),
        *(F.shiftright("rank", i).bitwiseAND(1).cast("tinyint").alias(d) for i, d in enumerate(digits)),
        "hash",
        F.col("payload").alias("children"),
    ).repartition("tree", "block")
    for i, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("digit"), "hash", "children")
        rows = rows.groupBy("tree", "block", *digits[i + 1 :]).agg(
            F.sort_array(F.collect_list(child)).alias("children")
        )
        place = reduce(add, [F.col(d) for d in digits[i + 1 :]], F.col("block"))
        joined = digest(F.concat_ws("", F.col("children.hash")))
        rows = rows.withColumn(
            "hash",
            F.when(_hashed(F.col("children"), place), joined).otherwise(F.col("children")[0]["hash"]),
        )
    return stored(rows, label)


def _steps(children: Column, child: Column, place: Column) -> Column:
    """What stands before and after a child in its parent; nothing where there is no parent."""

    def side(keep) -> Column:
        return F.concat_ws("", F.transform(F.filter(children, keep), lambda c: c["hash"]))

    step = F.struct(
        side(lambda c: c["digit"] < child["digit"]).alias("before"),
        side(lambda c: c["digit"] > child["digit"]).alias("after"),
    )
    return F.when(_hashed(children, place), F.array(step)).otherwise(F.array().cast(PATH))


def _emitted(rows: DataFrame, bits: int, keep: Sequence[str]) -> DataFrame:
    """(keep, hash, path, payload): the leaves of nested blocks that have a ``path`` already."""
    rows = rows.withColumn("place", F.col("block"))
    for _ in range(bits):
        node = F.transform(
            "children",
            lambda c: F.struct(
                c["hash"].alias("hash"),
                c["children"].alias("children"),
                F.concat(_steps(F.col("children"), c, F.col("place")), F.col("path")).alias("path"),
                (F.col("place") * 2 + c["digit"]).alias("place"),
            ),
        )
        rows = rows.select(*keep, F.explode(node).alias("node")).select(*keep, "node.*")
    return rows.select(*keep, "hash", "path", F.col("children").alias("payload"))


def _met(blocks: DataFrame, above: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Blocks with the columns of the one row of ``above`` that has their name."""
    rows = blocks.unionByName(above, allowMissingColumns=True)
    found = [F.first(c, ignorenulls=True).alias(c) for c in ("hash", "children", *columns)]
    return rows.groupBy("tree", "block").agg(*found)


def merkle_proofs(
    df: DataFrame, group: str, order: Sequence[str], leaf: str, payload: Sequence[str], bits: int = BITS
) -> DataFrame:
    """Per row its ``payload`` columns, ``leaf``, ``path``, ``subroot`` and ``root``.

    The leaves of a group ascend by ``order``, nulls first; equal ones by their hash.  While a level
    has several nodes, every two consecutive ones become the hash of their hashes' hexadecimal texts,
    an odd last one that of its own.  What remains is the group's subroot; the subroots by group, null
    first, likewise give the root.  ``path`` holds, from the leaf to the root, what stands before and
    after the node in each parent; a level without a parent is left out.
    """
    kept = {name: F.col(name).alias(f"p_{i}") for i, name in enumerate(payload)}
    rows = df.select(
        F.col(group).alias("g"),
        *(F.col(c).alias(f"o_{i}") for i, c in enumerate(order)),
        F.col(leaf).alias("hash"),
        *kept.values(),
    )
    order = [*(f"o_{i}" for i in range(len(order))), "hash"]
    rows, groups, size = ranked(stored(rows, "merkle-leaves"), "g", order, "merkle-order")
    nodes = rows.select(
        "tree", "rank", "hash", F.struct(*(f"p_{i}" for i in range(len(payload)))).alias("payload")
    )
    levels = [_blocks(nodes, bits, "merkle-blocks")]

    def upwards(tree: Column, rank: Column, size: int) -> int:
        """Roll blocks up until ``size`` of them are one; how many are left."""
        nodes = levels[-1].select(
            tree.alias("tree"), rank.alias("rank"), "hash", F.struct(rank.alias("rank")).alias("payload")
        )
        levels.append(_blocks(nodes, bits, "merkle-blocks"))
        return -(-size >> bits)

    blocks = -(-size >> bits)
    while blocks > 1:
        blocks = upwards(F.col("tree"), F.col("block"), blocks)
    tops = len(levels)
    blocks = upwards(F.lit(0).cast("bigint"), F.col("tree"), groups)
    while blocks > 1:
        blocks = upwards(F.col("tree"), F.col("block"), blocks)

    empty = F.array().cast(PATH)
    top = levels[-1].select("*", empty.alias("path"), F.col("hash").alias("root"))
    for number in range(len(levels) - 1, 0, -1):
        inside = number < tops  # levels inside groups know the subroot
        keep = ["tree", "root", "subroot"] if inside else ["tree", "root"]
        found = _emitted(top, bits, keep)
        tree, block = F.col("tree"), F.col("payload.rank")
        if number == tops:  # from the roots of groups to the blocks that are a group
            tree, block = block, F.lit(0).cast("bigint")
        above = found.select(
            tree.alias("tree"), block.alias("block"), "path", "root", *(["subroot"] if inside else [])
        )
        top = _met(levels[number - 1], above, [c for c in above.columns if c not in ("tree", "block")])
        if number == tops:
            top = top.withColumn("subroot", F.col("hash"))
    leaves = _emitted(top, bits, ["root", "subroot"])
    return leaves.select(
        *(F.col(f"payload.p_{i}").alias(name) for i, name in enumerate(kept)),
        F.col("hash").alias("leaf"),
        "path",
        "subroot",
        "root",
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(
        path, leaf, lambda node, step: digest(F.concat(step["before"], node, step["after"]))
    )


def document_leaves(df: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, tampered): the hash of each row, and the one after tampering.

    Where 7 divides the CRC-32 of the decimal doc_id, tampering adds 1 to ``n_chars``; a null doc_id
    is never tampered with, and a null ``n_chars`` stays.  ``tampered`` is null where nothing is.
    """
    values = [F.col(c) for c in FIELDS]
    raised = [v.cast("decimal(20,0)") + 1 if c == "n_chars" else v for c, v in zip(FIELDS, values)]
    picked = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary")) % 7 == 0
    return df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "lang",
        leaf_hash(values).alias("leaf"),
        F.when(picked, leaf_hash(raised)).alias("tampered"),
    )


def manifest(df: DataFrame, bits: int = BITS) -> DataFrame:
    """Per row of documents: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``path``, ``proof_sha256``,
    ``folded_root`` and ``verified``.

    A leaf is the hash of doc_id, source, lang, n_chars and text; groups are languages, in which
    leaves ascend by doc_id (null first, equal ids by leaf).  ``proof_sha256`` hashes the siblings of
    the path end to end; ``folded_root`` follows the path from the tampered leaf where there is
    one.  Repeated rows are leaves of their own; empty texts are hashed as such; an empty table has
    no rows; other columns are not read.
    """
    proofs = merkle_proofs(
        document_leaves(df), "lang", ["doc_id"], "leaf", ["doc_id", "tampered"], bits
    )
    siblings = F.concat_ws("", F.transform("path", lambda s: F.concat(s["before"], s["after"])))
    end = folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        "path",
        digest(siblings).alias("proof_sha256"),
        end.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
