"""Merkle proofs against a tree built in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from sheetspark.llm.manifest import FIELDS, manifest, merkle_proofs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    values = [row[c] for c in FIELDS]
    if row["n_chars"] is not None:
        values[FIELDS.index("n_chars")] += more
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def plain(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
    trees = [levels([leaf_of(r) for r in groups[lang]]) for lang in order]
    top = levels([tree[-1][0] for tree in trees])
    root = top[-1][0] if rows else None
    found = []
    for number, lang in enumerate(order):
        for place, row in enumerate(groups[lang]):
            doc_id = row["doc_id"]
            hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
            node, siblings = leaf_of(row, int(hit)), ""
            for tree, at in ((trees[number], place), (top, number)):
                for level in tree[:-1]:
                    pair = level[at // 2 * 2 : at // 2 * 2 + 2]
                    before, after = "".join(pair[: at % 2]), "".join(pair[at % 2 + 1 :])
                    siblings += before + after
                    node, at = digest(before, node, after), at // 2
            found.append(
                (doc_id, leaf_of(row), trees[number][-1][0], root, digest(siblings), node, node == root)
            )
    return sorted(found, key=str)


def result(df, bits):
    return sorted((tuple(r) for r in manifest(df, bits).drop("path").collect()), key=str)


@pytest.mark.parametrize("bits", [2, 8])
def test_documents(spark, bits):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = result(df, bits)
    assert got == plain([r.asDict() for r in df.collect()])
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [1, 1], [4], [5, 1, 16, 17], [3, 2, 1, 1, 1]])
def test_sizes(spark, sizes):
    rows = [
        (100 * g + i, f"text {i}", f"lang {g}", None, i, "clash", 7)
        for g, n in enumerate(sizes)
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df, 2) == plain([r.asDict() for r in df.collect()])


def test_edges(spark):
    """Nulls in every column, repeated rows and ids, empty and long texts, the largest number."""
    long = "wörd\n" * 200_000
    rows = [
        (None, None, None, None, None, None, None),
        (None, "", None, "s", 3, None, 1),
        (1, "a", "", None, 2**63 - 1, None, 1),
        (1, "a", "", None, 2**63 - 1, None, 1),
        (1, "b", "", "-", None, None, 1),
        (-5, long, "é", "1:x", 0, "x", None),
        (7, long, "z", "1:x", 0, "x", None),
    ] + [(20 + i, "t", "é", None, i, None, None) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = result(df, 2)
    assert got == plain([r.asDict() for r in df.collect()])
    assert len(got) == len(rows)
    assert result(df.limit(0), 2) == []


def test_many_groups(spark):
    """Far more groups than a block holds, and all rows of one group beside them."""
    rows = [(i, "t", f"{i:04}" if i < 90 else "hot", "s", i, None, None) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(df, 2) == plain([r.asDict() for r in df.collect()])


def test_no_joins(spark, plan):
    df = spark.createDataFrame([(i, "t", "en", "s", i, None, None) for i in range(40)], SCHEMA)
    proofs = merkle_proofs(
        df.selectExpr("doc_id", "lang", "md5(text) AS leaf"), "lang", ["doc_id"], "leaf", ["doc_id"], 2
    )
    assert "Join" not in plan(proofs)
    assert proofs.where("size(path) = 6").count() == 40
