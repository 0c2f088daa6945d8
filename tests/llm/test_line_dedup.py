"""Line dedup against every run of lines of every text."""

from __future__ import annotations

import random
import re

from sheetspark.llm.line_dedup import deduplicate_lines

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows):
    seen, out = set(), []
    # A run of n lines is repeated if it stands earlier; texts come by id.
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        lines, gone = text.split("\n"), set()
        for i in range(len(lines)):
            for n in (1, 2, 3):
                run = tuple(lines[i : i + n])
                if len(run) < n or n < 3 and sum(len(WORD.findall(x)) for x in run) < 50:
                    continue
                if run in seen:
                    gone.update(range(i, i + n))
                seen.add(run)
        left = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, len(lines), len(gone), left if gone else text))
    known = {(r[0]): r for r in out}
    return sorted((known[doc_id] for doc_id, _ in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in deduplicate_lines(df).collect()), key=str)


def test_runs(spark):
    rng = random.Random(7)
    pool = [f"line {i}" for i in range(12)] + ["", "é 日本"]
    pool += [" ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate((24, 26, 30, 49, 50, 70))]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(1, 12)))) for i in range(120)]
    want = plain(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == want
    assert 100 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_edges(spark):
    hot = "a\nb\nc"
    rows = [
        (1, None, 1), (2, "", 2), (3, "", 3), (4, "a\n" * 5_000, 4), (5, hot, 5), (5, hot, 5),
        (6, "x\n" + hot + "\ny", 6), (None, hot, 7), (8, "word " * 60_000, 8),
        (9, "word " * 60_000 + "\n\n\n\n\n", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines int")
    assert got(df) == plain([r[:2] for r in rows])
    assert deduplicate_lines(df.limit(0)).count() == 0
    # Rows that repeat an id only: one of them keeps the lines.
    df = spark.createDataFrame([(1, hot + "\nd"), (1, hot + "\ne")], "doc_id long, text string")
    assert sorted(r[2] for r in got(df)) == [0, 3]
