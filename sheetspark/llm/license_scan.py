"""Licenses named in texts: ordered signature rules behind a keyword prefilter.

Texts with a gate word are cut into words, and each rule whose keyword they hold is matched over
the words.  All of it happens in the row, in built-in functions: nothing is shuffled or stored.  A detection gives way to one of a better rule, or to a longer one of an equal rule,
that contains it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetspark.llm.license_rules import BASE, BASE_CERTAINTY, CERTAINTY, GATES, RULES, LicenseRule
from sheetspark.llm.words import places, word_count, words


def _phrase_places(phrase: tuple[str, ...]) -> Column:
    """Starts of a phrase among ``words``."""

    def here(i: Column) -> Column:
        return reduce(
            lambda a, b: a & b, (F.get("words", i + k) == w for k, w in enumerate(phrase))
        )

    return F.filter(places(F.size("words") - len(phrase) + 1), here)


#: A detection; arrays of them sort by start, then longest first, then priority.
DETECTION = "struct<start:int,turned:int,priority:int,end:int,label:string>"


def _matches(rule: LicenseRule) -> str:
    """SQL for the detections of a rule in ``joined``, words with one space between.

    Each match is taken with the gap before it, from where the last one ended; the spaces in them
    count the words.  The pattern is a literal, which a task compiles once.
    """
    pattern = rf"r'(?s)\G(.*?)(?<![^ ])(?:{rule.regex})(?![^ ])'"
    gap, whole = (f"regexp_extract_all(joined, {pattern}, {group})" for group in (1, 0))
    spaces = "length({0}) - length(replace({0}, ' ', ''))"
    counts = f"(g, w) -> struct({spaces.format('g')} AS g, {spaces.format('w')} AS w)"
    end = "s.before + p.w + 1"
    one = (
        f"named_struct('start', s.before + p.g, 'turned', -({end}), 'priority', {rule.priority},"
        f" 'end', {end}, 'label', '{rule.label}')"
    )
    return (
        f"aggregate(zip_with({gap}, {whole}, {counts}),"
        f" named_struct('before', 0, 'found', CAST(array() AS array<{DETECTION}>)),"
        f" (s, p) -> named_struct('before', s.before + p.w, 'found', concat(s.found, array({one}))),"
        " s -> s.found)"
    )


def _suppressed(found: Column) -> Column:
    """The detections that no other one suppresses.

    ``found`` is an array of (start, longest first, priority, end, label), sorted; a scan keeps
    the furthest end seen for each priority.  What begins no later and ends no earlier contains.
    Detections of one span and priority stay or go together.
    """
    levels = sorted(CERTAINTY)
    kept = F.array().cast("array<struct<priority:int,label:string>>")
    none = F.lit(None).cast("struct<start:int,end:int,priority:int>")
    start = F.struct(
        F.array(*(F.lit(-1) for _ in levels)).alias("ends"),
        none.alias("last"),
        F.lit(False).alias("stayed"),
        kept.alias("kept"),
    )

    def step(state: Column, d: Column) -> Column:
        level = F.lit(len(levels) - 1)
        for i, priority in reversed(list(enumerate(levels))):
            level = F.when(d["priority"] == priority, F.lit(i)).otherwise(level)
        own = F.struct(d["start"].alias("start"), d["end"].alias("end"), d["priority"].alias("priority"))
        best = F.array_max(F.slice(state["ends"], F.lit(1), level + 1))
        stays = F.when(state["last"].eqNullSafe(own), state["stayed"]).otherwise(best < d["end"])
        ends = F.transform(
            state["ends"],
            lambda end, i: F.when(i == level, F.greatest(end, d["end"])).otherwise(end),
        )
        one = F.array(F.struct(d["priority"].alias("priority"), d["label"].alias("label")))
        return F.struct(
            ends.alias("ends"),
            own.alias("last"),
            stays.alias("stayed"),
            F.when(stays, F.concat(state["kept"], one)).otherwise(state["kept"]).alias("kept"),
        )

    return F.aggregate(found, start, step, lambda state: state["kept"])


def _detected() -> Column:
    """All detections in ``joined``, sorted; a rule is tried where its keyword occurs.

    In SQL, because hundreds of rules are thousands of calls as columns.
    """
    found = []
    for keyword in sorted({r.keyword for r in RULES}):
        rules = ", ".join(_matches(r) for r in RULES if r.keyword == keyword)
        found.append(
            f"CASE WHEN contains(joined, '{keyword}') THEN flatten(array({rules}))"
            f" ELSE CAST(array() AS array<{DETECTION}>) END"
        )
    return F.expr(f"sort_array(array_distinct(flatten(array({', '.join(found)}))))")


def find_licenses(df: DataFrame) -> DataFrame:
    """Per row of ``df``: words, places of the base phrases, labels and a score.

    Words are runs of letters, digits and non-ASCII characters; A-Z count as a-z.  ``n_base``
    counts all places of the phrases of ``BASE``; ``first_word`` and ``last_word`` are the smallest
    and largest of their starts, null without any.  ``labels`` are the base labels and those of the
    rules' detections that stay, ``score`` is the certainty of the best of them, 0 without any.
    A null or empty text has no words.  Rows that repeat are scanned each; other columns are not
    read.
    """
    texts = df.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    # The array makes the lower case once for all gates.
    gate = F.exists(
        F.array(F.lower("text")),
        lambda lower: reduce(or_, (F.contains(lower, F.lit(g)) for g in GATES)),
    )
    gated = texts.select(
        "doc_id",
        F.when(gate, words(F.col("text"))).alias("words"),
        word_count(F.col("text")).alias("n_words"),
    )
    joined = gated.select("*", F.array_join("words", " ").alias("joined"))
    # Null, and not looked at, where the gate is closed.
    held = F.col("words").isNotNull()
    starts = {label: F.when(held, _phrase_places(phrase)) for label, phrase in BASE.items()}
    kept = F.when(held, _suppressed(_detected()))
    found = joined.select("doc_id", "n_words", *(x.alias(label) for label, x in starts.items()), kept.alias("kept"))
    nothing = F.array().cast("array<string>")
    every = found.select(
        "*",
        F.concat(*BASE).alias("every"),
        F.coalesce(
            F.array_compact(F.array(*(F.when(F.size(x) > 0, F.lit(x)) for x in sorted(BASE)))), nothing
        ).alias("own"),
        F.coalesce(F.transform("kept", lambda k: k["label"]), nothing).alias("more"),
        F.array_min(F.transform("kept", lambda k: k["priority"])).alias("best"),
    )
    certainty = F.when(F.size("own") > 0, F.lit(BASE_CERTAINTY)).otherwise(F.lit(0.0))
    for priority, value in CERTAINTY.items():
        sure = F.when(F.col("best") == priority, F.lit(value)).otherwise(F.lit(0.0))
        certainty = F.greatest(certainty, sure)
    return every.select(
        "doc_id",
        "n_words",
        F.coalesce(F.greatest(F.size("every"), F.lit(0)), F.lit(0)).cast("bigint").alias("n_base"),
        F.array_min("every").cast("bigint").alias("first_word"),
        F.array_max("every").cast("bigint").alias("last_word"),
        F.array_join("own", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("own", "more")), ",").alias("labels"),
        certainty.alias("score"),
    )
