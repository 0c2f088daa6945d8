"""Words of a text, and hashes of them, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII but for letters and digits.  Fixed value.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """A-Z as a-z; other letters stay.  An ASCII text takes the fast way."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text, with A-Z as a-z."""
    return F.array_remove(F.split(lowered(text), BETWEEN), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def places(size: Column, least: int = 1) -> Column:
    """0 to size - 1; nothing if there are fewer than ``least``."""
    return F.when(size >= least, F.sequence(F.lit(0), size - 1)).otherwise(
        F.array().cast("array<int>")
    )


def runs(hashes: Column, n: int) -> Column:
    """A hash of every run of ``n`` items."""
    if n == 1:
        return hashes
    return F.transform(
        places(F.size(hashes) - (n - 1)),
        lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(n))),
    )


def window_minima(values: Column, width: int) -> Column:
    """The smallest value of every window of ``width`` values."""
    if width == 1:
        return values
    return F.transform(
        places(F.size(values) - (width - 1)),
        lambda i: F.least(*(F.get(values, i + k) for k in range(width))),
    )
