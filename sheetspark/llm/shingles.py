"""Hashes of words and of word shingles for whole batches of texts, in numpy."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Bytes that are hashed together; bounds the memory for texts of any length.
BLOCK = 1 << 21


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * _MIX[0]
    values = values ^ (values >> np.uint64(27))
    values = values * _MIX[1]
    return values ^ (values >> np.uint64(31))


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, in order, and how many words each text has.

    Words are runs of bytes other than space, tab and the line breaks; A-Z count as a-z.
    """
    begins = np.zeros(len(flat) + 1, dtype=bool)
    begins[offsets[:-1]] = True
    begins = begins[: len(flat)]
    inside = ~_SPACE[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begins[1:]
    starts = np.flatnonzero(first)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        last = np.searchsorted(starts, starts[at] + BLOCK)
        end = starts[last] if last < len(starts) else len(flat)
        keep = inside[starts[at] : end]
        data = _LOWER[flat[starts[at] : end][keep]].astype(np.uint64)
        place = np.cumsum(keep) - 1
        heads = place[starts[at:last] - starts[at]]
        sizes = np.diff(np.append(heads, len(data)))
        within = np.arange(len(data)) - np.repeat(heads, sizes)
        powers = np.cumprod(np.full(sizes.max() + 1, _BASE, dtype=np.uint64))
        out[at:last] = np.add.reduceat((data + np.uint64(1)) * powers[within], heads)
        out[at:last] += sizes.astype(np.uint64)
        at = last
    return mixed(out), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words of each text, and how many each text has.

    A text of fewer words, but some, has its whole sequence as one.
    """
    ends = np.cumsum(counts)
    per_text = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = (ends - counts)[owner] + nth
    out = np.minimum(counts, n)[owner].astype(np.uint64)
    for k in range(n):
        there = begin + k
        value = words[np.minimum(there, max(len(words) - 1, 0))] if len(words) else out
        step = mixed(out * _BASE + value)
        out = np.where(there < ends[owner], step, out)
    return out, per_text
