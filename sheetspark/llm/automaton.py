"""Deterministic automata over bytes, and their use on many texts at once.

Patterns are built from byte sets with the functions below, combined into one
automaton by subset construction, minimised, and stored as transition arrays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: Separates texts in a buffer; no byte of UTF-8 has this value.
BREAK = 0xFF


def one_of(chars: str) -> tuple:
    """One byte out of a set; ``a-z`` in ``chars`` is a span."""
    members, i = set(), 0
    while i < len(chars):
        if i + 2 < len(chars) and chars[i + 1] == "-":
            members.update(range(ord(chars[i]), ord(chars[i + 2]) + 1))
            i += 3
        else:
            members.add(ord(chars[i]))
            i += 1
    return ("byte", frozenset(members))


def word(text: str, any_case: bool = False) -> tuple:
    """The bytes of an ASCII text, letters also in the other case if ``any_case``."""
    forms = ({c.lower(), c.upper()} if any_case else {c} for c in text)
    return seq(*(("byte", frozenset(map(ord, form))) for form in forms))


def seq(*parts: tuple) -> tuple:
    return ("seq", parts)


def either(*parts: tuple) -> tuple:
    return ("either", parts)


def optional(part: tuple) -> tuple:
    return ("either", (part, ("seq", ())))


def many(part: tuple) -> tuple:
    """Any number of times, also none."""
    return ("many", part)


def some(part: tuple) -> tuple:
    """Once or more."""
    return seq(part, many(part))


def times(part: tuple, n: int) -> tuple:
    return seq(*[part] * n)


def mirrored(part: tuple) -> tuple:
    """The pattern of all matches read backwards."""
    kind, inner = part
    if kind == "byte":
        return part
    if kind == "seq":
        return seq(*(mirrored(x) for x in reversed(inner)))
    if kind == "either":
        return either(*(mirrored(x) for x in inner))
    return many(mirrored(inner))


class _Graph:
    """States with byte edges and free edges."""

    def __init__(self):
        self.free: list[list[int]] = []
        self.edges: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.edges.append([])
        return len(self.free) - 1

    def add(self, part: tuple, start: int) -> int:
        """Append ``part`` after ``start``; the state behind it."""
        kind, inner = part
        if kind == "byte":
            end = self.state()
            self.edges[start].append((inner, end))
            return end
        if kind == "seq":
            for x in inner:
                start = self.add(x, start)
            return start
        if kind == "either":
            end = self.state()
            for x in inner:
                self.free[self.add(x, start)].append(end)
            return end
        hub = self.state()
        self.free[start].append(hub)
        self.free[self.add(inner, hub)].append(hub)
        return hub

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for other in self.free[todo.pop()]:
                if other not in seen:
                    seen.add(other)
                    todo.append(other)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``table[state, classes[byte]]`` is the next state; state 0 is the first.

    ``accepts[state]`` has bit i set when pattern i matches up to here.
    """

    classes: np.ndarray
    table: np.ndarray
    accepts: np.ndarray


def compile_patterns(patterns: Sequence[tuple], anywhere: bool) -> Automaton:
    """One minimal automaton for all patterns; ``anywhere``: a match may begin at any byte."""
    graph = _Graph()
    root = graph.state()
    ends = {graph.add(p, root): i for i, p in enumerate(patterns)}
    sets = sorted({members for edges in graph.edges for members, _ in edges}, key=sorted)
    member = np.array([[b in s for s in sets] for b in range(256)], dtype=bool).reshape(256, -1)
    kinds, classes = np.unique(member, axis=0, return_inverse=True)
    classes = classes.reshape(-1)
    sample = [int(np.flatnonzero(classes == k)[0]) for k in range(len(kinds))]

    first = graph.closure([root])
    numbers, order, rows = {first: 0}, [first], []
    while len(rows) < len(order):
        here = order[len(rows)]
        row = []
        for byte in sample:
            if byte == BREAK:
                target = first
            else:
                reached = {t for s in here for members, t in graph.edges[s] if byte in members}
                target = graph.closure(reached | ({root} if anywhere else set()))
            if target not in numbers:
                numbers[target] = len(order)
                order.append(target)
            row.append(numbers[target])
        rows.append(row)
    table = np.array(rows, dtype=np.int64)
    accepts = np.array([sum(1 << ends[s] for s in here if s in ends) for here in order])
    return _minimal(classes.astype(np.int64), table, accepts)


def _minimal(classes: np.ndarray, table: np.ndarray, accepts: np.ndarray) -> Automaton:
    """Merge states that no continuation tells apart, refining blocks until they hold."""
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        signature = np.concatenate([block[:, None], block[table]], axis=1)
        refined = np.unique(signature, axis=0, return_inverse=True)[1].reshape(-1)
        if refined.max() == block.max():
            break
        block = refined
    count = block.max() + 1
    member = np.zeros(count, dtype=np.int64)
    member[block[::-1]] = np.arange(len(block))[::-1]
    # The first state gets number 0, accepting states the highest numbers.
    order = sorted(range(count), key=lambda b: (b != block[0], accepts[member[b]] != 0, b))
    number = np.empty(count, dtype=np.int64)
    number[order] = np.arange(count)
    members = member[order]
    return Automaton(classes, number[block[table[members]]], accepts[members])


def scan(automaton: Automaton, data: np.ndarray, lane: int = 512, block: int = 1 << 22):
    """Positions in ``data`` at which a pattern is complete, and which patterns (bits).

    The buffer is cut into lanes that advance together, one byte of each per step.  A lane
    starts from the first state; where the lane before it ended in another one, it runs again
    from there, as far as needed, so the result is that of a single pass of any length.
    Blocks of lanes follow one another and bound the memory.
    """
    places, found, state = [], [], 0
    for at in range(0, len(data), block):
        place, bits, state = _scan_block(automaton, data[at : at + block], state, lane)
        places.append(place + at)
        found.append(bits)
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *places]), np.concatenate([nothing, *found])


def _scan_block(automaton: Automaton, data: np.ndarray, first: int, lane: int):
    size, width = len(data), automaton.table.shape[1]
    lanes = -(-size // lane)
    steps = np.full(lanes * lane, automaton.classes[BREAK], dtype=np.int32)
    steps[:size] = automaton.classes.astype(np.int32)[data]
    steps = np.ascontiguousarray(steps.reshape(lanes, lane).T)
    table = (automaton.table * width).astype(np.int32).reshape(-1)
    accepting = automaton.accepts != 0
    least = int(np.argmax(accepting)) * width if accepting.any() else int(table.max()) + 1
    states = np.empty((lane, lanes), dtype=np.int32)
    entry = np.zeros(lanes, dtype=np.int32)
    now = entry
    for i in range(lane):
        now = np.take(table, now + steps[i], out=states[i], mode="clip")
    while True:
        wanted = np.concatenate([[first * width], states[-1, :-1]]).astype(np.int32)
        again = np.flatnonzero(wanted != entry)
        if not len(again):
            break
        entry[again] = wanted[again]
        now = wanted[again]
        for i in range(lane):
            now = table[now + steps[i, again]]
            differs = now != states[i, again]
            again, now = again[differs], now[differs]
            if not len(again):
                break
            states[i, again] = now
    at, number = np.nonzero(states >= least)
    place = number * lane + at
    bits = automaton.accepts[states[at, number] // width]
    order = np.argsort(place, kind="stable")
    order = order[place[order] < size]
    last = int(states[(size - 1) % lane, (size - 1) // lane]) // width
    return place[order], bits[order], last


class Walker:
    """An automaton for single matches, byte by byte."""

    def __init__(self, automaton: Automaton):
        self.classes = automaton.classes.tolist()
        self.table = automaton.table.tolist()
        self.accepts = automaton.accepts.tolist()
        self.dead = {
            s for s, row in enumerate(self.table) if not self.accepts[s] and set(row) == {s}
        }

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at ``start``; -1 if there is none."""
        state, end = 0, -1
        for i in range(start, len(data)):
            state = self.table[state][self.classes[data[i]]]
            if self.accepts[state]:
                end = i + 1
            elif state in self.dead:
                break
        return end
