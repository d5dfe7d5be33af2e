"""One deterministic automaton for many byte patterns, as plain transition arrays.

Patterns are ordinary regular expressions of literals, classes, groups, alternation and
greedy repetition.  They become one nondeterministic automaton, subset construction makes
it deterministic, partition refinement makes it minimal.  Every state carries a bit mask of
the patterns that end there.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np


class Automaton(NamedTuple):
    """``step[state + byte_class[b]]`` is the next state; states are multiplied by ``classes``.

    State 0 is the start.  Class ``classes - 1`` is no byte: it leads back to the start.
    """

    step: np.ndarray
    byte_class: np.ndarray
    accept: np.ndarray
    classes: int


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.byte: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.byte.append([])
        return len(self.empty) - 1

    def add(self, items, at: int, backward: bool) -> int:
        """Appends parsed pattern items after state ``at``; returns the state behind them."""
        for op, arg in reversed(list(items)) if backward else items:
            at = self._one(op, arg, at, backward)
        return at

    def _one(self, op, arg, at, backward):
        if op in (C.LITERAL, C.NOT_LITERAL, C.IN, C.ANY):
            end = self.state()
            self.byte[at].append((_byte_set(op, arg), end))
            return end
        if op is C.SUBPATTERN:
            return self.add(arg[3], at, backward)
        if op is C.BRANCH:
            end = self.state()
            for choice in arg[1]:
                self.empty[self.add(choice, at, backward)].append(end)
            return end
        if op is C.MAX_REPEAT:
            least, most, items = arg
            for _ in range(least):
                at = self.add(items, at, backward)
            end = self.state()
            if most is C.MAXREPEAT:
                loop = self.state()
                self.empty[at].append(loop)
                self.empty[self.add(items, loop, backward)].append(loop)
                self.empty[loop].append(end)
                return end
            for _ in range(most - least):
                self.empty[at].append(end)
                at = self.add(items, at, backward)
            self.empty[at].append(end)
            return end
        raise ValueError(f"unsupported in a pattern: {op}")

    def closures(self) -> list[int]:
        """Per state, the bit set of states that it reaches without a byte, itself included."""
        out = []
        for state in range(len(self.empty)):
            seen, todo = 1 << state, [state]
            while todo:
                for nxt in self.empty[todo.pop()]:
                    if not seen >> nxt & 1:
                        seen |= 1 << nxt
                        todo.append(nxt)
            out.append(seen)
        return out


def _bits(x: int) -> list[int]:
    out = []
    while x:
        low = x & -x
        out.append(low.bit_length() - 1)
        x ^= low
    return out


def _byte_set(op, arg) -> frozenset:
    if op is C.LITERAL:
        return frozenset([arg])
    if op is C.NOT_LITERAL:
        return frozenset(range(256)) - {arg}
    if op is C.ANY:
        return frozenset(range(256)) - {10}
    out, negate = set(), False
    for kind, value in arg:
        if kind is C.NEGATE:
            negate = True
        elif kind is C.LITERAL:
            out.add(value)
        elif kind is C.RANGE:
            out.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"unsupported in a class: {kind}")
    return frozenset(range(256)) - out if negate else frozenset(out)


def byte_members(pattern: str) -> np.ndarray:
    """The bytes of a single class such as ``[a-f]``, as a mask."""
    [(op, arg)] = list(parser.parse(pattern))
    return np.isin(np.arange(256), sorted(_byte_set(op, arg)))


def compile_patterns(patterns: Sequence[str], anywhere: bool = True, backward: bool = False) -> Automaton:
    """The minimal automaton of up to 8 byte patterns.

    ``anywhere`` lets a match begin at every byte; without it, one begins at the first byte
    only.  ``backward`` reads the text from right to left.
    """
    if len(patterns) > 8:
        raise ValueError("one automaton marks at most 8 patterns")
    nfa = _Nfa()
    begin = nfa.state()
    finals = {}
    for bit, pattern in enumerate(patterns):
        finals[nfa.add(list(parser.parse(pattern)), begin, backward)] = 1 << bit

    # Bytes that no pattern tells apart share a class.
    sets = sorted({s for row in nfa.byte for s, _ in row}, key=sorted)
    marks = [tuple(b in s for s in sets) for b in range(256)]
    kinds = {m: i for i, m in enumerate(dict.fromkeys(marks))}
    byte_class = np.array([kinds[m] for m in marks], dtype=np.uint8)
    sample = [marks.index(m) for m in kinds]
    classes = len(kinds) + 1
    if classes > 256:
        raise ValueError("too many byte classes")

    closures = nfa.closures()
    moves = [
        [(k, closures[end]) for chars, end in row for k, byte in enumerate(sample) if byte in chars]
        for row in nfa.byte
    ]
    start = closures[begin]
    index, rows, todo = {start: 0}, [], [start]
    for state in todo:
        row = [start if anywhere else 0] * len(sample)
        for s in _bits(state):
            for k, reached in moves[s]:
                row[k] |= reached
        for nxt in row:
            if nxt not in index:
                index[nxt] = len(index)
                todo.append(nxt)
        rows.append([*(index[nxt] for nxt in row), 0])
    ends = sum(1 << s for s in finals)
    masks = [sum({finals[s] for s in _bits(state & ends)}) for state in index]
    return _minimal(np.array(rows), np.array(masks), byte_class, classes)


def _minimal(rows, masks, byte_class, classes) -> Automaton:
    """Merges states that no further byte can tell apart."""
    group = np.unique(masks, return_inverse=True)[1]
    while True:
        finer = np.unique(np.column_stack([group, group[rows]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == group.max():
            break
        group = finer
    # The start's group becomes 0.
    names = np.arange(group.max() + 1)
    names[[0, group[0]]] = names[[group[0], 0]]
    group = names[group]
    first = np.unique(group, return_index=True)[1]
    step = (group[rows[first]] * classes).astype(np.int32).ravel()
    accept = np.repeat(masks[first].astype(np.uint8), classes)
    return Automaton(step, byte_class, accept, classes)


LANES = 4096


def run(machine: Automaton, symbols: np.ndarray) -> np.ndarray:
    """The accept mask behind every symbol (byte classes) of a text, by one pass over it.

    The text is cut into lanes that step together.  Each lane first assumes the start state;
    a lane whose predecessor ended elsewhere is then repeated until both runs agree, which
    takes a few steps, so the result is that of one serial run.
    """
    n = len(symbols)
    if n == 0:
        return np.empty(0, dtype=np.uint8)
    width = -(-n // LANES)
    lanes = -(-n // width)
    padded = np.full(lanes * width, machine.classes - 1, dtype=np.uint8)
    padded[:n] = symbols
    by_step = np.ascontiguousarray(padded.reshape(lanes, width).T)
    states = np.empty((width, lanes), dtype=np.int32)
    at = np.zeros(lanes, dtype=np.int32)
    for t in range(width):
        at = machine.step.take(at + by_step[t])
        states[t] = at
    came = np.zeros(lanes, dtype=np.int32)
    while True:
        true = np.concatenate([[0], states[-1, :-1]]).astype(np.int32)
        lane = np.flatnonzero(true != came)
        if not len(lane):
            break
        came[lane] = true[lane]
        at = true[lane]
        for t in range(width):
            at = machine.step.take(at + by_step[t, lane])
            changed = at != states[t, lane]
            states[t, lane] = at
            lane, at = lane[changed], at[changed]
            if not len(lane):
                break
    return np.ascontiguousarray(machine.accept.take(states).T).ravel()[:n]
