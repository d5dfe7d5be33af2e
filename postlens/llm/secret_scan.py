"""Secrets in texts, by one pass of a combined automaton over the bytes of all rules.

A rule is a pattern and a class of bytes that continue it.  The forward automaton of all
rules marks, in one pass, where a rule's patterns end; from a mark, the rule's backward
automaton finds where the match begins, and its class how far it goes on.  That gives *all* matches of
a rule, overlapping ones too.  Those that a leftmost, non-overlapping search reports are
flagged ``base``; the others are added where no base span of their kind contains them.

Defined results: a null or empty text has no spans; repeated rows are scanned each on
their own; a null id is kept.  Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm import automaton as A
from postlens.llm.batches import bounded, slices, two_columns


class Rule(NamedTuple):
    """Matches of ``pattern``, continued by bytes of the class ``tail`` as far as they go.

    Matches whose last pattern byte and tail together have fewer than ``least`` bytes are
    dropped; like any match they hide what begins inside them.
    """

    kind: str
    pattern: str
    tail: str
    least: int = 1


def either_case(text: str) -> str:
    """The pattern ``text`` with its letters in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in text)


_NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

# The rules of the scan.
RULES = (
    Rule("assign", rf"(?:{_NAMES})[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]", "[A-Za-z0-9+/_.=-]", 6),
    Rule("access", r"AKIA[A-Z0-9]{16}", "[A-Z0-9]"),
    Rule("hex", r"[0-9a-f]{24}", "[0-9a-f]"),
)

SPAN = "struct<kind:string,start:bigint,end:bigint,base:boolean>"


class Scanner:
    """Up to eight compiled rules.  It is small and travels to the tasks with the function that uses it."""

    def __init__(self, rules: Sequence[Rule] = RULES):
        self.rules = tuple(rules)
        self.forward = A.compile_patterns([r.pattern for r in rules])
        self.tails = [A.byte_members(r.tail) for r in rules]
        self.backward = []
        for rule in rules:
            m = A.compile_patterns([rule.pattern], anywhere=False, backward=True)
            self.backward.append((m.step.tolist(), m.byte_class.tolist(), m.accept.tolist(), _dead_state(m)))

    def _begin(self, rule: int, data: np.ndarray, low: int, last: int) -> int:
        """Leftmost begin of a match of the rule that ends with byte ``last``."""
        step, byte_class, accept, dead = self.backward[rule]
        state, begin = 0, last
        for at in range(last, low - 1, -1):
            state = step[state + byte_class[data[at]]]
            if accept[state]:
                begin = at
            elif state == dead:
                break
        return begin

    def scan(self, texts: pa.Array) -> list[list[tuple[str, int, int, bool]]]:
        """Per text, the spans ``(kind, start, end, base)`` by start, then in rule order."""
        raw = texts.cast(pa.large_binary())
        bounds = np.frombuffer(raw.buffers()[1], dtype=np.int64, count=len(raw) + 1, offset=raw.offset * 8)
        body = raw.buffers()[2]
        data = np.frombuffer(body, dtype=np.uint8)[bounds[0] : bounds[-1]] if body else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        # A symbol that is no byte stands behind every text and sends the automaton to its start.
        symbols = np.full(len(data) + len(raw), self.forward.classes - 1, dtype=np.uint8)
        inside = np.ones(len(symbols), dtype=bool)
        inside[bounds[1:] + np.arange(len(raw))] = False
        symbols[inside] = self.forward.byte_class[data]
        marks = A.run(self.forward, symbols)
        found: dict[int, list] = {}
        hits = np.flatnonzero(marks)
        stops = bounds[1:] + np.arange(1, len(raw) + 1)
        for number, rule in enumerate(self.rules):
            heads = hits[marks[hits] >> number & 1 == 1]
            heads = heads[np.insert(np.diff(heads) > 1, 0, True)[: len(heads)]]  # of neighbours the leftmost match
            rows = np.searchsorted(stops, heads, side="right")
            end = 0
            for row, head in zip(rows.tolist(), (heads - rows).tolist(), strict=True):
                begin = self._begin(number, data, int(bounds[row]), head)
                if head >= end:  # else the same run of tail bytes goes on
                    end = _run_end(data, head + 1, int(bounds[row + 1]), self.tails[number])
                found.setdefault(row, []).append((begin, number, end, end - head >= rule.least))
        return [self._spans(found[i], data, int(bounds[i])) if i in found else [] for i in range(len(raw))]

    def _spans(self, matches, data, low):
        matches.sort()
        free, covered = [0] * len(self.rules), [0] * len(self.rules)
        kept = []
        for begin, number, end, long_enough in matches:
            base = begin >= free[number]
            if base:
                free[number] = end
            if long_enough and (base or end > covered[number]):
                kept.append((begin, number, end, base))
                covered[number] = max(covered[number], end)
        # Bytes that continue a character are no code points.  Matches are in order of their begin.
        out, seen, points = [], low, 0
        for begin, number, end, base in kept:
            points += _points(data[seen:begin])
            seen = begin
            out.append((self.rules[number].kind, points, points + _points(data[begin:end]), base))
        return out


def _run_end(data: np.ndarray, at: int, stop: int, members: np.ndarray) -> int:
    """Where the run of member bytes that begins at ``at`` ends, ``stop`` at most."""
    step = 64
    while at < stop:
        others = np.flatnonzero(~members[data[at : min(at + step, stop)]])
        if len(others):
            return at + int(others[0])
        at, step = at + step, 2 * step
    return stop


def _points(data: np.ndarray) -> int:
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _dead_state(m: A.Automaton) -> int:
    """The state that loops to itself on all bytes without accepting, or -1."""
    for state in range(0, len(m.step), m.classes):
        if not m.accept[state] and (m.step[state : state + m.classes - 1] == state).all():
            return state
    return -1


def scan_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(id, spans)`` per row of ``df``; ``spans`` is an array of ``(kind, start, end, base)``."""
    scanner = Scanner(rules)
    source = two_columns(df, id_col, text_col)
    key = source.schema["k"].dataType.simpleString()
    kinds = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "base")
        for batch in batches:
            for part in slices(batch):
                rows = [[dict(zip(names, s, strict=True)) for s in spans] for spans in scanner.scan(part.column("v"))]
                yield pa.RecordBatch.from_arrays([part.column("k"), pa.array(rows, kinds)], ["k", "spans"])

    return source.mapInArrow(work, f"k {key}, spans array<{SPAN}>").withColumnRenamed("k", id_col)


def digest(scanned: DataFrame) -> DataFrame:
    """Counts of base spans per kind, the SHA-256 of the base spans, and all spans as text."""
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    keys = [c for c in scanned.columns if c != "spans"]
    return scanned.select(
        *keys,
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in RULES],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )


def redact(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """``df`` with every span of its texts replaced by ``[kind]``; texts without spans stay as they are."""
    scanner = Scanner(rules)
    schema, position = df.schema, df.columns.index(text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(position)
                spans = scanner.scan(texts.fill_null(""))
                if any(spans):
                    new = [_cut(t, s) if s else t for t, s in zip(texts.to_pylist(), spans, strict=True)]
                    part = part.set_column(position, part.schema.field(position), pa.array(new, texts.type))
                yield part

    return bounded(df).mapInArrow(work, schema)


def _cut(text: str, spans) -> str:
    out, at = [], 0
    for kind, start, end, _ in spans:
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def base_digest(spans) -> str:
    """The digest of base spans in plain Python, for checks."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e, b in spans if b).encode()).hexdigest()
