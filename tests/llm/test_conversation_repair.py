"""Repairs against a search over all edit strings in order of cost and audit."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from postlens.llm import conversation_repair as cr

SPACES = " \t\n\x0b\f\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        names = [" " if x is None else x for x in (conv, turn, role, text)]
        conv_s, turn_s, role, text = names
        fault = zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(turn, role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows, faults):
    """Least (cost, audit) by search over states (row, written initials' last, audit)."""
    heap = [(0, "", 0, "", ())]
    best = {}
    while heap:
        cost, audit, at, last, made = heapq.heappop(heap)
        # A state is settled by its cheapest cost; equal costs may still give a smaller audit.
        if best.get((at, last), cost) < cost:
            continue
        best[at, last] = cost
        if at == len(rows) and last in ("", "a"):
            return cost, audit, made, heap, best
        follow = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        need = follow[-1]
        name = {"u": "user", "a": "assistant"}[need]
        if len(audit) < 3 * len(rows) + 4:
            heapq.heappush(heap, (cost + 2, audit + "I", at, need, made + (f"{name}:",)))
        if at < len(rows):
            _, role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, last, made))
            if faults[at] in ("fine", "truncated"):
                late = faults[at] == "truncated"
                if role[:1] and role[:1] in follow:
                    heapq.heappush(heap, (cost + late, audit + "K", at + 1, role[:1], made + (f"{role}:{text}",)))
                heapq.heappush(heap, (cost + 2 + late, audit + "R", at + 1, need, made + (f"{name}:{text}",)))
    raise AssertionError


def expected(conv, rows):
    rows = damaged(rows)
    # The order of rows of one turn is by role and a hash of the text; the tests use one text per turn and role.
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    faults, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "fine" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, made, *_ = cheapest(rows, faults)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
    return (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


TEXTS = ["Fine.", "Also fine!", "Really? ", "cut off", " \n", "", None, "no end\t", "x" * 3000 + "."]


def conversation(rng, conv, n, duplicates=True):
    rows = []
    turn = 0
    for _ in range(n):
        turn += rng.choice([1, 1, 1, 1, 3])
        role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
        text = rng.choice(TEXTS) if rng.random() < 0.4 or not duplicates else f"row {rng.randrange(5 * n)}."
        rows.append((conv, turn if rng.random() < 0.97 else None, role, text))
    # One null turn at most, so the order does not depend on hashes.
    nulls = [i for i, r in enumerate(rows) if r[1] is None]
    return [r for i, r in enumerate(rows) if i not in nulls[1:]]


def table(spark, rows):
    rows = [(*r, "gone", 7) for r in rows]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, open int")


def results(df):
    return {r.conv: tuple(r) for r in df.collect()}


@pytest.mark.parametrize("segment_rows", [cr.SEGMENT_ROWS, 3, 1])
def test_against_search(spark, segment_rows):
    """Whole conversations, and the same ones cut into segments."""
    rng = random.Random(11)
    talks = {c: conversation(rng, c, rng.randint(1, 8)) for c in range(150)}
    talks |= {None: conversation(rng, None, 5), 500: conversation(rng, 500, 14)}
    found = results(cr.repair(cr.damage(table(spark, [r for t in talks.values() for r in t])), segment_rows))
    assert found == {c: expected(c, t) for c, t in talks.items()}


def test_long_conversation_in_segments_equals_one_segment(spark):
    rng = random.Random(3)
    rows = [r for c in range(3) for r in conversation(rng, c, 700)]
    rows += [(0, 9000, "user", "same.")] * 40
    whole = results(cr.repair(cr.damage(table(spark, rows))))
    assert whole == results(cr.repair(cr.damage(table(spark, rows)), 16)) and len(whole[0][7]) > 500


def test_no_rows_left_and_empty_table(spark):
    gone = [(c, 0) for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    found = results(cr.repair(cr.damage(table(spark, [(c, t, "user", "Hello.") for c, t in gone]))))
    empty = hashlib.sha256(b"").hexdigest()
    assert len(gone) > 3 and found == {c: (c, 0, 0, 0, 0, 0, 0, "", empty) for c, _ in gone}
    assert results(cr.repair(cr.damage(table(spark, []).limit(0)))) == {}


def test_nulls_everywhere(spark):
    found = results(cr.repair(cr.damage(table(spark, [(None, None, None, None)] * 2))))
    assert set(found) == {None} and found[None][1] == 0


def test_ranks_order_audits():
    """Ranks of nodes are the order of their least audits."""
    import numpy as np

    rng = random.Random(6)
    faults = [bytes(rng.choice([0, 0, 1, 2, 3]) for _ in range(rng.randint(0, 7))) for _ in range(30)]
    roles = [[rng.choice(["user", "assistant", "system"]) for _ in f] for f in faults]
    rows = cr.Rows(faults, roles)
    ends = np.full(len(faults), True)
    behind = cr._with_inserts(np.tile(cr._END, (len(faults), 1)))
    table = cr.cost_table(rows, behind)
    rank, pointers, letters = cr.least_audits(rows, table, ends)
    reached = np.flatnonzero(table.reshape(-1) < cr.NO)

    def audit(node):
        out = ""
        while letters[node] < 4:
            out += cr.EDITS[letters[node]]
            node = pointers[0][node]
        return out

    own = {int(n): audit(n) for n in reached}
    order = sorted(set(own.values()))
    by_rank = sorted({int(rank[n]) for n in own})
    assert [by_rank.index(int(rank[n])) for n in own] == [order.index(a) for a in own.values()]
