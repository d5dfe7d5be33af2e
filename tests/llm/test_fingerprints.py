"""Fingerprints of whole and edited texts; near copies against exact similarities."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from postlens.llm import fingerprints as fp
from postlens.llm.components import components


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def shingles(text, width=5):
    own = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1)))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def corpus():
    rng = random.Random(4)
    texts = {i: " ".join(words(rng, rng.randint(0, 120))) for i in range(60)}
    texts |= {60: "", 61: None, 62: "one two", 63: "One two", 64: " ".join(words(rng, 40_000)), 65: "é" * 7, 66: "x" * 5000}
    return texts


@pytest.mark.parametrize("blocks", [1, 3, 8, 200])
def test_edited_texts(spark, blocks):
    texts = corpus()
    df = spark.createDataFrame([(k, t, 1, "b") for k, t in texts.items()], "doc_id long, text string, at int, block string")
    rows = {r.doc_id: r for r in fp.fingerprint_edits(df, blocks=blocks).collect()}
    order = sorted(texts, reverse=True)
    assert len(rows) == len(texts)
    for i, key in enumerate(order):
        own, following = texts[key] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        row = rows[key]
        assert row.n_chars == len(own)
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        signed = fp.signatures(pa.array([own, changed, following], pa.large_string()))
        assert [row.fingerprint, row.edited_fingerprint] == fp._hex(signed[:2])
        assert row.near_edited == (signed[0] == signed[1]).mean()
        assert row.near_next == (signed[0] == signed[2]).mean()


def test_ids_of_other_types_nulls_and_ties(spark):
    rows = [("b", "one two three four five six"), ("a", "x y z"), (None, "last of all"), ("b", "other text here"), ("a", "x y z")]
    df = spark.createDataFrame(rows, "name string, body string")
    for blocks in (1, 4):
        found = fp.fingerprint_edits(df, "name", "body", blocks=blocks).collect()
        assert sorted(r.n_chars for r in found) == sorted(len(t) for _, t in rows)
        by = {r.name: r for r in found}
        assert by[None].near_next < 1
        # The first of two equal rows is followed by the second, the second by the row with a null id.
        same = sorted(r.edited_sha256 for r in found if r.name == "a")
        assert same == sorted(hashlib.sha256(t.encode()).hexdigest() for t in ("x yx ", "x yla"))
    nulls = spark.createDataFrame([(None, "abcd"), (None, "efgh")], "doc_id long, text string")
    assert {r.edited_sha256 for r in fp.fingerprint_edits(nulls).collect()} == {
        hashlib.sha256(t.encode()).hexdigest() for t in ("abef", "efab")
    }


def test_one_document_and_none(spark):
    one = fp.fingerprint_edits(spark.createDataFrame([(5, "abc def")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abc abc").hexdigest() and one[0].near_next == 1.0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fp.fingerprint_edits(empty).collect() == []
    members, links = fp.near_copies(empty)
    assert members.collect() == [] and links.collect() == []


def test_likeness_estimates_similarity():
    rng = random.Random(8)
    base = words(rng, 400)
    for share in (0, 100, 200, 350):
        other = base[:share] + words(rng, 400 - share)
        a, b = " ".join(base), " ".join(other)
        signed = fp.signatures(pa.array([a, b], pa.large_string()))
        assert abs(fp.likeness(signed[0], signed[1]) - jaccard(shingles(a), shingles(b))) < 0.16
    signed = fp.signatures(pa.array(["", " \n", "a"], pa.large_string()))
    assert (signed[0] == fp.NONE).all() and fp.likeness(signed[0], signed[1]) == 1 and fp.likeness(signed[0], signed[2]) < 0.05


@pytest.mark.parametrize("block_rows", [fp.BLOCK_ROWS, 5])
def test_near_copies_against_all_pairs(spark, monkeypatch, block_rows):
    """Groups of exact and near copies, a hot group cut into blocks among them."""
    monkeypatch.setattr(fp, "BLOCK_ROWS", block_rows)
    rng = random.Random(2)
    texts = list(corpus().values())
    for group in range(6):
        base = words(rng, 150)
        for _ in range(40 if group == 0 else 5):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = f"v{rng.randrange(4000)}"
            texts.append(" ".join(copy)[: -1 if rng.random() < 0.1 else None])
    texts += [texts[-1]] * 30 + [texts[-1].upper()]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, "c") for k, t in rows], "doc_id long, text string, set_id string")
    members, links = fp.near_copies(df)
    sets = {k: shingles(t) for k, t in rows}
    names: dict = {}
    for k, own in sets.items():
        names.setdefault(own, k)
    assert {r.doc_id: r.class_id for r in members.collect()} == {k: names[own] if own else None for k, own in sets.items()}
    reps = [(k, own) for own, k in names.items() if own]
    wanted = {(a, b) for a, x in reps for b, y in reps if a < b and jaccard(x, y) >= 0.8}
    found = {(r.a, r.b): r.jaccard for r in links.collect()}
    assert set(found) == wanted and len(wanted) > 100
    assert all(abs(found[a, b] - jaccard(sets[a], sets[b])) < 1e-12 for a, b in wanted)
    assert components(links).count() == len({x for pair in wanted for x in pair})
