"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from postlens.llm import spelling


def words_of(rows, least=6, often=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= often}


def distance_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(counts, ratio=5):
    out, forms = {}, {}
    for word, n in counts.items():
        near = [w for w in counts if w != word and distance_one(w, word)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= ratio * n:
            forms[word] = best
        out[word] = len(near)
    rows = set()
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        rows.add((word, form, root, n, out[word], counts.get(form)))
    return rows


def as_set(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def vocabulary(seed, n, letters="abcdeè"):
    rng = random.Random(seed)
    words = {}
    while len(words) < n:
        word = "".join(rng.choices(letters, k=rng.randint(6, 9)))
        words[word] = rng.choice([5, 9, 30, 200, 1000, 5000])
        if rng.random() < 0.7:
            at = rng.randrange(len(word))
            change = rng.choice(["", rng.choice(letters), word[at] + rng.choice(letters)])
            other = word[:at] + change + word[at + 1 :]
            words.setdefault(other, rng.choice([5, 6, 40]))
    return words


@pytest.mark.parametrize("node_words", [spelling.NODE_WORDS, 40, 1])
def test_equal_to_all_pairs(spark, node_words):
    """At every depth of the table's nodes, also with long words and chains of forms."""
    words = vocabulary(3, 500)
    words |= {"x" * 60: 5, "x" * 61: 30, "x" * 30 + "y" + "x" * 30: 900, "z" * 300: 7, "z" * 299: 7}
    words |= {"a" * spelling.WIDE: 5, "a" * (spelling.WIDE + 1): 25, "b" + "a" * (spelling.WIDE - 1): 5}
    words |= {"chaine": 5, "chaines": 25, "chainess": 125, "chainesss": 625, "chainessss": 3125}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert as_set(spelling.variants(table, node_words=node_words)) == expected(words)


def test_counts_equal_the_contract(spark):
    rng = random.Random(5)
    pool = ["Élégant", "elegant", "Mother", "mothers", "STRASSE", "straße", "a×b÷cdef", "naïveté", "kurz", "İstanbul", "word_word"]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(None, "Mother mother"), (7, None), (8, ""), (9, "mothers " * 3000), (9, "mothers " * 3000), (11, "q" * 50_000)]
    df = spark.createDataFrame([(k, t, "w", 1) for k, t in rows], "doc_id long, text string, word string, n long")
    counts = words_of(rows)
    assert any(w in counts for w in ("mohers", "mothes", "other")) or len(counts) > 8  # some damaged words are frequent
    found = spelling.count_words(df)
    assert {r.word: r.n for r in found.collect()} == counts
    assert as_set(spelling.variants(found)) == expected(counts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.count_words(df)).collect() == []


def test_ratio_must_make_chains_end(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)


@pytest.mark.parametrize("depth", spelling.DEPTHS)
def test_numbers_of_nodes_add_up(depth):
    """One edit always leads to one of the listed differences, and the differences are distinct."""
    steps = spelling.budget_steps(depth)
    assert len(set(steps)) == len(steps)
    rng = random.Random(depth)
    for _ in range(300):
        a = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzéüß", k=rng.randint(6, 12)))
        at = rng.randrange(len(a))
        b = a[:at] + rng.choice(["", "q", a[at] + "w"]) + a[at + 1 :]
        x, y = spelling.Words([a, b]).nodes(depth)
        assert (int(y) - int(x)) & ((1 << 52) - 1) in steps


def test_splitting_blocks_changes_nothing(monkeypatch):
    words = sorted(vocabulary(9, 300))
    own = spelling.Words(words)
    nodes = own.nodes(4)
    whole = sorted((int(i), int(j)) for x, y in spelling.Trie(own, nodes).search(own, nodes) for i, j in zip(x, y))
    monkeypatch.setattr(spelling, "BLOCK", 7)
    assert whole == sorted((int(i), int(j)) for x, y in spelling.Trie(own, nodes).search(own, nodes) for i, j in zip(x, y))
    assert len(whole) == len(set(whole))


def test_verification():
    words = sorted(vocabulary(1, 80)) + ["w" * spelling.WIDE, "w" * (spelling.WIDE + 1), "w" * (spelling.WIDE + 2)]
    own = spelling.Words(words)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(words)), np.arange(len(words))))
    assert spelling.verify(own, i, own, j).tolist() == [distance_one(words[a], words[b]) for a, b in zip(i, j)]
