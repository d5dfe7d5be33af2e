import random

import numpy as np
import pytest

from postlens.llm import shingle_join as J


def grams(text, width):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w for w in (text or "").translate(fold).replace("\n", " ").split(" ") if w]
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, num, den):
    sets = [grams(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out, names = [], []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
        names += [min(ids) if ids else None] if sets[members[0]] else []
    return sorted(out, key=str), sorted(names, key=str)


def corpus(seed, base=12, copies=18, length=(1, 140)):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    passage = rng.choices(words, k=55)
    for _ in range(base):
        body = rng.choices(words, k=rng.randrange(*length))
        if rng.random() < 0.3:
            body += passage
        texts.append(" ".join(body))
        for _ in range(rng.randrange(copies)):
            new = list(body)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
                at = rng.randrange(len(new) + 1)
                if rng.random() < 0.5 and at < len(new):
                    new[at] = rng.choice(words)
                else:
                    new.insert(at, rng.choice(words))
            texts.append((" " if rng.random() < 0.5 else "\n").join(w.upper() if rng.random() < 0.1 else w for w in new))
    rng.shuffle(texts)
    rows = [(10 * i, t) for i, t in enumerate(texts)]
    return rows + [(5, None), (6, ""), (7, " \n"), (None, texts[0]), (None, "lone words here and there"), (20, texts[2]), (30, texts[5])]


@pytest.mark.parametrize("width,num,den", [(3, 9, 10), (5, 8, 10)])
@pytest.mark.parametrize("group", [16, 2])
def test_components_equal_brute_force(spark, monkeypatch, width, num, den, group):
    monkeypatch.setattr(J, "GROUP", group)
    rows = corpus(width + group)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n long, node string").repartition(3)
    got = [tuple(r) for r in J.link_components(df, width=width, sim=J.Similarity(num, den)).collect()]
    assert sorted(got, key=str) == brute(rows, width, num, den)[0]


def test_linking_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for sim in (J.Similarity(9, 10), J.Similarity(8, 10)):
        for _ in range(1500):
            n = int(rng.integers(1, 200))
            x = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            most = int(len(x) * (sim.den - sim.num) / sim.num) + 1
            drop = rng.integers(0, most + 1)
            y = np.union1d(rng.permutation(x)[: len(x) - drop], rng.integers(0, 1 << 63, int(rng.integers(0, most + 1)), dtype=np.uint64))
            shared, union = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if len(y) and sim.den * shared >= sim.num * union and not np.array_equal(x, y):
                (one, two), needs = J.signatures([x, y], sim)
                assert len(np.intersect1d(one, two)) >= needs.max() >= 1, (len(x), len(y))
                a, b = J.sketches([x, y])
                assert (a != b).sum() <= sim.difference(len(x) + len(y))


def test_one_document_of_each_group_stays(spark):
    rows = corpus(9)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string").repartition(3)
    kept = J.drop_near_copies(df)
    assert kept.columns == df.columns
    names = [r.doc_id for r in kept.collect() if grams(r.text, 5)]
    assert sorted(names, key=str) == brute(rows, 5, 8, 10)[1]
    assert sorted(r.doc_id for r in kept.collect() if not grams(r.text, 5)) == [5, 6, 7]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.link_components(df).count() == 0
    assert J.drop_near_copies(df).count() == 0
