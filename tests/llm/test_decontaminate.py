import random

import pytest

from postlens.llm import decontaminate as D


def shingles(text, width=5):
    words = (text or "").lower().split()
    if len(words) < width:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(docs, items):
    out = []
    for d, text in docs:
        own = shingles(text)
        for i, item in items:
            need = shingles(item)
            if need and len(own & need) >= 0.8 * len(need) - 1e-9:
                out.append((-1 if d is None else d, i, len(own & need), len(need)))
    return sorted(out)


@pytest.fixture
def planted():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 5, 6, 20, 50])))) for i in range(40)]
    items += [(40, None), (41, ""), (5, items[5][1])]
    docs = []
    for d in range(120):
        body = rng.choices(words, k=rng.choice([0, 2, 30, 400]))
        if d % 3 == 0:
            part = rng.choice(items)[1] or ""
            part = part.split()
            if part and d % 2:
                part[rng.randrange(len(part))] = "EDIT"
            at = rng.randrange(len(body) + 1)
            body[at:at] = part
        docs.append((d, " ".join(body).upper() if d % 5 == 0 else " ".join(body)))
    docs += [(None, items[4][1]), (7, docs[7][1]), (200, None), (201, " \n\t ")]
    return docs, items


def test_pairs_equal_brute_force(spark, planted, monkeypatch):
    docs, items = planted
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    lib = spark.createDataFrame(items, "item_id long, text string")
    rows = lambda: sorted((-1 if r[0] is None else r[0], *r[1:4]) for r in D.find_items(df, lib).collect())
    assert rows() == brute(docs, items)
    monkeypatch.setattr(D, "BLOCK_CHARS", 500)
    assert rows() == brute(docs, items)


def test_dropping_keeps_the_other_rows(spark, planted):
    docs, items = planted
    bad = {row[0] for row in brute(docs, items)}
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "n long, doc_id long, text string")
    lib = spark.createDataFrame(items, "item_id long, text string")
    kept = D.drop_contaminated(df, lib)
    assert kept.columns == df.columns
    assert sorted(r.n for r in kept.collect()) == [i for i, d in enumerate(docs) if (-1 if d[0] is None else d[0]) not in bad]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    lib = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.find_items(df, lib).count() == 0
    assert D.find_items(lib.withColumnRenamed("item_id", "doc_id"), lib.limit(0)).count() == 0
    assert D.drop_contaminated(df, lib).count() == 0
