import math
import random

import numpy as np
import pyarrow as pa
import pytest

from postlens.llm import quality as Q


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghij", k=rng.randrange(3, 9))) for _ in range(600)]
    rows, labels = [], []
    for i in range(900):
        text = " ".join(rng.choices(words, k=rng.randrange(20, 200)))
        kind = "good"
        if i % 5 == 0:
            kind, text = "noise", "### ".join(text.split())
        elif i % 7 == 0:
            kind, text = "rude", text + " you zzrude " * 2
        rows.append((i, text, f"s{i % 3}" if i % 3 else None, "en"))
        labels.append((i, int(kind != "noise"), int(kind == "rude")))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_whole_rows(spark, corpus):
    docs, labels = corpus
    train = Q.bad_labels(labels.where("doc_id % 2 = 0"))
    model = Q.fit(docs, train)
    assert "zzrude" in model.weights
    kept = Q.keep_good(docs.withColumn("__x", docs.lang), model)
    assert kept.columns == [*docs.columns, "__x"]
    bad = {r.doc_id for r in Q.bad_labels(labels).collect() if r.bad}
    got = {r.doc_id for r in kept.collect()}
    odd = {i for i in range(900) if i % 2}
    wrong = [i for i in odd if (i in got) == (i in bad)]
    assert len(wrong) <= 0.02 * len(odd)


def test_group_posteriors_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice("abc"), rng.choice(["x", "y", None]), rng.gauss(0, 2)) for i in range(400)]
    rows += [(500, "lone", "x", 3.0), (501, None, None, -3.0), (501, None, None, -3.0)]
    scored = spark.createDataFrame(rows, "doc_id long, h string, p string, odds double")
    groups, info = Q.group_posteriors(scored, "h", "p", "odds")
    prob = lambda o: 1 / (1 + math.exp(-o))
    by_host, by_path = {}, {}
    for _, h, p, o in rows:
        by_host.setdefault(h, []).append(prob(o))
        by_path.setdefault((h, p), []).append(prob(o))

    def strength(groups):
        n = np.array([len(g) for g in groups])
        b = np.array([sum(g) for g in groups])
        mean = b.sum() / n.sum()
        between = ((b / n - mean) ** 2 * n).sum() - (len(n) - 1) * mean * (1 - mean)
        variance = max(between, 0) / (n.sum() - (n**2).sum() / n.sum())
        return min(max(mean * (1 - mean) / variance - 1, 1), 1e6) if variance > 1e-9 else 1e6

    share = sum(map(sum, by_host.values())) / len(rows)
    sh, sp = strength(list(by_host.values())), strength(list(by_path.values()))
    assert info["share"] == pytest.approx(share) and info["host_strength"] == pytest.approx(sh)
    got = {(r.doc_id, r.odds): r for r in Q.posterior(scored, groups, "h", "p", "odds").collect()}
    for i, h, p, o in rows:
        prior = (sum(by_host[h]) + sh * share) / (len(by_host[h]) + sh)
        rest = (sum(by_path[h, p]) - prob(o) + sp * prior) / (len(by_path[h, p]) - 1 + sp)
        assert got[i, o].path_share == pytest.approx(rest)
        assert got[i, o].p_bad == pytest.approx(prob(o + math.log(rest / (1 - rest))))


def test_measures_of_odd_texts():
    texts = pa.array(["", "   ", "A", "É é", "a " * 50_000, "日本 ###", "x" * 300_000])
    table = Q.measures(texts, {"a": 2.0})
    assert np.isfinite(table).all() and table.shape == (7, len(Q.MEASURES))
    assert table[:2].any() == False  # noqa: E712
    lexical = table[:, Q.MEASURES.index("lexical")]
    assert lexical.tolist() == [0, 0, 2, 0, 2, 0, 0]


def test_empty_tables_and_missing_labels(spark, corpus):
    docs, labels = corpus
    model = Q.fit(docs, Q.bad_labels(labels))
    assert Q.keep_good(docs.limit(0), model).count() == 0
    for one_sided in (labels.limit(0), labels.where("quality = 1 and toxic = 0")):
        model = Q.fit(docs, Q.bad_labels(one_sided))
        assert set(model.log_odds(pa.array(["", "a zzrude", "###"]))) == {0.0}
        assert Q.keep_good(docs, model).count() == docs.count()
    assert Q.keep_good(docs.limit(0), Q.fit(docs.limit(0), Q.bad_labels(labels))).count() == 0


def test_clashing_names_ties_and_long_texts(spark, corpus):
    docs, labels = corpus
    model = Q.fit(docs, Q.bad_labels(labels))
    long = spark.createDataFrame([(-1, "fair words " * 200_000, None, None), (-2, None, "s1", None)], docs.schema)
    every = docs.unionByName(docs).unionByName(long)
    names = ["__odds", "__SHARE", "__p_bad", "__h", "__p", "__bad", "__group"]
    clashing = every.select("*", *(every.lang.alias(n) for n in names))
    kept = Q.keep_good(clashing, model)
    assert kept.columns == clashing.columns
    got = sorted(r.doc_id for r in kept.select("doc_id").collect())
    assert got == sorted(r.doc_id for r in Q.keep_good(every, model).select("doc_id").collect())
    assert all(got.count(i) == 2 for i in got if i >= 0)
