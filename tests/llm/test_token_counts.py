import random

import pyarrow as pa
import pytest

from postlens.llm import token_counts as T


def plain(word, pieces, unknown):
    text = T.MARK + word
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        width = len(text[end - 1].encode())
        ways = [(best[end - 1][0] + width * unknown, best[end - 1][1] + width)]
        ways += [(best[b][0] + pieces[text[b:end]], best[b][1] + 1) for b in range(end) if text[b:end] in pieces]
        best[end] = max(ways, key=lambda w: (w[0], -w[1]))
    return best[-1][1]


@pytest.fixture(scope="module")
def pieces():
    rng = random.Random(0)
    names = {"".join(rng.choices("abcé" + T.MARK, k=rng.randrange(1, 6))) for _ in range(150)} | set("abc")
    return {n: -float(rng.randrange(1, 40)) for n in names}


def test_counts_equal_a_plain_search(pieces):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcé日", k=rng.randrange(1, 14))) for _ in range(3000)]
    counter = T.Counter(pieces)
    counter.learn(sorted(set(words)))
    assert all(counter.counts[w] == plain(w, pieces, counter.unknown) for w in words)


def test_shared_prefixes_are_scored_once(pieces):
    counter = T.Counter(pieces)
    counter.learn(["abcab", "abc", "abcac", "b"])
    assert counter.nodes == 1 + 3 + 2 + 1 + 1


def test_rows_of_a_table(spark, pieces, monkeypatch):
    monkeypatch.setattr(T, "MAX_WORDS", 5)
    rows = [(1, "ab abc\n ab"), (2, None), (3, ""), (None, "abé " * 500), (1, "ab abc\n ab"), (4, "x" * 300)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_words int")
    got = sorted((r.doc_id or 0, r.n_words, r.n_tokens) for r in T.count_tokens(df, pieces).collect())
    unknown = T.Counter(pieces).unknown
    want = sorted((i or 0, len((t or "").split()), sum(plain(w, pieces, unknown) for w in (t or "").split())) for i, t in rows)
    assert got == want
    assert T.count_tokens(df.limit(0), pieces).count() == 0


def test_scores_of_a_model_are_a_distribution():
    P = pytest.importorskip("public_tokenizers")
    pieces = T.load_pieces(P.path("piece_bpe_32k.model"))
    import math

    assert math.isclose(sum(math.exp(s) for s in pieces.values()), 1, rel_tol=1e-9)
    words, tokens = T.Counter(pieces).count(pa.array(["the house", ""]))
    assert words.tolist() == [2, 0] and tokens.tolist() == [2, 0]
