import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from postlens.llm import packing as K  # noqa: E402
from postlens.llm.encoding import Encoder  # noqa: E402

PATH = P.path("word_bpe_49k.json")


def test_nnls_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.random((12, 30)), rng.random(12) * 50
        x = K.nnls(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and gradient.max() < 1e-5 and abs(gradient[x > 0]).max(initial=0) < 1e-5


def test_combinations_fill_the_window():
    ways = K.combinations(12)
    assert len(set(ways)) == len(ways) == 1 + 6 + 12
    assert all(sum(w) == 12 for w in ways)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_tail_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randrange(1, 257): rng.randrange(1, 5000) for _ in range(seed * 40 + 1)}
    own = K.plan(histogram)
    fill = {}
    for part in own.parts:
        for number in range(part.first, part.stop):
            s = part.sequence + (number - part.first) // part.each
            fill[s] = fill.get(s, 0) + part.bin
    assert sorted(fill) == list(range(own.sequences)) and max(fill.values(), default=0) <= 256
    assert min(fill.values(), default=256) >= 256 * (1 - K.WASTE)
    for b, count in own.planned.items():
        spans = sorted((p.first, p.stop) for p in own.parts if p.bin == b)
        assert spans[0][0] == 0 and spans[-1][1] == count <= histogram[b]
        assert all(x[1] == y[0] for x, y in zip(spans, spans[1:], strict=False))


def check(rows, docs):
    encoder = Encoder(PATH)
    own, sequences = {}, {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(own) == {d for d, _ in docs}
    for doc, text in docs:
        ids = np.array([*encoder._whole(text or ""), 1], dtype="<u4")
        at = 0
        for r in sorted(own[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    return sum(r.length for r in rows) / (2048 * len(sequences))


def test_pieces_equal_the_tokens(spark):
    rng = random.Random(4)
    docs = [(i, "word, " * rng.choice([1, 40, 300, 900, 5000]) + "x " * rng.randrange(400)) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "only " * 1500)]
    df = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, n long").repartition(5)
    assert check(K.pack_documents(df, PATH).collect(), docs) > 0.97


def test_one_odd_length_is_cut(spark):
    docs = [(i, "word " * 1400) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert check(K.pack_documents(df, PATH).collect(), docs) > 0.99


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = K.pack_documents(df, PATH).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 2), (1, 3), (1, 3)]
    assert K.pack_documents(df.limit(0), PATH).count() == 0
