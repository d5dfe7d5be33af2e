"""Registered queries on a small table: with SQL by test_catalog, the others here by brute force."""

import hashlib
import html
import re
import zlib
from pathlib import Path

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from postlens.llm import queries as Q  # noqa: E402
from postlens.llm.encoding import Encoder  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(map(tuple, Q.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()))


def test_every_operator_has_a_query():
    assert [name.split("_")[0] for name in Q.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(Q.ORACLES) <= set(Q.QUERIES)


def test_packing(spark, docs):
    from test_packing import check

    assert check(Q.op1_packing(spark, SF_DIR).collect(), docs) > 0.9


def test_token_files(spark, docs):
    encoder = Encoder(P.path("word_bpe_49k.json"))
    at = 0
    for row, (doc, text) in zip(Q.op7_token_files(spark, SF_DIR).orderBy("start").collect(), docs, strict=True):
        ids = np.array([*encoder._whole(text or ""), 2], dtype="<u4")
        assert tuple(row[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) == (doc, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_counts(spark, docs):
    got = {r.doc_id: r for r in Q.op3_token_counts(spark, SF_DIR).collect()}
    assert all(got[i].n_words == len(t.encode().split()) and got[i].n_tokens >= got[i].n_words for i, t in docs)


def test_quality(spark, docs):
    rows = Q.op5_quality_classifier(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == [i for i, _ in docs]
    assert all(0 <= r.p_bad <= 1 and r.keep == (r.p_bad < 0.7) for r in rows)


def test_main_text(spark):
    pages = {r.page_id: r for r in Q.table(spark, SF_DIR, "pages").collect()}
    rows = Q.op6_main_text(spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        spaced = re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", article))
        assert r.text == " ".join(html.unescape(spaced).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_warc(spark):
    rows = Q.op4_warc_derivatives(spark, SF_DIR).collect()
    assert len(rows) == 2 * Q.table(spark, SF_DIR, "pages").count() == 2 * len({r.refers_to for r in rows})


def test_warc_records_are_whole(spark):
    rows = Q.op4_warc_derivatives(spark, SF_DIR).collect()
    assert {"warc_date", "source_headers", "block"} <= set(rows[0].asDict())
    assert all(len(r.block.encode()) == r.content_length and hashlib.md5(r.source_headers.encode()).hexdigest() == r.headers_md5 for r in rows)
    assert all(r.block for r in rows if r.warc_type == "conversion")


def test_neighbours(spark):
    table = Q.table(spark, SF_DIR, "embeddings").collect()
    ids = np.array([r.vec_id for r in table])
    vectors = np.array([r.embedding for r in table], dtype=np.float32).astype(np.float64)
    rows = Q.op9_nearest_neighbours(spark, SF_DIR).collect()
    got = {}
    for r in rows:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in np.flatnonzero(ids % 20 == 0):
        order = np.lexsort((ids, -(vectors @ vectors[q])))
        hits += len(got[ids[q]] & set(ids[order[order != q][:20]].tolist()))
    assert hits >= 0.9 * len(rows) and len(rows) == 20 * len(got)


def test_spelling_variants(spark, docs):
    from test_spelling import as_set, expected, words_of

    assert as_set(Q.op11_spelling_variants(spark, SF_DIR)) == expected(words_of(docs))


def test_document_fingerprints(spark, docs):
    from test_fingerprints import jaccard, shingles

    rows = {r.doc_id: r for r in Q.op12_document_fingerprints(spark, SF_DIR).collect()}
    order = [(k, t or "") for k, t in docs[::-1]]
    errors = []
    for (key, text), (after, following) in zip(order, order[1:] + order[:1], strict=True):
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        row = rows[key]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        errors.append(row.near_edited - jaccard(shingles(text), shingles(changed)))
        errors.append(row.near_next - jaccard(shingles(text), shingles(following)))
        assert (row.fingerprint == rows[after].fingerprint) == (row.near_next == 1)
    assert len(rows) == len(docs) and np.abs(errors).max() < 0.2 and abs(np.mean(errors)) < 0.01


def test_conversation_repair(spark):
    from test_conversation_repair import expected

    talks = {}
    for r in Q.table(spark, SF_DIR, "conversations").collect():
        talks.setdefault(r.conv_id, []).append((r.conv_id, r.turn, r.role, r.text))
    rows = Q.op13_conversation_repair(spark, SF_DIR).collect()
    assert {r.conv_id: tuple(r) for r in rows} == {c: expected(c, t) for c, t in talks.items()}
