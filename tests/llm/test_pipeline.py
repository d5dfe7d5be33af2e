"""The pipeline's stages on a small table, each against brute force on what it was given."""

import re
from pathlib import Path

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as C
import __spark_entry__ as entry
from postlens.llm import quality
from postlens.sources.staging import stage, staging_path
from test_decontaminate import brute as items_in
from test_packing import check as check_pieces
from test_shingle_join import brute as components_of
from test_shingle_join import grams

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

SECRET = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{6,}|AKIA[A-Z0-9]{16,}|[0-9a-f]{24,}"
)


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen = [docs]
    for name, work in C.STAGES:
        docs = stage(work(spark, docs, SF_DIR), staging_path(spark, name.replace(" ", "-")))
        seen.append(docs)
    return seen


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_columns_stay(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_rejected_documents_are_bad(spark, stages):
    labels = quality.bad_labels(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    bad = {r.doc_id: r.bad for r in labels.collect()}
    kept = {i for i, _ in rows(stages[1])}
    assert kept < {i for i, _ in rows(stages[0])}
    known = [i for i, _ in rows(stages[0]) if i in bad]
    assert sum((i in kept) == bool(bad[i]) for i in known if not bad[i]) <= 1
    assert sum((i in kept) == bool(bad[i]) for i in known) <= 0.15 * len(known)


def test_one_of_each_group_of_copies_stays(stages):
    given = rows(stages[1])
    assert [i for i, t in rows(stages[2]) if grams(t, 5)] == sorted(components_of(given, 5, 8, 10)[1])


def test_documents_with_items_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    given = rows(stages[2])
    bad = {row[0] for row in items_in(given, items)}
    assert rows(stages[3]) == [r for r in given if r[0] not in bad]


def test_secrets_are_gone_and_nothing_else(stages):
    given, done = rows(stages[3]), rows(stages[4])
    assert [i for i, _ in given] == [i for i, _ in done]
    for (_, before), (_, after) in zip(given, done, strict=True):
        assert not SECRET.search(after)
        assert (before == after) == (not SECRET.search(before))


def test_pieces_hold_all_tokens(stages):
    assert check_pieces(stages[5].collect(), rows(stages[4])) > 0.8


def test_registered_whole(spark, stages):
    assert "pipeline" in entry.queries() and C.ORACLE_SQL is None
    own = ["doc_id", "start", "length", "ids_crc32"]
    key = lambda df: sorted(map(tuple, df.select(*own).collect()))
    assert key(C.run(spark, SF_DIR)) == key(stages[5])
