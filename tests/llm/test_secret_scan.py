import random
import re

import pyarrow as pa
import pytest

from postlens.llm import secret_scan as S

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def plain(text):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(out)]


PIECES = [
    "token", "SECRET", "passwd", "password", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "x",
    "0f" * 12, "AKIA", "AKIA" + "Z9" * 8, "é", "日", "\n", "secretoken", "abcdef", "-", "A", "", "ſecret",
]


@pytest.fixture(scope="module")
def scanner():
    return S.Scanner()


def test_base_spans_equal_regular_expressions(scanner):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["", "x" * 30_000 + ' Token = "abc_def" ' + "f" * 30_000, "é" * 5000 + "secret:abcdef"]
    for text, spans in zip(texts, scanner.scan(pa.array(texts)), strict=True):
        assert [s[:3] for s in spans if s[3]] == plain(text), text


def test_overlapping_matches_are_added(scanner):
    [spans] = scanner.scan(pa.array(["secret=token:abcdefgh"]))
    assert spans == [("assign", 7, 21, False)]


def test_lanes_do_not_matter(scanner, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice(PIECES) for _ in range(60)) for _ in range(300)]
    whole = scanner.scan(pa.array(texts))
    monkeypatch.setattr(S.A, "LANES", 7)
    assert scanner.scan(pa.array(texts)) == whole


def test_rows_nulls_and_clashing_columns(spark):
    rows = [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "token=abcdef", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = S.digest(S.scan_secrets(df)).collect()
    assert sorted((r.doc_id or 0, r.n_assign, r.spans) for r in got) == [
        (0, 1, "assign:0:12"), (1, 0, ""), (2, 0, ""), (2, 0, ""),
    ]
    assert all(r.base_sha256 == S.base_digest([]) for r in got if r.doc_id)
    assert S.digest(S.scan_secrets(df.limit(0))).count() == 0


def test_redaction_keeps_the_rest(spark):
    rows = [(1, "a token=abcdef b"), (2, None), (3, "clean")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in S.redact(df).collect()}
    assert got == {1: "a [assign] b", 2: None, 3: "clean"}
