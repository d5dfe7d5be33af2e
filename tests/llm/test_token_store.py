import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

from postlens.llm import token_store as T  # noqa: E402
from postlens.llm.encoding import Encoder  # noqa: E402

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("n,universe", [(0, 0), (1, 0), (1, 10**15), (1000, 999), (3000, 10**9), (5, 2**63)])
def test_elias_fano_round_trip(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n, endpoint=True, dtype=np.uint64))
    own = T.EliasFano.build(values, universe)
    back, end = T.EliasFano.from_bytes(b"xy" + own.to_bytes(), 2)
    assert end == 2 + len(own.to_bytes())
    assert (back.values().astype(np.uint64) == values).all()
    assert all(back.select(i) == int(values[i]) for i in range(0, n, 7))
    if n >= 1000:
        assert len(own.to_bytes()) * 8 / n < 2.6 + max(0, np.log2(universe / n))


def test_values_must_ascend():
    with pytest.raises(ValueError):
        T.EliasFano.build(np.array([3, 1]), 5)


def test_files_give_back_all_ids(spark, monkeypatch):
    monkeypatch.setattr(T, "READ_IDS", 50)
    docs = [(i * 7 - 500, f"Word {i} " * (i % 40)) for i in range(500)]
    docs += [(None, "no id"), (None, "no id"), (14, "again"), (99_999_999_999, None), (-9, "")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, start string").repartition(4)
    files = T.write_tokens(df, PATH, T.token_folder(spark))
    rows = T.read_tokens(files).collect()
    encoder = Encoder(PATH)
    want = sorted((-(10**18) if d is None else d, [*encoder._whole(t or ""), 2]) for d, t in docs)
    rows = sorted(rows, key=lambda r: r.start)
    names = [-(10**18) if r.doc_id is None else r.doc_id for r in rows]
    assert names == [d for d, _ in want]
    got = sorted((d, np.frombuffer(r.ids, "<u4").tolist()) for d, r in zip(names, rows, strict=True))
    assert got == want
    at = 0
    for r in rows:
        assert (r.start, r.n_tokens * 4) == (at, len(r.ids))
        at += r.n_tokens
    by_start = {r.start: r for r in T.read_boundaries(files).collect()}
    assert all(by_start[r.start].ids_crc32 == zlib.crc32(r.ids) for r in rows)
    shard = T.open_shard(files.orderBy("shard").first().path)
    assert shard.document(1).tobytes() == bytes(rows[1].ids)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert T.read_boundaries(T.write_tokens(df, PATH, T.token_folder(spark))).count() == 0


def test_wide_ids(tmp_path):
    writer = T.ShardWriter(f"{tmp_path}/a.ids", wide=True)
    writer.append(np.array([70_000, 2], np.uint32), np.array([0, 2]), np.asarray(pa.array([5])), 0)
    assert writer.close() == 1
    assert T.open_shard(f"{tmp_path}/a.ids").document(0).tolist() == [70_000, 2]
