import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import __spark_entry__ as entry  # noqa: E402
from check_catalog import connect, differences  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")

# Plan nodes that pair every row with every row.
PAIRING = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.label for r in rows} == {0, 1} and all(r.total_posts > 0 for r in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in PAIRING)
    got, want = df.toPandas(), duck.execute(entry.oracle_sql()[name]).fetch_df()
    assert differences(got, want) is None


@pytest.mark.parametrize("name", ["top_words", "similar_vectors"])
def test_top_k_is_cut_before_the_shuffle(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_scans_read_only_what_is_used(spark):
    plan = entry.queries()["heatmap_all"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
    assert "ReadSchema: struct<doc_id:bigint,toxic:int>" in plan
    assert "PushedFilters: [IsNotNull(user_id)]" in plan
