"""Run catalog queries and compare them with their SQL: ``python tests/check_catalog.py [sf] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), na_position="first", ignore_index=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, values compared exactly; None when nothing does."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    got, want = canonical(got), canonical(want)
    try:
        pd.testing.assert_frame_equal(got, want, check_exact=True)
    except AssertionError as error:
        return str(error)
    return None


def main() -> int:
    from conftest import make_session

    from postlens.catalog.oracles import ORACLES
    from postlens.catalog.queries import QUERIES

    sf_dir = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    names = sys.argv[2:] or list(QUERIES)
    spark, bad = make_session(), 0
    for name in names:
        start = time.time()
        try:
            got = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - start
            if name in ORACLES:
                con = connect(sf_dir)
                problem = differences(got, con.execute(ORACLES[name]).fetch_df())
                verdict = problem or "equal"
            else:
                problem, verdict = None, "no SQL"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem, verdict, took, got = error, f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start, []
        bad += problem is not None
        print(f"{name:26s} {took:6.2f}s {len(got):8d} rows  {verdict}", flush=True)
    print(f"{bad} of {len(names)} differ or fail")
    return bad


if __name__ == "__main__":
    sys.exit(main())
