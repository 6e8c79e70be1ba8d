"""Every registered query against its DuckDB oracle on the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerline.oracle import all_sql
from ledgerline.registry import QUERIES
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got, got_cols = rows_of(df.columns, df.collect())
    res = con.execute(all_sql()[name])
    want, want_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert got_cols == want_cols
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(all_sql()) <= set(entry.oracle_sql())
    assert "profit_margin" in df.columns
