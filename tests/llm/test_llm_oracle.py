import duckdb
import pytest

from ledgerline.llm import queries
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    got, columns = rows_of(df.columns, df.collect())
    res = con.execute(queries.ORACLE_SQL[name])
    want, want_columns = rows_of([d[0] for d in res.description], res.fetchall())
    assert columns == want_columns and got == want
