"""Queries of the subpackage that SQL can tell, against DuckDB on the smallest tables."""

import duckdb
import pytest

from feedlake.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF
from tools.check_oracle import TABLES, digest


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols, rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, rows)[0]
