"""Every registered query against its DuckDB statement on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as se
from feedlake.plans.registry import ORACLE, QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(se.queries()) and set(ORACLE) <= set(se.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(scols, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["agency", "stream", "day", "rows", "unique_rows"]
    assert df.count() > 0
