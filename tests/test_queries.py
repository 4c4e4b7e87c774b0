"""Every registered engine query over the smallest tables, against its SQL where it has one."""

import os

import duckdb
import pytest

from stratacloud.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE_SQL:
        assert len(got)
        return
    want = sql.execute(ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    got, want = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert got.equals(want)
