"""The driver contract: entry(), queries() and oracle_sql() agree with DuckDB on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import canon, spark_type_name
from lakestrata.sources.fixtures import RAW_TABLES

SF = "/root/testdata/sf0.001"
CORE = sorted(set(entry.queries()) - set(entry.TRAINING_DATA))  # the others have their own tests
NO_ORACLE = set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["Invoice", "CustomerID", "CustomerName"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(CORE) - set(entry.oracle_sql()) == NO_ORACLE
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    s_rows = sdf.collect()
    if name in NO_ORACLE:
        assert len(s_rows) == 5
        return
    cur = duck.execute(entry.oracle_sql()[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    d_types = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()}
    s_types = {f.name: spark_type_name(f.dataType) for f in sdf.schema.fields}
    assert s_types == d_types
    assert canon(s_rows, sdf.columns) == canon(d_rows, d_cols)
