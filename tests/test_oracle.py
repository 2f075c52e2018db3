"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from matchlake.sources.tables import DRIVER_TABLES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from matchlake.plans.queries import QUERIES as OWN

    assert set(OWN) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
