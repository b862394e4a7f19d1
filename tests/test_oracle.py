"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from casemill.plans.catalog import QUERIES
from casemill.plans.oracle import ORACLE_SQL
from helpers import SF_SMALL
from tools_compare import TABLES, digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE_SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, df.columns)[0] == digest(drows, dcols)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "overdue_id" in df.columns
