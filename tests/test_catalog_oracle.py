"""Every catalogue query against its DuckDB twin on the sf0.001 tables."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans import catalog
from tools.compare import TABLES, digest, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, con, name):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    scols, srows = rows_of(E.queries()[name](spark, SF).toPandas())
    ocols, orows = rows_of(con.sql(E.oracle_sql()[name]).df())
    assert scols == ocols
    assert len(srows) == len(orows)
    assert digest(srows) == digest(orows)


def test_every_query_has_oracle_or_a_stated_reason():
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == set(catalog.NO_ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(__import__("strata.plans.catalog", fromlist=["x"]).NO_ORACLE))
def test_query_without_oracle_runs(spark, name):
    assert E.queries()[name](spark, SF).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "total_visits" in df.columns
