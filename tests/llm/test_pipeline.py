"""Every stage on odd rows and on the given table, and the queries against their SQL."""
import os

import duckdb
import pytest

import corpus_pipeline as P
from strata.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SF, clashing


@pytest.mark.parametrize("name, stage", P.STAGES)
def test_stage_takes_odd_rows(spark, odd_docs, no_docs, name, stage):
    out = stage(spark, odd_docs, SF)
    assert out.count() > 0
    if name != P.STAGES[-1][0]:
        assert out.columns == odd_docs.columns
        assert stage(spark, clashing(odd_docs), SF).columns == clashing(odd_docs).columns
    assert stage(spark, no_docs, SF).count() == 0


def test_run(spark):
    rows = P.run(spark, SF).collect()
    given = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows and {r["doc_id"] for r in rows} <= given
    assert all(r["n_tokens"] == len(r["piece_ids"]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    from tools.compare import TABLES, digest, rows_of
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    scols, srows = rows_of(QUERIES[name](spark, SF).toPandas())
    ocols, orows = rows_of(con.sql(ORACLE[name]).df())
    assert scols == ocols and len(srows) == len(orows) and digest(srows) == digest(orows)
