"""Queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from riskflow.llm import queries, sql
from scripts.check_oracle import digest
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(sql.oracle_sql()))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    out = queries.queries()[name](spark, SF_SMALL)
    want = con.execute(sql.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert digest(out.columns, [tuple(r) for r in out.collect()]) == digest(columns, want.fetchall())


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
