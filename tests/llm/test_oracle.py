"""Queries that SQL can express against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from skilltrends.llm.oracle import ORACLE
from skilltrends.llm.queries import QUERIES

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SMOKE)
    assert sorted(got.columns) == sorted(rel.columns)
    order = sorted(got.columns)
    want = sorted(rel.project(", ".join(order)).fetchall(), key=repr)
    assert sorted((tuple(r) for r in got.select(*order).collect()), key=repr) == want
