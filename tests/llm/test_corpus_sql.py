"""The SQL forms of the queries, run by DuckDB on the same tables."""

from __future__ import annotations

import duckdb
import pytest

from postura.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = QUERIES[name](spark, SF)
    names = sorted(found.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(tuple(r) for r in found.select(*names).collect()) == sorted(want)
