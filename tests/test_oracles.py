"""Every report against its DuckDB oracle: on the driver tables and on the hand-built edge
tables (read back through the Parquet source)."""

from __future__ import annotations

import pytest

from postura import REPORTS, Tables, build_report
from postura.schemas import POSTURE_TABLES
from testsupport.driver_fixture import AS_OF, posture_from_driver
from testsupport.compare import compare, duck_connection
from testsupport.edge_fixture import edge_frames
from testsupport.oracles import oracle_sql, oracle_sql_posture

from conftest import SF_ORACLE

KEYS = list(REPORTS)


@pytest.fixture(scope="module")
def duck_driver():
    return duck_connection(SF_ORACLE)


@pytest.fixture(scope="module")
def oracle_tables(spark):
    return posture_from_driver(spark, SF_ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_report_matches_oracle_on_driver_tables(spark, oracle_tables, duck_driver, key):
    res = compare(build_report(key, oracle_tables, spark, as_of=AS_OF), duck_driver, oracle_sql(key))
    assert res["ok"], res


@pytest.fixture(scope="module")
def edge_setup(spark, driver_tables, tmp_path_factory):
    import duckdb

    root = tmp_path_factory.mktemp("edge")
    for name, df in edge_frames(spark, driver_tables).items():
        df.coalesce(1).write.mode("overwrite").parquet(str(root / name))
    con = duckdb.connect()
    for name in POSTURE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root / name}/*.parquet')")
    return Tables.from_parquet(spark, str(root)), con


@pytest.mark.parametrize("key", KEYS)
def test_report_matches_oracle_on_edge_tables(spark, edge_setup, key):
    tables, con = edge_setup
    res = compare(build_report(key, tables, spark, as_of=AS_OF), con, oracle_sql_posture(key))
    assert res["ok"], res


MONTH_END = "2001-03-31 00:00:00"


@pytest.mark.parametrize("key", ["host_added_over_time", "host_findings_over_time", "image_count_over_time"])
def test_month_spine_reports_at_month_end_match_cumulative_series(spark, edge_setup, key):
    """At a month-end instant the series steps 31 Mar -> 30 Apr -> ... -> 28 Feb -> 28 Mar, as
    the source database (and DuckDB) generate it."""
    from testsupport.oracles import AS_OF

    tables, con = edge_setup
    sql = oracle_sql_posture(key).replace(AS_OF, MONTH_END).replace(AS_OF[:10], MONTH_END[:10])
    res = compare(build_report(key, tables, spark, as_of=MONTH_END), con, sql)
    assert res["ok"], res
