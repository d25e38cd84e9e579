"""Reports do not depend on the session time zone (all timestamps are wall-clock NTZ)."""

from __future__ import annotations

import pytest

from postura import Tables, build_report
from testsupport.driver_fixture import AS_OF, posture_from_driver
from testsupport.compare import compare, duck_connection
from testsupport.oracles import oracle_sql

from conftest import SF_ORACLE

TIME_KEYS = [
    "containers_running_with_findings_list",
    "host_added_over_time",
    "image_count_over_time",
    "image_growth_metrics",
    "image_vuln_fix_age_summary",
    "audit_hosts_findings_by_action",
    "audit_malware_list",
    "host_bench_results_details",
]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_time_reports_match_oracle_in_other_zones(spark, zone):
    con = duck_connection(SF_ORACLE)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        tables = posture_from_driver(spark, SF_ORACLE)
        for key in TIME_KEYS:
            res = compare(build_report(key, tables, spark, as_of=AS_OF), con, oracle_sql(key))
            assert res["ok"], (zone, key, res)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
