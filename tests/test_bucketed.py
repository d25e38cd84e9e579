"""A snapshot whose scan-keyed facts are bucketed by scan id joins them without a shuffle."""

from __future__ import annotations

import re
import uuid

from postura import Tables, build_report
from testsupport.driver_fixture import AS_OF
from postura.schemas import POSTURE_TABLES


def test_bucketed_facts_join_without_shuffle(spark, driver_tables, tmp_path):
    db = "postura_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{tmp_path}'")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    # only the tiny policy table may be broadcast; the facts must meet in a sort-merge join
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        for name in POSTURE_TABLES:
            w = driver_tables[name].write.mode("overwrite").format("parquet")
            if name == "scans":
                w = w.bucketBy(8, "id").sortBy("id")
            elif name in ("scan_assurance_results", "scan_resources"):
                w = w.bucketBy(8, "scan_id").sortBy("scan_id")
            w.saveAsTable(f"{db}.{name}")
        t = Tables.from_catalog(spark, db)
        for key in ("image_assurance_control_summary", "host_assurance_summary", "container_assurance_summary"):
            plan = build_report(key, t, spark, as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()
            # assurance results meet scans on the scan id reading both bucketed tables as they lie
            assert re.search(r"SortMergeJoin \[scan_id#\d+L?\], \[s_id", plan), (key, plan)
            assert "Bucketed: true" in plan
            assert not re.search(r"Exchange hashpartitioning\((scan_id|s_id)#\d+L?, ", plan), (key, plan)
            got = sorted(tuple(r) for r in build_report(key, t, spark, as_of=AS_OF).collect())
            want = sorted(tuple(r) for r in build_report(key, driver_tables, spark, as_of=AS_OF).collect())
            assert got == want, key
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP DATABASE {db} CASCADE")
