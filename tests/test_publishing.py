"""One CSV file per report, the commit of a run, the blocks its reports share, snapshots and the severity rule."""

from __future__ import annotations

import csv
import json
import re
import uuid

import pytest
from pyspark.sql import functions as F

from postura import Tables, build_report
from postura.functions import catalog_severity
from postura.plans import shared
from postura.plans.blocks import FAILURES, VULN_SUMMARY
from postura.plans.shared import shared_blocks
from postura.runner import MANIFEST, collect, main
from postura.session import CLUSTER_DEFAULTS
from postura.sources import Files, read_snapshot, write_csv_file, write_snapshot
from testsupport.driver_fixture import AS_OF

PAIR = ["container_assurance_summary", "containers_running_with_findings_list"]


def read(path):
    with open(path, newline="") as fh:
        return list(csv.reader(fh))


def test_one_header_and_all_rows_in_order(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8).select(F.col("id"), F.concat(F.lit('say "'), F.col("id"), F.lit('", a\nb')).alias("t,x")).orderBy(F.col("id").desc())
    assert write_csv_file(df, str(tmp_path / "r.csv")) == 1000
    rows = read(tmp_path / "r.csv")
    assert rows[0] == ["id", "t,x"] and [int(r[0]) for r in rows[1:]] == list(range(999, -1, -1)) and rows[1][1] == 'say "999", a\nb'
    assert [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["r.csv"]
    # a second write replaces the first
    assert write_csv_file(df.limit(0), str(tmp_path / "r.csv")) == 0
    assert read(tmp_path / "r.csv") == [["id", "t,x"]]


def test_many_parts_keep_their_order(spark, tmp_path):
    files = Files(spark, str(tmp_path))
    for i in (3, 100000, 99999, 0):
        files.write(f"{tmp_path}/p/part-{i:05d}-x.csv", f"{i}\n".encode())
    files.write(f"{tmp_path}/p/part-00001-x.csv", b"")
    files.write(f"{tmp_path}/all.csv", b"head\n")
    files.join(f"{tmp_path}/all.csv", files.parts(f"{tmp_path}/p"))
    assert (tmp_path / "all.csv").read_text() == "head\n0\n3\n99999\n100000\n"


class _Breaking(Tables):
    """Fails in a task, after the report has begun to write."""

    def __getitem__(self, name):
        df = super().__getitem__(name)
        return df.withColumn("type", F.expr("if(id % 2 = 0, raise_error('broken row'), type)")) if name == "audit" else df


def test_a_failing_report_leaves_nothing_published(spark, driver_tables, tmp_path):
    keys = ["license_stats", "audit_malware_list"]
    records = collect(spark, driver_tables, str(tmp_path), AS_OF, keys)
    assert json.loads((tmp_path / MANIFEST).read_text())["complete"] and [r["rows"] for r in records] == [2, len(read(tmp_path / "audit_malware_list_results.csv")) - 1]
    records = collect(spark, _Breaking(driver_tables._factories), str(tmp_path), AS_OF, keys)
    assert records[1]["written"] is None and "broken row" in records[1]["reason"]
    manifest = json.loads((tmp_path / MANIFEST).read_text())
    assert not manifest["complete"] and manifest["reports"] == records
    left = sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith("."))
    assert left == [MANIFEST, "license_stats_results.csv"]


def _reads(plan: str, table: str) -> int:
    return len(re.findall(rf"FileScan parquet .*?/{table}\]", plan))


@pytest.fixture()
def stored(spark, driver_tables, tmp_path):
    for name in driver_tables.names():
        driver_tables[name].write.parquet(str(tmp_path / "stored" / name))
    return Tables.from_parquet(spark, str(tmp_path / "stored"))


def test_shared_blocks_are_made_once_and_dropped(spark, stored):
    before = {r["namespace"] for r in spark.sql("SHOW DATABASES").collect()}
    keys = [*PAIR, "container_vuln_list", "container_ns_vuln_summary"]
    alone = {k: sorted(map(repr, build_report(k, stored, spark, as_of=AS_OF).collect())) for k in keys}
    with shared_blocks(spark, stored, keys, buckets=4) as tables:
        assert FAILURES in tables and VULN_SUMMARY in tables
        for k in keys:
            report = build_report(k, tables, spark, as_of=AS_OF)
            plan = report._jdf.queryExecution().executedPlan().toString()
            # the one read of the assurance fact was the block's
            assert _reads(plan, "scan_assurance_results") == 0 and _reads(plan, "image_assurance") == 0
            assert sorted(map(repr, report.collect())) == alone[k], k
        assert _reads(build_report("container_vuln_list", tables, spark, as_of=AS_OF)._jdf.queryExecution().executedPlan().toString(), "scans") == 0
    assert {r["namespace"] for r in spark.sql("SHOW DATABASES").collect()} == before
    with shared_blocks(spark, stored, PAIR[:1]) as tables:
        assert tables is stored


def test_a_run_reads_the_assurance_fact_once(spark, stored, tmp_path, monkeypatch):
    made = []
    make, key, users = shared.BLOCKS[FAILURES]
    monkeypatch.setitem(shared.BLOCKS, FAILURES, (lambda t: made.append(1) or make(t), key, users))
    without = Tables({k: f for k, f in stored._factories.items()})
    touched = []

    class Watching(Tables):
        def __getitem__(self, name):
            touched.append(name)
            return super().__getitem__(name)

    records = collect(spark, Watching(without._factories), str(tmp_path / "out"), AS_OF, PAIR)
    assert all(r["written"] for r in records) and made == [1] and touched.count("scan_assurance_results") == 1
    for k in PAIR:
        want = write_csv_file(build_report(k, stored, spark, as_of=AS_OF), str(tmp_path / f"{k}.csv"))
        rows = read(tmp_path / "out" / f"{k}_results.csv")
        assert len(rows) == want + 1 and sorted(rows) == sorted(read(tmp_path / f"{k}.csv"))


def test_snapshot_is_joined_as_it_lies(spark, driver_tables):
    database = f"posture_{uuid.uuid4().hex[:8]}"
    conf = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "4k")  # none but the tiny policy table may be broadcast
    try:
        write_snapshot(driver_tables, spark, database, 8)
        tables = read_snapshot(spark, database)
        plans = {
            "host_assurance_summary": r"scan_id|s_id",  # assurance results with scans
            "vuln_fix_age_detail": r"scan_id",  # scans with their resources
        }
        for key, ids in plans.items():
            report = build_report(key, tables, spark, as_of=AS_OF)
            plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
            assert "Bucketed: true" in plan and not re.search(rf"Exchange hashpartitioning\(({ids})#\d+L?, ", plan), plan
            assert sorted(map(repr, report.collect())) == sorted(map(repr, build_report(key, driver_tables, spark, as_of=AS_OF).collect()))
        # vulnerabilities with resources, images with metadata
        spark.conf.set(conf, "-1")
        for left, right, on in (("known_resource_vulnerabilities", "known_resources", ("resource_id", "id")), ("registry_images", "image_metadata", ("id", "image_id"))):
            a, b = tables[left], tables[right]
            plan = a.join(b, a[on[0]] == b[on[1]])._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        for name in driver_tables.names():
            assert tables[name].count() == driver_tables[name].count()
        with pytest.raises(ValueError):
            write_snapshot(driver_tables, spark, database, 0)
    finally:
        spark.conf.set(conf, old)
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@pytest.fixture()
def severity_rule(spark):
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION rated(vendor STRING, score DOUBLE) RETURNS STRING RETURN CASE WHEN score >= 3 THEN 'bad' ELSE concat('was ', vendor) END")
    yield "rated"
    spark.sql("DROP TEMPORARY FUNCTION rated")


def test_severity_function_of_the_catalogue(spark, driver_tables, severity_rule):
    rule = catalog_severity(severity_rule, ["vendor_severity", "nvd_cvss2_score"])
    report = build_report("host_vulnerability_scan_details", driver_tables, spark, as_of=AS_OF, severity_fn=rule)
    found = {r["vuln_severity"] for r in report.select("vuln_severity").distinct().collect()}
    assert "bad" in found and "was high" in found and found <= {"bad", "was high", "was low", "was ", "critical", "medium"}
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "rated" not in plan and "CASE WHEN" in plan  # inlined


def test_runner_names_the_severity_function_and_the_snapshot(spark, driver_tables, severity_rule, tmp_path, capsys):
    for name in driver_tables.names():
        driver_tables[name].write.parquet(str(tmp_path / "in" / name))
    database = f"posture_{uuid.uuid4().hex[:8]}"
    before = {k: spark.conf.get(k, None) for k in CLUSTER_DEFAULTS}
    try:
        assert main(["--parquet-root", str(tmp_path / "in"), "--snapshot", database, "--buckets", "4"]) == 0
        common = ["--database", database, "--as-of", AS_OF, "--only", "host_vulnerability_scan_details"]
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        rated = ["--severity-function", severity_rule, "--severity-arguments", "vendor_severity", "nvd_cvss2_score"]
        assert main([*common, "--out", str(tmp_path / "rated"), *rated]) == 0
        assert main([*common, "--out", str(tmp_path / "plain")]) == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    capsys.readouterr()
    rows = {out: read(tmp_path / out / "host_vulnerability_scan_details_results.csv") for out in ("rated", "plain")}
    at = rows["plain"][0].index("vuln_severity")
    assert len(rows["rated"]) == len(rows["plain"]) > 1
    assert "bad" in {r[at] for r in rows["rated"]} and "bad" not in {r[at] for r in rows["plain"]}
