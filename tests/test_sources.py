"""Table sources, the CSV sink and the collection runner."""

from __future__ import annotations

import csv
import glob
import os

import pytest

from postura import Tables, build_report
from postura.runner import collect, collection_order
from postura.schemas import AUDIT_TABLES, COLUMNS, POSTURE_TABLES
from postura.sources import JdbcSource, Partitioning, write_csv
from testsupport.driver_fixture import AS_OF, MAPPINGS


def test_driver_fixture_defines_every_posture_table_with_the_used_columns(driver_tables):
    assert sorted(MAPPINGS) == sorted(POSTURE_TABLES)
    for name in POSTURE_TABLES:
        assert set(COLUMNS[name]) <= set(driver_tables[name].columns), name


def test_driver_timestamps_are_ntz(driver_tables):
    types = {f.name: f.dataType.simpleString() for f in driver_tables["registry_images"].schema.fields}
    assert types["created"] == "timestamp_ntz"
    types = {f.name: f.dataType.simpleString() for f in driver_tables["scans"].schema.fields}
    assert types["scan_date"] == "timestamp_ntz"


def test_schema_qualified_names_resolve(driver_tables):
    assert driver_tables["public.audit"] is driver_tables["audit"]
    with pytest.raises(KeyError):
        driver_tables["nope"]


def test_jdbc_options_and_audit_routing(spark):
    op = JdbcSource(
        url="jdbc:postgresql://db:5432/operations",
        user="u",
        password="p",
        partitioning={"scan_resources": Partitioning("scan_id", 1, 1_000_000, 64)},
    )
    opts = op.options("scan_resources")
    assert opts["dbtable"] == "public.scan_resources" and opts["numPartitions"] == "64"
    assert opts["partitionColumn"] == "scan_id" and opts["lowerBound"] == "1" and opts["upperBound"] == "1000000"
    assert "partitionColumn" not in op.options("hosts")
    audit = JdbcSource(url="jdbc:postgresql://db:5432/audit")
    calls = []

    class Probe(JdbcSource):
        def read(self, spark, table):
            calls.append((self.url, table))
            return spark.range(1)

    assert opts["preferTimestampNTZ"] == "true"
    with pytest.raises(ValueError, match="fact table"):
        JdbcSource(url=op.url).read(spark, "scans")
    t = Tables.from_jdbc(spark, Probe(url=op.url), Probe(url=audit.url))
    t["audit"], t["scans"]
    assert calls == [(audit.url, "audit"), (op.url, "scans")]
    t2 = Tables.from_jdbc(spark, Probe(url=op.url))
    t2["audit"]
    assert calls[-1] == (op.url, "audit")
    assert set(AUDIT_TABLES) == {"audit"}


def test_csv_sink_writes_header_and_empty_nulls(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1), ("", "  40.00%", None)], "k string, v string, n long")
    out = str(tmp_path / "r_results")
    write_csv(df, out)
    lines = []
    for part in sorted(glob.glob(os.path.join(out, "part-*.csv"))):
        with open(part, newline="") as fh:
            lines += list(csv.reader(fh))
    header = lines[0]
    body = [l for l in lines if l != header]
    assert header == ["k", "v", "n"]
    assert sorted(body) == sorted([["a", "", "1"], ["", "  40.00%", ""]])


def test_collect_runs_operational_then_audit_and_records_failures(spark, driver_tables, tmp_path):
    order = collection_order()
    assert order[-3:] == ["audit_hosts_findings_by_action", "audit_incidents_by_detection_type", "audit_malware_list"]
    assert "host_bench_results_details" not in order
    keys = ["image_repo_scans", "audit_malware_list"]
    recs = collect(spark, driver_tables, str(tmp_path), "2001-07-15 12:00:00", keys)
    assert [r["written"] for r in recs] == [str(tmp_path / f"{k}_results.csv") for k in keys]
    assert (tmp_path / "image_repo_scans_results.csv").is_file()
    recs = collect(spark, driver_tables, str(tmp_path / "parts"), "2001-07-15 12:00:00", keys, single_file=False)
    assert glob.glob(str(tmp_path / "parts" / "image_repo_scans_results" / "part-*.csv")) and recs[0]["rows"] > 0
    broken = Tables.from_frames({})
    recs = collect(spark, broken, str(tmp_path / "b"), "2001-07-15 12:00:00", ["image_repo_scans"])
    assert recs[0]["written"] is None and "not registered" in recs[0]["reason"]


def test_parquet_source_round_trip(spark, driver_tables, tmp_path):
    for name in ("scans", "registry_images", "registry_repositories"):
        driver_tables[name].write.parquet(str(tmp_path / name))
    t = Tables.from_parquet(spark, str(tmp_path), names=["scans", "registry_images", "registry_repositories"])
    a = sorted(tuple(r) for r in build_report("image_repo_scans", t, spark, as_of=AS_OF).collect())
    b = sorted(tuple(r) for r in build_report("image_repo_scans", driver_tables, spark, as_of=AS_OF).collect())
    assert a == b


def test_zoned_timestamps_become_wall_clock(spark):
    from postura.sources.tables import wall_clock

    df = spark.sql("SELECT TIMESTAMP'2001-07-15 12:00:00' AS t, 1 AS n")
    out = wall_clock(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["timestamp_ntz", "int"]
    assert wall_clock(out) is out


def test_collect_concurrently_keeps_order_and_outputs(spark, driver_tables, tmp_path):
    keys = ["image_repo_scans", "license_stats", "audit_malware_list", "image_growth_metrics"]
    recs = collect(spark, driver_tables, str(tmp_path), "2001-07-15 12:00:00", keys, concurrency=3)
    assert [r["report"] for r in recs] == keys and all(r["written"] for r in recs)
    for k in keys:
        assert (tmp_path / f"{k}_results.csv").is_file(), k


def test_csv_sink_timestamps_like_python_str(spark, tmp_path):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2001-07-15 12:00:00' AS a, TIMESTAMP_NTZ'2001-07-15 12:00:00.25' AS b, DATE'2001-07-15' AS d, "
        "true AS t, false AS f, CAST(NULL AS BOOLEAN) AS n"
    )
    write_csv(df, str(tmp_path / "t"))
    (part,) = glob.glob(str(tmp_path / "t" / "part-*.csv"))
    rows = list(csv.reader(open(part, newline="")))
    assert rows == [
        ["a", "b", "d", "t", "f", "n"],
        ["2001-07-15 12:00:00", "2001-07-15 12:00:00.250000", "2001-07-15", "True", "False", ""],
    ]


def test_missing_columns_reported_from_schema(spark, driver_tables):
    assert driver_tables.missing_columns() == {}
    t = Tables.from_frames({"hosts": spark.createDataFrame([("h1", "agent")], "id string, type string")})
    assert t.missing_columns() == {"hosts": ["logicalname", "status"]}


def test_a_failing_report_keeps_its_whole_reason(spark, tmp_path):
    class Broken(Tables):
        def __getitem__(self, name):
            raise RuntimeError("x" * 5000)

    (rec,) = collect(spark, Broken({}), str(tmp_path), "2001-07-15 12:00:00", ["image_repo_scans"])
    assert len(rec["reason"]) == 5000


def test_csv_sink_round_trips_quotes_commas_newlines_and_backslashes(spark, tmp_path):
    values = ['say "hi", ok', '"', "a,b", "line\nbreak", "back\\slash", '\\"', "plain", " padded "]
    df = spark.createDataFrame([(i, v, "z") for i, v in enumerate(values)], "i int, v string, z string").coalesce(1)
    write_csv(df, str(tmp_path / "q"))
    (part,) = glob.glob(str(tmp_path / "q" / "part-*.csv"))
    rows = list(csv.reader(open(part, newline="")))
    assert rows[0] == ["i", "v", "z"] and sorted(rows[1:]) == sorted([str(i), v, "z"] for i, v in enumerate(values))


def test_jdbc_flags_reach_the_sources(monkeypatch):
    from postura.runner import arguments, jdbc_sources

    monkeypatch.setenv("OP_PW", "one")
    monkeypatch.setenv("AUDIT_PW", "two")
    base = ["--jdbc-url", "jdbc:postgresql://op/db", "--out", "o", "--password-env", "OP_PW", "--partition", "scans:id:1:900:40", "--partition", "audit:id:5:50:3"]
    op, audit = jdbc_sources(arguments([*base, "--audit-jdbc-url", "jdbc:postgresql://au/db", "--audit-user", "reader", "--audit-password-env", "AUDIT_PW"]))
    assert (op.url, op.user, op.password) == ("jdbc:postgresql://op/db", "postgres", "one")
    assert (audit.url, audit.user, audit.password) == ("jdbc:postgresql://au/db", "reader", "two")
    scans = op.options("scans")
    assert (scans["partitionColumn"], scans["lowerBound"], scans["upperBound"], scans["numPartitions"]) == ("id", "1", "900", "40")
    assert audit.options("audit")["numPartitions"] == "3" and "partitionColumn" not in op.options("hosts")
    op, audit = jdbc_sources(arguments(base))
    assert (audit.url, audit.user, audit.password) == (op.url, op.user, op.password)


def test_report_instant_defaults_to_now(spark, driver_tables):
    import datetime as dt

    rows = build_report("host_added_over_time", driver_tables, spark).collect()
    assert rows[0]["month"] == dt.datetime.now(dt.timezone.utc).strftime("%b %y")


def test_runner_cli_writes_reports_and_restores(spark, driver_tables, tmp_path, capsys):
    from postura.runner import main
    from postura.session import CLUSTER_DEFAULTS

    for name in driver_tables.names():
        driver_tables[name].limit(50).write.parquet(str(tmp_path / "in" / name))
    before = {k: spark.conf.get(k, None) for k in CLUSTER_DEFAULTS}
    try:
        code = main(
            [
                "--parquet-root", str(tmp_path / "in"),
                "--out", str(tmp_path / "out"),
                "--as-of", "2001-07-15 12:00:00",
                "--only", "license_stats", "image_growth_metrics", "no_such_report",
                "--concurrency", "2",
            ]
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    printed = capsys.readouterr().out
    assert code == 1  # the unknown key is recorded as a failure, the others still run
    assert printed.count('"written": null') == 1 and printed.count('"seconds"') == 2
    rows = list(csv.reader(open(tmp_path / "out" / "license_stats_results.csv")))
    assert rows[0] == ["metric", "used", "licesned", "utilization"] and len(rows) == 3
