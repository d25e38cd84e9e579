"""Report semantics on hand-built rows, against values worked out by hand."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest

from postura import Tables, build_report
from testsupport.edge_fixture import edge_frames

AS_OF = "2001-07-15 12:00:00"


@pytest.fixture(scope="module")
def edge(spark, driver_tables):
    return Tables.from_frames(edge_frames(spark, driver_tables))


def run(spark, tables, key, as_of=AS_OF):
    return build_report(key, tables, spark, as_of=as_of).collect()


def test_findings_list_or_join_latest_scans_and_entries(spark, edge):
    rows = run(spark, edge, "containers_running_with_findings_list")
    by_c = {}
    for r in rows:
        by_c.setdefault(r.container_id, []).append(r)
    assert sorted(by_c) == ["c1", "c2", "c4", "c5"]  # exited c3 left out
    c1 = by_c["c1"]
    # NULL-dated scan 6 is the latest image scan; equal host dates resolve to the higher id
    assert {(r.ir_scan_id, r.hr_scan_id, r.i_scan_entry, r.h_scan_entry) for r in c1} == {(6, 11, 1, 1)}
    assert Counter((r.failed_policy_type, r.failed_policy, r.failed_control) for r in c1) == Counter(
        {
            ("image", "policy-1", "ctl-a"): 2,  # scans 1 and 6
            ("host", "policy-1", "ctl-a"): 1,  # scan 11
            ("container", "Default", "root"): 1,
            ("container", "Default", "not_registered"): 1,  # NULL isprivileged does not count
        }
    )
    assert sorted(r.container_entry for r in c1) == [1, 2, 3, 4, 5]
    assert [(r.failed_control, r.container_entry, r.ir_scan_id) for r in by_c["c2"]] == [(None, 1, None)]
    c4 = Counter((r.failed_policy_type, r.failed_control) for r in by_c["c4"])
    # scan 12 (own and host key, counted once), image scan 6, privileged; a NULL control is still listed
    assert c4 == Counter({("host", "ctl-b"): 1, ("host", None): 1, ("image", "ctl-a"): 1, ("container", "privileged"): 1})
    assert [(r.failed_control, r.c_runtime_events) for r in by_c["c4"] if r.failed_control == "privileged"] == [
        ("privileged", None)
    ]
    assert {r.query_time for r in rows} == {dt.datetime(2001, 7, 15, 12)}


def test_container_assurance_summary_routes(spark, edge):
    got = {(r.failed_control_type, r.failed_control): tuple(r)[2:] for r in run(spark, edge, "container_assurance_summary")}
    assert got == {
        ("image", "ctl-a"): (2, 1, 2, 1, 1),
        ("container", "root"): (1, 1, 1, 1, 1),
        ("container", "not_registered"): (1, 1, 1, 1, 1),
        ("host", "ctl-b"): (1, 0, 1, 1, 1),
        ("container", "privileged"): (1, 0, 1, 1, 1),
    }


def test_license_stats_sentinels(spark, edge):
    got = [tuple(r) for r in run(spark, edge, "license_stats")]
    assert sorted(got) == [("Enforcers", 2, 10, "  20.00%"), ("Repositories", 4, 10, "  40.00%")]


def test_license_minus_two_means_unlimited(spark, driver_tables, edge):
    frames = edge_frames(spark, driver_tables)
    lic = spark.createDataFrame(
        [("Active", -2, 1, 1, 1), ("Active", 5, 1, 1, 1)], frames["license"].schema
    )
    t = Tables.from_frames({**frames, "license": lic})
    got = sorted(tuple(r) for r in run(spark, t, "license_stats"))
    assert got == [("Enforcers", 2, -1, "-200.00%"), ("Repositories", 4, -1, "-400.00%")]
    none_active = spark.createDataFrame([("Expired", 5, 1, 1, 1)], frames["license"].schema)
    t = Tables.from_frames({**frames, "license": none_active})
    assert sorted(tuple(r) for r in run(spark, t, "license_stats")) == [("Enforcers", 2, None, None), ("Repositories", 4, None, None)]


def test_fix_age_cases(spark, edge):
    got = {(r.repo_name, r.vuln_name): r for r in run(spark, edge, "vuln_fix_age_detail")}
    assert sorted(got) == [("repoA", "CVE-1"), ("repoA", "CVE-2"), ("repoB", "CVE-3"), ("repoC", "CVE-1")]
    a = got[("repoA", "CVE-1")]  # last seen in the newest image: not fixed, age up to the report date
    assert (a.age_in_days, a.fixed, a.fixed_in_image, a.fix_image_date) == (561, False, "", None)
    assert (a.first_found_image, a.first_found_image_date, a.vuln_score, a.vuln_severity) == ("a:1", dt.date(2000, 1, 1), 7.5, "high")
    b = got[("repoB", "CVE-3")]  # first and last on one date: "next" is the second-newest later image (b:4, not b:3)
    assert (b.age_in_days, b.fixed, b.fixed_in_image, b.fix_image_date) == (60, True, "b:4", dt.date(2000, 3, 1))
    c = got[("repoC", "CVE-1")]  # last = first; the NULL-dated image counts as the newest (DESC NULLS FIRST)
    assert (c.age_in_days, c.fixed, c.fixed_in_image, c.fix_image_date) == (440, True, "c:1", None)
    summary = {(r.registry, r.repo_name, r.fixed): r.avg_age_in_days for r in run(spark, edge, "image_vuln_fix_age_summary")}
    assert summary == {("reg-1", "repoA", False): 561, ("reg-2", "repoB", True): 60, ("reg-1", "repoC", True): 440}


def test_policy_runtime_enabled_entries(spark, edge):
    got = sorted((r.name, r.control, r.control_enabled, r.enabled, r.enforced) for r in run(spark, edge, "policy_runtime_enabled"))
    assert got == [("p1", "drift", "true", "true", "false"), ("p1", "exec_control", "true", "true", "false")]


def test_cloud_tag_split_and_weights(spark, edge):
    got = [tuple(r) for r in run(spark, edge, "host_vulnerabilities_by_cloud_tag")]
    # h1 once (scans 10, 11) and h3 twice (scan 12 per repeated tag): crit 1,2,3,3 -> 2.25 -> 2; neg 1,2 -> 1.5 -> 2
    assert got == [("env", "prod", 2, 2, 1, 1, 1, 2)]


def test_host_tags_parsing(spark, edge):
    from postura.plans.blocks import host_tags

    got = Counter((r.hostid, r.tag_name, r.tag_value) for r in host_tags(edge).collect())
    assert got == Counter(
        {
            ("h1", "env", "prod"): 1,
            ("h1", "own:team", "t1"): 1,
            ("h1", "k", "v"): 1,
            ("h1", "7", ""): 1,
            ("h1", None, None): 1,
            ("h1", "plain", ""): 1,
            ("h3", "env", "prod"): 2,
        }
    )


def test_bench_percentages_and_null_category(spark, edge):
    rows = run(spark, edge, "host_bench_results_details")
    assert {r.host_id for r in rows} == {"h1", "h3"}  # h9 is not a known host
    h1 = [r for r in rows if r.host_id == "h1"]
    assert len(h1) == 7
    assert {(r.host_pass_pct, r.host_fail_pct, r.host_warn_pct, r.host_info_pct) for r in h1} == {(67.0, 17.0, 17.0, 17.0)}
    xpass = [r for r in h1 if r.test_number == "1.3"][0]
    assert (xpass.test_pass, xpass.category, xpass.section_pass_pct) == (2, "dockerbench", 100.0)
    nosection = [r for r in h1 if r.test_number == "3.1"][0]
    assert nosection.section is None and nosection.section_pass_pct is None and nosection.category_pass_pct == 50.0
    h3 = [r for r in rows if r.host_id == "h3"]
    assert {(r.host_pass_pct, r.category_pass_pct, r.section_pass_pct) for r in h3} == {(67.0, None, None)}


def test_vulns_distribution_zero_total_gives_null(spark, driver_tables):
    frames = edge_frames(spark, driver_tables)
    zero = frames["scans"].where("type = 'image'").selectExpr(
        "id", "type", "image_id", "host_id", "scan_date", "malware", "sensitive",
        "0 as crit_vulns", "0 as high_vulns", "0 as med_vulns", "0 as low_vulns", "0 as neg_vulns",
    )
    t = Tables.from_frames({**frames, "scans": zero})
    got = run(spark, t, "image_vulns_distribution")
    assert {r.images for r in got} == {"In running containers", "In other scanned images"}
    assert all(r.critical is None and r.negligible is None for r in got)


def test_image_count_over_time_month_end_against_brute_force(spark, driver_tables):
    from postura.operators import month_spine

    as_of = "2001-03-31 00:00:00"
    frames = edge_frames(spark, driver_tables)
    extra = spark.createDataFrame(
        [
            (601, "x", 9, "r", dt.datetime(2000, 4, 30, 0, 0, 0)),
            (602, "x", 9, "r", dt.datetime(2000, 4, 30, 0, 0, 1)),
            (603, "x", 9, "r", dt.datetime(2001, 3, 30, 12)),
            (604, "x", 9, "r", dt.datetime(2001, 2, 28, 0)),
            (605, "x", 9, "r", dt.datetime(1999, 1, 1)),
            (606, "x", 9, "r", dt.datetime(2001, 4, 1)),
        ],
        frames["registry_images"].schema,
    )
    images = frames["registry_images"].unionByName(extra)
    t = Tables.from_frames({**frames, "registry_images": images})
    got = [tuple(r) for r in run(spark, t, "image_count_over_time", as_of=as_of)]
    created = [r.created for r in images.collect() if r.created is not None]
    spine = sorted((r.datemonth for r in month_spine(spark, as_of).collect()), reverse=True)
    expected = [
        (s.strftime("%b %y"), sum(c <= s for c in created), sum(c.strftime("%m%y") == s.strftime("%m%y") for c in created))
        for s in spine
    ]
    assert got == expected


def test_fix_age_same_date_with_only_one_newer_image(spark, driver_tables):
    """First and last on one date and a single newer image: OFFSET 1 finds nothing, so the
    newest image stands in as "next"."""
    frames = edge_frames(spark, driver_tables)
    D = dt.datetime
    rr = spark.createDataFrame([(7, "repoD", "reg-9")], frames["registry_repositories"].schema)
    ri = spark.createDataFrame(
        [(701, "d:1", 7, "reg-9", D(2000, 1, 1)), (702, "d:2", 7, "reg-9", D(2000, 1, 1, 5)), (703, "d:3", 7, "reg-9", D(2000, 1, 21))],
        frames["registry_images"].schema,
    )
    im = spark.createDataFrame([(701, "x701"), (702, "x702"), (703, "x703")], frames["image_metadata"].schema)
    sc = frames["scans"].limit(0).unionByName(
        spark.createDataFrame(
            [(71, "image", 701, None, D(2001, 1, 1), 0, 0, 0, 0, 0, 0, 0), (72, "image", 702, None, D(2001, 1, 1), 0, 0, 0, 0, 0, 0, 0)],
            frames["scans"].schema,
        )
    )
    sr = spark.createDataFrame([(71, 1), (72, 1)], frames["scan_resources"].schema)
    t = Tables.from_frames(
        {**frames, "registry_repositories": rr, "registry_images": ri, "image_metadata": im, "scans": sc, "scan_resources": sr}
    )
    got = {r.vuln_name: r for r in run(spark, t, "vuln_fix_age_detail")}
    assert sorted(got) == ["CVE-1", "CVE-2"]
    r = got["CVE-1"]
    assert (r.first_found_image, r.age_in_days, r.fixed, r.fixed_in_image, r.fix_image_date) == (
        "d:1", 20, True, "d:3", dt.date(2000, 1, 21)
    )


def test_runtime_policy_entries_that_are_text_are_not_objects(spark):
    policy = '{"enabled":true,"enforce":false,"exec_control":{"enabled":true},"off":{"enabled":false},"note":"{\\"enabled\\":true}","list":[1],"none":null,"n":1}'
    frames = {"runtime_policies": spark.createDataFrame([("p", 1, "a", policy), ("q", 1, "a", None)], "name string, lastupdate long, author string, policy string")}
    rows = run(spark, Tables.from_frames(frames), "policy_runtime_enabled")
    assert [(r["control"], r["control_enabled"]) for r in rows] == [("exec_control", "true")]


def test_top_ten_cuts_repositories(spark):
    from testsupport.driver_fixture import posture_from_driver

    tables = posture_from_driver(spark, "/root/testdata/sf0.01")
    assert tables["registry_repositories"].count() > 10
    for key in ("image_repo_scans", "image_ia_repo_results", "image_repo_vuln_severity_distribution"):
        assert len(run(spark, tables, key)) == 10
