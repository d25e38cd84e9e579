"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from postura import REPORTS, Tables, build_report
from testsupport.driver_fixture import AS_OF

# reports whose only nested-loop joins are single-row cross joins of global aggregates
SINGLE_ROW_CROSS = {"image_inventory_stats", "license_stats"}
TOP_K_PER_KEY = {
    "container_vuln_list",
    "container_ns_vuln_summary",
    "containers_running_with_findings_list",
    "image_vuln_fix_age_summary",
    "vuln_fix_age_detail",
}


def _plan(spark, tables, key) -> str:
    return build_report(key, tables, spark, as_of=AS_OF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", list(REPORTS))
def test_no_python_and_no_unbounded_nested_loops(spark, driver_tables, key):
    plan = _plan(spark, driver_tables, key)
    assert not re.search(r"EvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow", plan)
    assert "CartesianProduct" not in plan
    if key not in SINGLE_ROW_CROSS:
        assert "NestedLoopJoin" not in plan


@pytest.mark.parametrize("key,joins", [("image_inventory_stats", 4), ("license_stats", 2)])
def test_cross_joins_only_between_global_aggregates(spark, driver_tables, key, joins):
    plan = _plan(spark, driver_tables, key)
    assert plan.count("BroadcastNestedLoopJoin") == joins
    # joins + 1 single-row inputs, each a global (key-less) aggregate
    assert len(re.findall(r"HashAggregate\(keys=\[\], functions=\[[^\]]*\], output", plan)) >= joins + 1


@pytest.mark.parametrize("key", sorted(TOP_K_PER_KEY))
def test_top_k_per_key_is_limited_before_the_shuffle(spark, driver_tables, key):
    plan = _plan(spark, driver_tables, key)
    assert re.search(r"WindowGroupLimit .* Partial", plan)


def test_filters_and_columns_reach_the_scan(spark, driver_tables):
    plan = _plan(spark, driver_tables, "image_repo_scans")
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l]
    assert scans and all("ReadSchema" in l for l in scans)
    # the orders scan reads only the columns the report needs
    orders = [l for l in scans if "o_orderkey" in l][0]
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders


def _executed(df) -> str:
    """The final plan of an executed query, without the plan it started from."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.fixture(scope="module")
def stored_tables(spark, driver_tables, tmp_path_factory):
    """The posture tables as files of their own, so that a plan's scans name them."""
    root = tmp_path_factory.mktemp("stored")
    for name in driver_tables.names():
        driver_tables[name].write.parquet(str(root / name))
    return Tables.from_parquet(spark, str(root))


def _scans(plan: str) -> Counter:
    return Counter(re.findall(r"FileScan parquet .*?/stored\d*/(\w+)\]", plan))


@pytest.mark.parametrize("key", ["image_vuln_fix_age_summary", "vuln_fix_age_detail"])
def test_fix_age_reads_each_table_once(spark, stored_tables, no_broadcast, key):
    scans = _scans(_executed(build_report(key, stored_tables, spark, as_of=AS_OF)))
    assert set(scans.values()) == {1} and len(scans) == 7, scans


def test_benchmark_documents_are_read_and_parsed_once(spark, stored_tables, no_broadcast):
    plan = _executed(build_report("host_bench_results_details", stored_tables, spark, as_of=AS_OF))
    assert _scans(plan) == {"host_scan": 1, "hosts": 1} and plan.count("from_json") == 1


@pytest.mark.parametrize(
    "key,reads",
    [("container_assurance_summary", {"scan_assurance_results": 1, "scans": 2}), ("containers_running_with_findings_list", {"scan_assurance_results": 1, "scans": 3})],
)
def test_keys_restrict_the_scans_before_the_assurance_fact(spark, stored_tables, no_broadcast, key, reads):
    df = build_report(key, stored_tables, spark, as_of=AS_OF)
    plan = _executed(df)
    scans = _scans(plan)
    assert {t: scans[t] for t in reads} == reads and scans["containers"] == 2, scans
    # the side that meets the fact by scan id is a semi join of scans with the needed keys
    optimised = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(optimised) if re.search(r"Join Inner, \(scan_id#\d+L? = s_id#\d+L?\)", line))
    depth = len(re.match(r"[\s:+-]*", optimised[at]).group())
    sides = "\n".join(line for line in optimised[at + 1 :] if len(re.match(r"[\s:+-]*", line).group()) > depth)
    assert re.search(r"Join LeftSemi, \(\w+#\d+L? = k_id#\d+L?\)", sides)


@pytest.mark.parametrize("key", list(REPORTS))
def test_no_row_is_repeated_for_distinct_counts(spark, driver_tables, key):
    assert not re.search(r"\bExpand \[", _plan(spark, driver_tables, key))


def test_container_window_needs_no_shuffle_of_its_own(spark, driver_tables, no_broadcast):
    plan = _plan(spark, driver_tables, "containers_running_with_findings_list")
    top = plan.split("SortMergeJoin")[0]
    # container_entry is numbered where the wide rows met their failures by container id
    assert len(re.findall(r"Exchange hashpartitioning", top)) == 0
    assert len(re.findall(r"\bWindow \[", top)) == 1


def test_scan_fact_is_aggregated_before_host_joins(spark, driver_tables):
    plan = _plan(spark, driver_tables, "host_findings_region")
    join_pos = plan.find("Join")
    agg_pos = plan.rfind("partial_count")
    assert join_pos != -1 and agg_pos > join_pos  # partial aggregate sits below (after, in text) the join
