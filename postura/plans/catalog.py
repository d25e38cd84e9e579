"""The report catalogue: key -> report function ``(tables, ctx) -> DataFrame``.

Keys are the source report names; ``vuln_fix_age_detail`` exposes the per-vulnerability
relation the fix-age summary averages, and ``host_bench_results_details`` is the benchmark
report the source ships disabled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postura.functions.vulns import SeverityFn, default_severity
from postura.plans import containers, governance, hosts, images
from postura.plans.context import Ctx
from postura.sources.tables import Tables

Report = Callable[[Tables, Ctx], DataFrame]

REPORTS: dict[str, Report] = {
    # operational database
    "container_assurance_summary": containers.container_assurance_summary,
    "container_ns_vuln_summary": containers.container_ns_vuln_summary,
    "container_vuln_list": containers.container_vuln_list,
    "containers_running_with_findings_list": containers.containers_running_with_findings_list,
    "host_added_over_time": hosts.host_added_over_time,
    "host_assurance_summary": hosts.host_assurance_summary,
    "host_findings_over_time": hosts.host_findings_over_time,
    "host_findings_region": hosts.host_findings_region,
    "host_vulnerabilities_by_cloud_tag": hosts.host_vulnerabilities_by_cloud_tag,
    "host_vulnerabilities_by_region": hosts.host_vulnerabilities_by_region,
    "host_vulnerability_scan_details": hosts.host_vulnerability_scan_details,
    "image_assurance_control_summary": images.image_assurance_control_summary,
    "image_count_over_time": images.image_count_over_time,
    "image_growth_metrics": images.image_growth_metrics,
    "image_ia_repo_results": images.image_ia_repo_results,
    "image_inventory_stats": images.image_inventory_stats,
    "image_repo_scans": images.image_repo_scans,
    "image_repo_vuln_severity_distribution": images.image_repo_vuln_severity_distribution,
    "image_vuln_fix_age_summary": images.image_vuln_fix_age_summary,
    "vuln_fix_age_detail": images.vuln_fix_age_detail,
    "image_vulns_distribution": images.image_vulns_distribution,
    "license_stats": governance.license_stats,
    "policy_runtime_enabled": governance.policy_runtime_enabled,
    # audit database
    "audit_hosts_findings_by_action": governance.audit_hosts_findings_by_action,
    "audit_incidents_by_detection_type": governance.audit_incidents_by_detection_type,
    "audit_malware_list": governance.audit_malware_list,
    # shipped disabled by the source
    "host_bench_results_details": hosts.host_bench_results_details,
}

AUDIT_REPORTS = ("audit_hosts_findings_by_action", "audit_incidents_by_detection_type", "audit_malware_list")
DISABLED_REPORTS = ("host_bench_results_details",)


def report_keys(include_disabled: bool = True) -> list[str]:
    """Catalogue keys, optionally without the report the source ships disabled."""
    return [k for k in REPORTS if include_disabled or k not in DISABLED_REPORTS]


def build_report(
    key: str,
    tables: Tables,
    spark: SparkSession,
    as_of: str | None = None,
    severity_fn: SeverityFn = default_severity,
) -> DataFrame:
    """Build (lazily) the DataFrame of one report over ``tables`` at the report instant ``as_of`` (now, in UTC, if none is given)."""
    if as_of is None:
        as_of = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return REPORTS[key](tables, Ctx(spark=spark, as_of=as_of, severity_fn=severity_fn))
