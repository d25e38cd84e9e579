"""Input tables and the columns the reports read from them.

The source system publishes no DDL; the types are the ones the reports pin by use
(casts, comparisons, arithmetic). JSON documents are text columns.
"""

from __future__ import annotations

OPERATIONAL_TABLES = (
    "scans",
    "scan_history",
    "scan_assurance_results",
    "image_assurance",
    "scan_resources",
    "known_resources",
    "known_resource_vulnerabilities",
    "registry_images",
    "registry_repositories",
    "image_metadata",
    "containers",
    "hosts",
    "agent_details",
    "license",
    "runtime_policies",
    "host_scan",
)
AUDIT_TABLES = ("audit",)
POSTURE_TABLES = OPERATIONAL_TABLES + AUDIT_TABLES

# tables that grow with scans and events, and the numeric column by which each is read in slices
FACT_TABLES: dict[str, str] = {
    "scans": "id",
    "scan_history": "id",
    "scan_assurance_results": "scan_id",
    "scan_resources": "scan_id",
    "known_resource_vulnerabilities": "id",
    "audit": "id",
}

COLUMNS: dict[str, tuple[str, ...]] = {
    "scans": ("id", "type", "image_id", "host_id", "scan_date", "malware", "sensitive",
              "crit_vulns", "high_vulns", "med_vulns", "low_vulns", "neg_vulns"),
    "scan_history": ("id", "host_id", "date", "status", "malware", "sensitive", "crit_vulns"),
    "scan_assurance_results": ("scan_id", "policy_id", "control", "failed"),
    "image_assurance": ("id", "name"),
    "scan_resources": ("scan_id", "resource_id"),
    "known_resources": ("id", "type", "format", "name", "version"),
    "known_resource_vulnerabilities": ("id", "resource_id", "name", "issue_type", "vendor_cvss3_score",
                                       "nvd_cvss3_score", "vendor_cvss2_score", "nvd_cvss2_score",
                                       "vendor_severity", "nvd_cvss3_severity", "publish_date", "created",
                                       "fix_version"),
    "registry_images": ("id", "name", "repository_id", "registry_id", "created"),
    "registry_repositories": ("id", "name", "registry_id"),
    "image_metadata": ("image_id", "docker_id"),
    "containers": ("id", "name", "image_name", "oci_image_id", "hostid", "scan_id", "registry_id", "level1",
                   "level2", "level3", "level3_type", "level4", "status", "isroot", "isprivileged",
                   "isregistered", "create_time", "audit_block_events", "audit_detect_events"),
    "hosts": ("id", "logicalname", "type", "status"),
    "agent_details": ("hostid", "cloud_info"),
    "license": ("status", "enforcers", "repositories", "micro_enforcers", "vm_enforcers"),
    "runtime_policies": ("name", "lastupdate", "author", "policy"),
    "host_scan": ("lastupdate", "host_id", "test_type", "config_file_name", "data"),
    "audit": ("id", "type", "category", "action", "createtime", "data"),
}
