"""Hand-built posture tables with the edge cases the driver data does not plant.

Column types follow the driver-derived tables, so the same reports and oracles apply.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from postura.sources.tables import Tables

D = dt.datetime


def _tags(*tags) -> str:
    return json.dumps({"vm_vendor_name": "aws", "vm_location": "eu-1", "vm_tags": list(tags)})


ROWS: dict[str, list[dict]] = {
    "registry_repositories": [
        {"id": 1, "name": "repoA", "registry_id": "reg-1"},
        {"id": 2, "name": "repoB", "registry_id": "reg-2"},
        {"id": 3, "name": "repoC", "registry_id": "reg-1"},
    ],
    "registry_images": [
        {"id": 101, "name": "a:1", "repository_id": 1, "registry_id": "reg-1", "created": D(2000, 1, 1, 10)},
        {"id": 102, "name": "a:2", "repository_id": 1, "registry_id": "reg-1", "created": D(2000, 2, 1, 10)},
        {"id": 103, "name": "a:3", "repository_id": 1, "registry_id": "reg-1", "created": D(2000, 3, 1, 10)},
        {"id": 201, "name": "b:1", "repository_id": 2, "registry_id": "reg-2", "created": D(2000, 1, 1, 9)},
        {"id": 202, "name": "b:2", "repository_id": 2, "registry_id": "reg-2", "created": D(2000, 1, 1, 11)},
        {"id": 203, "name": "b:3", "repository_id": 2, "registry_id": "reg-2", "created": D(2000, 2, 1)},
        {"id": 204, "name": "b:4", "repository_id": 2, "registry_id": "reg-2", "created": D(2000, 3, 1)},
        {"id": 205, "name": "b:5", "repository_id": 2, "registry_id": "reg-2", "created": D(2000, 4, 1)},
        {"id": 301, "name": "c:1", "repository_id": 3, "registry_id": "reg-1", "created": None},
        {"id": 302, "name": "c:2", "repository_id": 3, "registry_id": "reg-1", "created": D(2000, 5, 1)},
        {"id": 401, "name": "a:nometa", "repository_id": 1, "registry_id": "reg-1", "created": D(2000, 6, 1)},
        {"id": 501, "name": "new:1", "repository_id": 9, "registry_id": "reg-3", "created": D(2001, 7, 10)},
        {"id": 502, "name": "new:2", "repository_id": 9, "registry_id": "reg-3", "created": D(2001, 7, 15, 13)},
        {"id": 503, "name": "new:3", "repository_id": 9, "registry_id": "reg-3", "created": D(2001, 6, 15, 12)},
        {"id": 504, "name": "old:1", "repository_id": 9, "registry_id": "reg-3", "created": D(1901, 7, 1)},
    ],
    "image_metadata": [
        {"image_id": i, "docker_id": f"d{i}"}
        for i in (101, 102, 103, 201, 202, 203, 204, 205, 301, 302, 501, 502, 503, 504)
    ],
    "scans": [
        # image scans; image 101 has a NULL-dated scan, which is "latest" under DESC NULLS FIRST
        {"id": 1, "type": "image", "image_id": 101, "scan_date": D(2001, 1, 1), "crit_vulns": 1, "high_vulns": 2,
         "med_vulns": 3, "low_vulns": 4, "neg_vulns": 5, "malware": 0, "sensitive": 1},
        {"id": 6, "type": "image", "image_id": 101, "scan_date": None, "crit_vulns": 0, "high_vulns": 0,
         "med_vulns": 0, "low_vulns": 0, "neg_vulns": 0, "malware": 1, "sensitive": 0},
        {"id": 2, "type": "image", "image_id": 103, "scan_date": D(2001, 2, 1), "crit_vulns": 2, "high_vulns": 0,
         "med_vulns": 0, "low_vulns": 0, "neg_vulns": None, "malware": 0, "sensitive": 0},
        {"id": 3, "type": "image", "image_id": 201, "scan_date": D(2001, 3, 1), "crit_vulns": 0, "high_vulns": 1,
         "med_vulns": 0, "low_vulns": 0, "neg_vulns": 0, "malware": 0, "sensitive": 0},
        {"id": 4, "type": "image", "image_id": 202, "scan_date": D(2001, 3, 1), "crit_vulns": 0, "high_vulns": 1,
         "med_vulns": 0, "low_vulns": 0, "neg_vulns": 0, "malware": 0, "sensitive": 0},
        {"id": 5, "type": "image", "image_id": 302, "scan_date": D(2001, 3, 2), "crit_vulns": 0, "high_vulns": 0,
         "med_vulns": 0, "low_vulns": 0, "neg_vulns": 0, "malware": 0, "sensitive": 0},
        {"id": 7, "type": "image", "image_id": 999, "scan_date": D(2001, 3, 2), "crit_vulns": 9, "high_vulns": 9,
         "med_vulns": 9, "low_vulns": 9, "neg_vulns": 9, "malware": 0, "sensitive": 0},
        # host scans; two equal dates for h1 (tie broken by the higher id)
        {"id": 10, "type": "host", "host_id": "h1", "scan_date": D(2001, 4, 1), "crit_vulns": 1, "high_vulns": 1,
         "med_vulns": 1, "low_vulns": 1, "neg_vulns": 1, "malware": 1, "sensitive": 2},
        {"id": 11, "type": "host", "host_id": "h1", "scan_date": D(2001, 4, 1), "crit_vulns": 2, "high_vulns": 2,
         "med_vulns": 2, "low_vulns": 2, "neg_vulns": 2, "malware": 0, "sensitive": 0},
        {"id": 12, "type": "host", "host_id": "h3", "scan_date": D(2001, 4, 2), "crit_vulns": 3, "high_vulns": 0,
         "med_vulns": 0, "low_vulns": 0, "neg_vulns": None, "malware": None, "sensitive": None},
        {"id": 13, "type": "host", "host_id": None, "scan_date": D(2001, 4, 3), "crit_vulns": 0, "high_vulns": 0,
         "med_vulns": 0, "low_vulns": 0, "neg_vulns": 0, "malware": 0, "sensitive": 0},
    ],
    "scan_history": [
        {"id": 1, "host_id": "h1", "date": D(2001, 2, 3), "status": "finished", "malware": 1, "sensitive": 0, "crit_vulns": 2},
        {"id": 2, "host_id": "h1", "date": D(2001, 3, 3), "status": "finished", "malware": 0, "sensitive": 1, "crit_vulns": 1},
        {"id": 3, "host_id": "h2", "date": D(2001, 3, 9), "status": "failed", "malware": 5, "sensitive": 5, "crit_vulns": 5},
        {"id": 4, "host_id": None, "date": D(2001, 3, 9), "status": "finished", "malware": 7, "sensitive": 7, "crit_vulns": 7},
        {"id": 5, "host_id": "h3", "date": D(1901, 3, 1), "status": "finished", "malware": None, "sensitive": None, "crit_vulns": None},
        {"id": 6, "host_id": "h4", "date": None, "status": "finished", "malware": 1, "sensitive": 1, "crit_vulns": 1},
    ],
    "scan_assurance_results": [
        {"scan_id": 1, "policy_id": 1, "control": "ctl-a", "failed": True},
        {"scan_id": 1, "policy_id": 2, "control": "ctl-b", "failed": None},
        {"scan_id": 6, "policy_id": 1, "control": "ctl-a", "failed": True},
        {"scan_id": 2, "policy_id": 7, "control": "ctl-c", "failed": True},
        {"scan_id": 3, "policy_id": 1, "control": "ctl-a", "failed": False},
        {"scan_id": 10, "policy_id": 1, "control": "ctl-a", "failed": False},
        {"scan_id": 11, "policy_id": 1, "control": "ctl-a", "failed": True},
        {"scan_id": 12, "policy_id": 2, "control": "ctl-b", "failed": True},
        {"scan_id": 12, "policy_id": 1, "control": None, "failed": True},
    ],
    "image_assurance": [{"id": 1, "name": "policy-1"}, {"id": 2, "name": "policy-2"}],
    "scan_resources": [
        {"scan_id": 1, "resource_id": 1}, {"scan_id": 2, "resource_id": 1}, {"scan_id": 3, "resource_id": 2},
        {"scan_id": 4, "resource_id": 2}, {"scan_id": 5, "resource_id": 3}, {"scan_id": 10, "resource_id": 1},
        {"scan_id": 12, "resource_id": 2}, {"scan_id": 12, "resource_id": 4},
    ],
    "known_resources": [
        {"id": r, "type": "package", "format": "deb", "name": f"pkg{r}", "version": f"1.{r}"} for r in (1, 2, 3)
    ],
    "known_resource_vulnerabilities": [
        {"id": 11, "resource_id": 1, "name": "CVE-1", "issue_type": "vulnerability", "vendor_cvss3_score": 7.5,
         "nvd_cvss3_score": 0.0, "vendor_cvss2_score": 0.0, "nvd_cvss2_score": 0.0, "vendor_severity": "high",
         "nvd_cvss3_severity": "", "publish_date": "2000-01-15", "created": "2023-99-99", "fix_version": "2.0"},
        {"id": 12, "resource_id": 1, "name": "CVE-2", "issue_type": "vulnerability", "vendor_cvss3_score": 0.0,
         "nvd_cvss3_score": 9.1, "vendor_cvss2_score": 0.0, "nvd_cvss2_score": None, "vendor_severity": "",
         "nvd_cvss3_severity": "critical", "publish_date": None, "created": "2000-02-02", "fix_version": None},
        {"id": 13, "resource_id": 2, "name": "CVE-3", "issue_type": "vulnerability", "vendor_cvss3_score": 0.0,
         "nvd_cvss3_score": 0.0, "vendor_cvss2_score": 0.0, "nvd_cvss2_score": None, "vendor_severity": "",
         "nvd_cvss3_severity": "", "publish_date": "unknown", "created": None, "fix_version": None},
        {"id": 14, "resource_id": 3, "name": "CVE-1", "issue_type": "vulnerability", "vendor_cvss3_score": 0.0,
         "nvd_cvss3_score": 0.0, "vendor_cvss2_score": 5.0, "nvd_cvss2_score": 1.0, "vendor_severity": "medium",
         "nvd_cvss3_severity": "low", "publish_date": "2000-13-40", "created": "2000-01-01", "fix_version": "3"},
        {"id": 15, "resource_id": 1, "name": "LIC-1", "issue_type": "license", "vendor_cvss3_score": 1.0,
         "nvd_cvss3_score": 1.0, "vendor_cvss2_score": 1.0, "nvd_cvss2_score": 1.0, "vendor_severity": "low",
         "nvd_cvss3_severity": "low", "publish_date": None, "created": None, "fix_version": None},
        {"id": 16, "resource_id": 4, "name": "CVE-9", "issue_type": "vulnerability", "vendor_cvss3_score": 0.0,
         "nvd_cvss3_score": 0.0, "vendor_cvss2_score": 0.0, "nvd_cvss2_score": 0.0, "vendor_severity": "",
         "nvd_cvss3_severity": "", "publish_date": None, "created": None, "fix_version": None},
    ],
    "hosts": [
        {"id": "h1", "logicalname": "node1.r1.example", "type": "agent", "status": "connect"},
        {"id": "h2", "logicalname": "node2", "type": "agent", "status": "disconnect"},
        {"id": "h3", "logicalname": "node3.r2", "type": "vm", "status": "connect"},
        {"id": "h5", "logicalname": "node5", "type": "agent", "status": "connect"},
    ],
    "agent_details": [
        {"hostid": "h1", "cloud_info": _tags("env:prod", "own:team:t1", "k:v,extra", 7, None, "plain")},
        {"hostid": "h2", "cloud_info": json.dumps({"vm_vendor_name": "gcp", "vm_location": "us-1", "vm_tags": None})},
        {"hostid": "h3", "cloud_info": _tags("env:prod", "env:prod")},
        {"hostid": "h5", "cloud_info": json.dumps({"vm_vendor_name": "aws", "vm_location": "eu-1", "vm_tags": []})},
    ],
    "containers": [
        # two routes (own scan id and the image's scan) to the same failure of scan 1
        {"id": "c1", "name": "web", "image_name": "a:1", "oci_image_id": "d101", "hostid": "h1", "scan_id": 1,
         "registry_id": "reg-1", "level1": "k1", "level2": "ns1", "level3": "ctl1", "level3_type": "Deployment",
         "level4": "pod1", "status": "running", "isroot": True, "isprivileged": None, "isregistered": False,
         "create_time": 990000000, "audit_block_events": 1, "audit_detect_events": 2},
        {"id": "c2", "name": "noimg", "image_name": None, "oci_image_id": None, "hostid": "h9", "scan_id": None,
         "registry_id": "reg-1", "level1": "k1", "level2": "ns1", "level3": "ctl2", "level3_type": "DaemonSet",
         "level4": "pod2", "status": "running", "isroot": False, "isprivileged": False, "isregistered": True,
         "create_time": 990003600, "audit_block_events": 0, "audit_detect_events": 0},
        {"id": "c3", "name": "gone", "image_name": "b:1", "oci_image_id": "d201", "hostid": "h1", "scan_id": 3,
         "registry_id": "reg-2", "level1": "k2", "level2": "ns2", "level3": "ctl3", "level3_type": "Deployment",
         "level4": "pod3", "status": "exited", "isroot": True, "isprivileged": True, "isregistered": True,
         "create_time": 990007200, "audit_block_events": 0, "audit_detect_events": 1},
        {"id": "c4", "name": "api", "image_name": None, "oci_image_id": "d101", "hostid": "h3", "scan_id": 12,
         "registry_id": "reg-1", "level1": "k2", "level2": "ns1", "level3": "ctl1", "level3_type": "Deployment",
         "level4": "pod4", "status": "running", "isroot": None, "isprivileged": True, "isregistered": None,
         "create_time": 990010800, "audit_block_events": None, "audit_detect_events": 1},
        {"id": "c5", "name": "batch", "image_name": "b:2", "oci_image_id": "d202", "hostid": "h1", "scan_id": None,
         "registry_id": "reg-2", "level1": "k1", "level2": "ns2", "level3": "ctl5", "level3_type": "Job",
         "level4": "pod5", "status": "running", "isroot": False, "isprivileged": False, "isregistered": True,
         "create_time": 990014400, "audit_block_events": 0, "audit_detect_events": 0},
    ],
    "license": [
        {"status": "Active", "enforcers": 10, "repositories": 4, "micro_enforcers": -2, "vm_enforcers": 1},
        {"status": "Active", "enforcers": -1, "repositories": 8, "micro_enforcers": 3, "vm_enforcers": None},
        {"status": "Expired", "enforcers": 100, "repositories": 100, "micro_enforcers": 100, "vm_enforcers": 100},
    ],
    "runtime_policies": [
        {"name": "p1", "lastupdate": 990000000, "author": "alice", "policy": json.dumps(
            {"enabled": True, "enforce": False, "label": "x", "exec_control": {"enabled": True, "list": [1]},
             "net_control": {"enabled": False}, "file_control": {}, "drift": {"enabled": "true"}, "n": None})},
        {"name": "p2", "lastupdate": 990000060, "author": "bob", "policy": json.dumps(
            {"enabled": False, "exec_control": {"enabled": True}})},
    ],
    "audit": [
        {"id": 1, "type": "Runtime", "category": "Exec", "action": "Block", "createtime": 990000000,
         "data": json.dumps({"result": 2, "signature_name": "sig-1"})},
        {"id": 2, "type": "Runtime", "category": "EXEC", "action": "Block", "createtime": 990000100,
         "data": json.dumps({"result": 1, "signature_name": None, "control": "ctl-x"})},
        {"id": 3, "type": "Malware", "category": "file", "action": "Alert", "createtime": 990000200,
         "data": json.dumps({"result": "2", "malware": "eicar", "malware_type": "virus", "malware_scan_type": "image",
                             "resource": "/bin/x", "host": "h1", "action": "alert", "control": "av"})},
        {"id": 4, "type": "Malware", "category": "file", "action": "Scan", "createtime": 990000300,
         "data": json.dumps({"result": 1, "malware": "m2", "control": "av"})},
        {"id": 5, "type": "Docker", "category": "net", "action": "exec", "createtime": 990000400,
         "data": json.dumps({"result": 1})},
        {"id": 6, "type": "Login", "category": "auth", "action": "login", "createtime": 990000500,
         "data": json.dumps({"result": 2, "control": "mfa"})},
        {"id": 7, "type": "host.runtime", "category": "Exec", "action": "Block", "createtime": 990000600,
         "data": json.dumps({"result": 2, "signature_name": "sig-1"})},
    ],
    "host_scan": [
        {"lastupdate": 990000000, "host_id": "h1", "test_type": "cis", "config_file_name": None, "data": json.dumps(
            {"result": {"tests": {"results": [
                {"desc": "d1", "section": "1", "fail": 1, "pass": 1, "warn": 0, "info": 0, "results": [
                    {"test_number": "1.1", "test_desc": "a", "status": "PASS"},
                    {"test_number": "1.2", "test_desc": "b", "status": "FAIL"},
                    {"test_number": "1.3", "test_desc": "c", "status": "XPASS"}]},
                {"desc": "d2", "section": "2", "results": [
                    {"test_number": "2.1", "test_desc": "d", "status": "WARN"},
                    {"test_number": "2.2", "test_desc": "e", "status": None}]}]}}})},
        {"lastupdate": 990000060, "host_id": "h1", "test_type": "kube", "config_file_name": "kube.yaml", "data": json.dumps(
            {"result": {"Controls": [{"tests": [
                {"desc": None, "section": "3", "results": [
                    {"test_number": "3.1", "test_desc": "f", "status": "INFO"},
                    {"test_number": "3.2", "test_desc": "g", "status": "PASS"}]}]}]}})},
        {"lastupdate": 990000120, "host_id": "h3", "test_type": None, "config_file_name": None, "data": json.dumps(
            {"result": {"tests": {"results": [
                {"desc": "d1", "section": "1", "results": [
                    {"test_number": "1.1", "test_desc": "a", "status": "PASS"},
                    {"test_number": "1.2", "test_desc": "b", "status": "PASS"},
                    {"test_number": "1.3", "test_desc": "c", "status": "FAIL"}]}]}}})},
        {"lastupdate": 990000180, "host_id": "h9", "test_type": "cis", "config_file_name": None, "data": json.dumps(
            {"result": {"tests": {"results": [
                {"desc": "d1", "section": "1", "results": [{"test_number": "1.1", "test_desc": "a", "status": "PASS"}]}]}}})},
    ],
}


def edge_frames(spark: SparkSession, like: Tables) -> dict[str, DataFrame]:
    """DataFrames for ROWS, typed like the tables in ``like``."""
    frames = {}
    for name, rows in ROWS.items():
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in like[name].schema.fields])
        cols = [f.name for f in schema.fields]
        frames[name] = spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schema)
    return frames
