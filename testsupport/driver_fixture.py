"""Posture tables derived from the driver's TPC-H-like Parquet tables.

Each mapping is SQL text that Spark SQL and DuckDB both run unchanged, so the Spark reports
and the DuckDB oracles read exactly the same rows. ``{name}`` marks a driver table; literal
JSON braces are doubled. Every posture row is derived from whole driver tables, so report work
grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postura.sources.tables import Tables, wall_clock

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed mapping (shared with the DuckDB oracles); the report instant that goes with it is
# AS_OF below. Every table covers all rows of its driver table, and the keys that tables share
# (hosts, images, repositories) grow with them. No row is dropped: rows that must point nowhere
# have a key that no other table has (a twentieth of the image metadata and of the hosts, and
# assurance policy 7).
MAPPINGS: dict[str, str] = {
    "registry_repositories": """
SELECT s_suppkey AS id, s_name AS name, 'reg-' || CAST(s_nationkey % 4 AS STRING) AS registry_id FROM {supplier}""",
    "registry_images": """
SELECT p_partkey AS id, p_name || ':' || CAST(p_partkey AS STRING) AS name, CAST(1 + floor(p_partkey / 20) AS BIGINT) AS repository_id,
       'reg-' || CAST(p_size % 4 AS STRING) AS registry_id,
       CAST(DATE '1999-09-01' + CAST(p_partkey * 7 % 680 AS INT) AS TIMESTAMP) AS created
FROM {part}""",
    "image_metadata": """
SELECT CASE WHEN p_partkey % 20 = 0 THEN -p_partkey ELSE p_partkey END AS image_id,
       'sha256:' || CAST(p_partkey AS STRING) AS docker_id
FROM {part}""",
    "scans": """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN 'host' ELSE 'image' END AS type,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS image_id,
       CASE WHEN o_orderkey % 3 = 0 THEN 'h' || CAST(o_custkey AS STRING) END AS host_id,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_orderdate END AS scan_date,
       CAST(CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS INT) AS malware,
       CAST(o_orderkey % 3 AS INT) AS sensitive, CAST(o_orderkey % 4 AS INT) AS crit_vulns,
       CAST(o_orderkey % 7 AS INT) AS high_vulns, CAST(o_orderkey % 11 AS INT) AS med_vulns,
       CAST(o_orderkey % 13 AS INT) AS low_vulns,
       CAST(CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderkey % 5 END AS INT) AS neg_vulns
FROM {orders}""",
    "scan_history": """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'h' || CAST(o_custkey AS STRING) END AS host_id,
       o_orderdate AS date, CASE o_orderstatus WHEN 'F' THEN 'failed' ELSE 'finished' END AS status,
       CAST(o_orderkey % 2 AS INT) AS malware, CAST(o_orderkey % 3 AS INT) AS sensitive,
       CAST(o_orderkey % 4 AS INT) AS crit_vulns
FROM {orders}""",
    "scan_assurance_results": """
SELECT l_orderkey AS scan_id, l_linenumber AS policy_id, l_returnflag || l_linestatus AS control,
       CASE WHEN l_discount > 0.055 THEN true WHEN l_discount > 0.045 THEN NULL ELSE false END AS failed
FROM {lineitem}""",
    "image_assurance": """
SELECT DISTINCT CASE WHEN l_linenumber < 7 THEN l_linenumber ELSE 1000 + l_linenumber END AS id,
       'policy-' || CAST(l_linenumber AS STRING) AS name
FROM {lineitem}""",
    "scan_resources": """
SELECT DISTINCT l_orderkey AS scan_id, l_partkey AS resource_id FROM {lineitem}""",
    "known_resources": """
SELECT p_partkey AS id, p_type AS type, p_brand AS format, p_name AS name, '1.' || CAST(p_size AS STRING) AS version FROM {part}""",
    "known_resource_vulnerabilities": """
SELECT p_partkey AS id, p_partkey AS resource_id, 'VULN-' || CAST(p_partkey % 400 AS STRING) AS name,
       CASE WHEN p_partkey % 6 = 0 THEN 'license' ELSE 'vulnerability' END AS issue_type,
       CAST(p_partkey % 3 AS DOUBLE) AS vendor_cvss3_score, CAST(p_partkey % 4 AS DOUBLE) AS nvd_cvss3_score,
       CAST(p_partkey % 5 AS DOUBLE) AS vendor_cvss2_score,
       CAST(CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_partkey % 10 END AS DOUBLE) AS nvd_cvss2_score,
       CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'high' ELSE 'low' END AS vendor_severity,
       CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'critical' ELSE 'medium' END AS nvd_cvss3_severity,
       CASE WHEN p_partkey % 8 = 0 THEN 'unknown' ELSE '2000-0' || CAST(1 + p_partkey % 9 AS STRING) || '-15' END AS publish_date,
       CASE WHEN p_partkey % 8 = 1 THEN NULL ELSE '2000-1' || CAST(p_partkey % 3 AS STRING) || '-01' END AS created,
       CASE WHEN p_partkey % 2 = 0 THEN '2.0' END AS fix_version
FROM {part}""",
    "hosts": """
SELECT CASE WHEN c_custkey % 20 = 7 THEN 'gone' ELSE 'h' END || CAST(c_custkey AS STRING) AS id,
       'node' || CAST(c_custkey AS STRING) || '.r' || CAST(c_nationkey AS STRING) || '.example' AS logicalname,
       CASE WHEN c_custkey % 5 = 0 THEN 'vm' ELSE 'agent' END AS type,
       CASE WHEN c_custkey % 7 = 0 THEN 'disconnect' ELSE 'connect' END AS status
FROM {customer}""",
    "agent_details": """
SELECT 'h' || CAST(c_custkey AS STRING) AS hostid,
       '{{"vm_vendor_name":"v' || CAST(c_custkey % 3 AS STRING) || '","vm_location":"r' || CAST(c_nationkey % 4 AS STRING) || '"'
       || CASE c_custkey % 9 WHEN 0 THEN '' WHEN 1 THEN ',"vm_tags":null' WHEN 2 THEN ',"vm_tags":[]'
          ELSE ',"vm_tags":["env:prod","own:team:t' || CAST(c_custkey % 4 AS STRING) || '","plain","k:v,extra",7]' END
       || '}}' AS cloud_info
FROM {customer}""",
    "containers": """
SELECT 'c' || CAST(c_custkey AS STRING) AS id, c_name AS name,
       CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 'img-' || CAST(CAST(floor(c_custkey / 4) AS BIGINT) AS STRING) END AS image_name,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'sha256:' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) END AS oci_image_id,
       'h' || CAST(CAST(floor(c_custkey / 5) AS BIGINT) AS STRING) AS hostid,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END AS scan_id,
       'reg-' || CAST(c_nationkey % 4 AS STRING) AS registry_id, 'cluster-' || CAST(c_nationkey % 3 AS STRING) AS level1,
       c_mktsegment AS level2, 'ctl-' || CAST(c_custkey % 12 AS STRING) AS level3,
       CASE WHEN c_custkey % 2 = 0 THEN 'Deployment' ELSE 'DaemonSet' END AS level3_type,
       'pod-' || CAST(c_custkey AS STRING) AS level4,
       CASE WHEN c_custkey % 4 = 0 THEN 'exited' ELSE 'running' END AS status,
       c_custkey % 5 = 0 AS isroot, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey % 6 = 0 END AS isprivileged,
       c_custkey % 7 <> 0 AS isregistered, 990000000 + c_custkey * 3600 AS create_time,
       CAST(c_custkey % 3 AS INT) AS audit_block_events, CAST(c_custkey % 5 AS INT) AS audit_detect_events
FROM {customer}""",
    "license": """
SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'Active' ELSE 'Expired' END AS status,
       CASE WHEN n_nationkey % 5 = 0 THEN -1 ELSE n_nationkey * 10 END AS enforcers,
       n_nationkey * 4 AS repositories, CASE WHEN n_nationkey = 4 THEN -2 ELSE n_nationkey END AS micro_enforcers,
       n_nationkey AS vm_enforcers
FROM {nation}""",
    "runtime_policies": """
SELECT 'policy-' || CAST(s_suppkey AS STRING) AS name, 990000000 + s_suppkey * 60 AS lastupdate,
       'author-' || CAST(s_nationkey AS STRING) AS author,
       '{{"enabled":' || CASE WHEN s_suppkey % 4 = 0 THEN 'false' ELSE 'true' END
       || ',"enforce":' || CASE WHEN s_suppkey % 2 = 0 THEN 'false' ELSE 'true' END
       || ',"label":"x","exec_control":{{"enabled":true,"list":[1]}},"net_control":{{"enabled":'
       || CASE WHEN s_suppkey % 3 = 0 THEN 'true' ELSE 'false' END || '}},"file_control":{{}}}}' AS policy
FROM {supplier}""",
    "audit": """
SELECT event_id AS id,
       CASE event_id % 5 WHEN 0 THEN 'Runtime' WHEN 1 THEN 'host.runtime' WHEN 2 THEN 'Malware' WHEN 3 THEN 'Docker' ELSE 'Login' END AS type,
       CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS category,
       CASE event_id % 3 WHEN 0 THEN 'Scan' WHEN 1 THEN 'Exec' ELSE 'exec' END AS action,
       990000000 + event_id * 259 AS createtime,
       '{{"result":' || CAST(1 + event_id % 2 AS STRING)
       || CASE event_id % 4 WHEN 0 THEN ',"signature_name":"sig-' || CAST(user_id % 3 AS STRING) || '"'
          WHEN 1 THEN ',"control":"ctl-' || CAST(user_id % 3 AS STRING) || '"'
          WHEN 2 THEN ',"signature_name":null,"control":"both"' ELSE '' END
       || ',"malware":"m' || CAST(user_id % 7 AS STRING) || '","malware_type":"t","malware_scan_type":"image","resource":"/bin/x'
       || CAST(user_id AS STRING) || '","host":"h' || CAST(user_id % 50 AS STRING) || '","action":"alert"}}' AS data
FROM {events}""",
    "host_scan": """
SELECT 990000000 + c_custkey * 60 AS lastupdate, 'h' || CAST(c_custkey AS STRING) AS host_id,
       CASE WHEN c_custkey % 2 = 0 THEN 'cis' ELSE 'kube' END AS test_type,
       CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'kube.yaml' END AS config_file_name,
       CASE WHEN c_custkey % 2 = 0
         THEN '{{"result":{{"tests":{{"results":[{{"desc":"d1","section":"1","fail":1,"pass":1,"warn":0,"info":0,"results":[{{"test_number":"1.1","test_desc":"a","status":"'
              || CASE c_custkey % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'WARN' ELSE 'INFO' END
              || '"}},{{"test_number":"1.2","test_desc":"b","status":"' || 'PASS'
              || '"}}]}},{{"desc":"d2","section":"2","fail":0,"pass":1,"warn":0,"info":0,"results":[{{"test_number":"2.1","test_desc":"c","status":"'
              || 'PASS' || '"}}]}}]}}}}}}'
         ELSE '{{"result":{{"Controls":[{{"tests":[{{"desc":"d1","section":"1","fail":1,"pass":1,"warn":0,"info":0,"results":[{{"test_number":"1.1","test_desc":"a","status":"'
              || CASE c_custkey % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'WARN' ELSE 'INFO' END
              || '"}},{{"test_number":"1.2","test_desc":"b","status":"' || 'PASS'
              || '"}}]}},{{"desc":"d2","section":"2","fail":0,"pass":1,"warn":0,"info":0,"results":[{{"test_number":"2.1","test_desc":"c","status":"'
              || 'PASS' || '"}}]}}]}}]}}}}'
       END AS data
FROM {customer}""",
}

# Report instant paired with the mapping: mid-month, so month stepping agrees in every engine.
AS_OF = "2001-07-15 12:00:00"


def _driver_name(template: str) -> str:
    for name in DRIVER_TABLES:
        if "{" + name + "}" in template:
            return name
    raise KeyError(template)


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def posture_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One posture table derived from a driver table by its mapping."""
    template = MAPPINGS[name]
    src = _driver_name(template)
    return wall_clock(spark.sql(template, **{src: driver_table(spark, sf_dir, src)}))


def posture_from_driver(spark: SparkSession, sf_dir: str) -> Tables:
    """Table registry over the posture tables of one driver directory."""
    return Tables({n: (lambda n=n: posture_table(spark, sf_dir, n)) for n in MAPPINGS})


def duckdb_cte(names: list[str] | tuple[str, ...]) -> str:
    """``WITH`` prefix defining the given posture tables over the driver views, for DuckDB."""
    parts = []
    for name in names:
        template = MAPPINGS[name]
        src = _driver_name(template)
        parts.append(f"{name} AS ({template.format(**{src: src}).strip()})")
    return "WITH " + ",\n".join(parts)
