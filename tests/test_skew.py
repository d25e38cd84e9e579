"""A third of the rows on one key: results stay exact and AQE splits the hot join partitions.

One image runs a third of the containers and owns a third of the image scans; one resource
appears in half of the scans. Broadcasts are disabled and the skew thresholds
lowered so the small test data exercises the sort-merge joins a large deployment would use.
"""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from postura import Tables, build_report
from postura.schemas import POSTURE_TABLES
from testsupport.driver_fixture import AS_OF, posture_from_driver
from testsupport.compare import compare
from testsupport.oracles import oracle_sql_posture

SKEW_SF = "/root/testdata/sf0.01"

KEYS = [
    "container_assurance_summary",
    "container_ns_vuln_summary",
    "container_vuln_list",
    "containers_running_with_findings_list",
    "host_vulnerability_scan_details",
    "image_vuln_fix_age_summary",
    "image_repo_vuln_severity_distribution",
]

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # several map tasks feed each join, as at scale: a partition is split by the map tasks behind it
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    base = posture_from_driver(spark, SKEW_SF)
    frames = {n: base[n] for n in POSTURE_TABLES}
    c = frames["containers"]
    frames["containers"] = c.withColumn(
        "oci_image_id",
        F.when(F.abs(F.hash("id")) % 3 == 0, F.lit("sha256:7")).otherwise(F.col("oci_image_id")),
    )
    s = frames["scans"]
    frames["scans"] = s.withColumn(
        "image_id", F.when((F.col("type") == "image") & (F.col("id") % 9 < 3), F.lit(7)).otherwise(F.col("image_id"))
    )
    sr = frames["scan_resources"]
    frames["scan_resources"] = sr.withColumn(
        "resource_id", F.when(F.col("scan_id") % 2 == 0, F.lit(1)).otherwise(F.col("resource_id"))
    ).distinct()
    root = tmp_path_factory.mktemp("skew")
    for name, df in frames.items():
        # several files per table, as any large table has: AQE splits a hot partition by map task
        df.repartition(8).write.mode("overwrite").parquet(str(root / name))
    con = duckdb.connect()
    for name in POSTURE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{root / name}/*.parquet')")
    return Tables.from_parquet(spark, str(root)), con


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("key", KEYS)
def test_skewed_inputs_give_exact_results(spark, skewed, skew_conf, key):
    tables, con = skewed
    res = compare(build_report(key, tables, spark, as_of=AS_OF), con, oracle_sql_posture(key))
    assert res["ok"], res


@pytest.mark.parametrize(
    "key",
    [
        "containers_running_with_findings_list",
        "host_vulnerability_scan_details",
        "container_vuln_list",
        "image_vuln_fix_age_summary",
    ],
)
def test_hot_join_partitions_are_split(spark, skewed, skew_conf, key):
    tables, _ = skewed
    df = build_report(key, tables, spark, as_of=AS_OF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "skew=true" in final, final[:3000]
