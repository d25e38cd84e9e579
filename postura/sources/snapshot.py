"""Snapshots: the input tables laid out for the joins the reports make.

Tables that meet on one key are bucketed and sorted by it with one bucket count, so Spark joins them as they lie,
without shuffling either side: the scans with their assurance results and resources by scan id, the vulnerabilities
with their resources by resource id, the images with their metadata by image id. The other tables are plain.
A report that joins a table by another key shuffles it as before.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from postura.schemas import POSTURE_TABLES
from postura.sources.tables import Tables

LAYOUT: dict[str, str] = {
    "scans": "id",
    "scan_assurance_results": "scan_id",
    "scan_resources": "scan_id",
    "known_resources": "id",
    "known_resource_vulnerabilities": "resource_id",
    "registry_images": "id",
    "image_metadata": "image_id",
}


def write_snapshot(tables: Tables, spark: SparkSession, database: str, buckets: int, names: Iterable[str] = POSTURE_TABLES) -> None:
    """Write ``tables`` as catalog tables of ``database``. Choose ``buckets`` so that a bucket of the largest table is a
    task's worth (256 MB): rows go to their bucket before the write, so a bucket is one file. No key of the layout owns
    more rows than one scan or resource has. Tables of equal key must have keys of one type, else Spark shuffles them."""
    if buckets < 1:
        raise ValueError("buckets must be positive")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        df, key = tables[name], LAYOUT.get(name)
        if key is None:
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
        else:
            dealt = df.repartition(buckets, key).write.mode("overwrite").format("parquet")
            dealt.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}")


def read_snapshot(spark: SparkSession, database: str) -> Tables:
    return Tables.from_catalog(spark, database)
