"""Blocks that several reports of one run need, written once for the run.

Each block is a table of a database that only the run knows, bucketed by the key its reports join it on, and
dropped with the database at the end. The reports find it in their ``Tables`` under the block's name and
use it in place of making it; a report on its own makes it as part of its plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from postura.plans.blocks import FAILURES, VULN_SUMMARY, assurance_failures, latest_image_vuln_summary
from postura.sources.tables import Tables

# block -> (how it is made, key, the reports that use it)
BLOCKS: dict[str, tuple[Callable[[Tables], DataFrame], str, frozenset[str]]] = {
    FAILURES: (assurance_failures, "scan_id", frozenset({"container_assurance_summary", "containers_running_with_findings_list"})),
    VULN_SUMMARY: (latest_image_vuln_summary, "docker_id", frozenset({"container_vuln_list", "container_ns_vuln_summary"})),
}


@contextmanager
def shared_blocks(spark: SparkSession, tables: Tables, keys: Iterable[str], buckets: int | None = None) -> Iterator[Tables]:
    """``tables`` with the blocks that at least two reports of ``keys`` use; they are written now and dropped on leaving."""
    keys = set(keys)
    wanted = [name for name, (_, _, users) in BLOCKS.items() if len(users & keys) > 1]
    if not wanted:
        yield tables
        return
    database = f"posture_run_{uuid.uuid4().hex[:12]}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE DATABASE {database}")
    try:
        for name in wanted:
            make, key, _ = BLOCKS[name]
            block = make(tables).repartition(buckets, key).write.format("parquet")
            block.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}")
        yield tables.having({name: lambda n=name: spark.table(f"{database}.{n}") for name in wanted})
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
