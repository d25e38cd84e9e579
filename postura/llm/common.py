"""Helpers that several operators share: column picking, lineage cuts and Arrow batches."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package also where the driver was started in another folder. On a cluster the
    package is installed or sent with --py-files; a path that a worker does not have does no harm."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, read through Spark so that any file system works."""
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) only, so that no other column of the input can clash; null text stays null."""
    reach_workers(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where none is set, a local session (as in tests) gets a folder
    of its own; on a cluster that would be a folder of one machine, so it is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written to the shared folder and read from there: later steps start from
    files every executor can read, so a lost executor costs one task and nothing is computed twice."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(rows: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """``rows`` with their place (from 0) under ``order``, which must tell all rows apart or leave only equal ones together.

    Ranges of the order go to partitions, their sizes give each range's first place, and a row adds its place in its
    range. Only the sizes, one row a partition, meet in one task.
    """
    ranged = cut(rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_first"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    placed = ranged.withColumn("_own", own).join(F.broadcast(first), "_part")
    return placed.withColumn(name, F.col("_first") + F.col("_own") - 1).drop("_part", "_own", "_first")


def join_small(rows: DataFrame, small: DataFrame, on: list[str], most: int = 100_000) -> DataFrame:
    """``rows`` joined with ``small``, which is broadcast if it is counted to have at most ``most`` rows."""
    return rows.join(F.broadcast(small) if small.limit(most + 1).count() <= most else small, on)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function that ``make`` builds once in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            if batch.num_rows:
                yield each(batch)

    return df.mapInArrow(run, schema)


def int_lists(buffers: list[bytes], width: int = 4) -> pa.ListArray:
    """A list<int32> column whose row i holds the little-endian integers of ``buffers[i]``."""
    offsets, at = [0], 0
    for b in buffers:
        at += len(b) // width
        offsets.append(at)
    values = pa.Array.from_buffers(pa.int32(), at, [None, pa.py_buffer(b"".join(buffers))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(schema))
