"""Batch collection: run the report catalogue and publish one CSV file per report.

    python -m postura.runner --parquet-root s3a://bucket/snapshot --out s3a://bucket/posture-2026-12-03
    python -m postura.runner --jdbc-url jdbc:postgresql://db:5432/operations \
        --audit-jdbc-url jdbc:postgresql://audit:5432/audit --audit-user reader --audit-password-env AUDIT_PASSWORD \
        --slices 400 --slice audit:id:800 --out /data/out
    python -m postura.runner --jdbc-url jdbc:postgresql://db:5432/operations --snapshot posture_2026_12 --buckets 4000

Operational reports run first, then the audit reports, as in the source tool. Spark schedules
the work of each report across the cluster; ``--concurrency`` reports are submitted at a time
from driver threads (independent Spark jobs share the executors, so small reports do not leave
a large cluster idle). A failing report is recorded and the remaining reports still run. The database
passwords are read from environment variables (``--password-env``, ``--audit-password-env``), never from the command line.

Over JDBC the fact tables are read in parallel: ``--slices N`` slices each, at cuts that the database gives,
``--slice TABLE:COLUMN:SLICES`` for one table, or ``--partition TABLE:COLUMN:LOWER:UPPER:SLICES`` for equal ranges between
bounds given by hand. The other tables are read by one task each.

Publishing: each report is written aside, in a folder of the run under the output folder, and takes its published name
when it is whole; ``_manifest.json`` with the row count of each report is written last and makes the run complete. A report that
fails leaves nothing under its name, and one published by an earlier run is removed with the old manifest.

``--severity-function NAME`` rates vulnerabilities by a SQL function of the session's catalogue, called with the columns
that ``--severity-arguments`` names; the optimiser inlines a SQL function into the plan.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from postura.functions.vulns import SeverityFn, catalog_severity, default_severity
from postura.session import apply_cluster_defaults
from postura.plans.catalog import AUDIT_REPORTS, DISABLED_REPORTS, REPORTS, build_report
from postura.plans.shared import shared_blocks
from postura.sources.csv_sink import report_path, write_csv, write_csv_file
from postura.sources.files import Files
from postura.sources.slicing import Slicing, fact_slicing
from postura.sources.snapshot import read_snapshot, write_snapshot
from postura.sources.tables import JdbcSource, Partitioning, Tables


def collection_order(include_disabled: bool = False) -> list[str]:
    """Operational reports first, then the audit reports; the disabled report only on request."""
    keys = [k for k in REPORTS if include_disabled or k not in DISABLED_REPORTS]
    return [k for k in keys if k not in AUDIT_REPORTS] + [k for k in keys if k in AUDIT_REPORTS]


MANIFEST = "_manifest.json"


def collect(
    spark: SparkSession,
    tables: Tables,
    out_dir: str,
    as_of: str,
    keys: Iterable[str] | None = None,
    severity_fn: SeverityFn = default_severity,
    concurrency: int = 1,
    single_file: bool = True,
) -> list[dict]:
    """Publish every report as ``<out_dir>/<key>_results.csv`` (or as a folder of parts, ``<key>_results``) and the manifest of the
    run; per report, in the order of ``keys``, where it was written, its rows and how long that took, or the whole text of what
    stopped it. Blocks that several of the reports use are written once and dropped at the end."""
    out_dir = out_dir.rstrip("/")
    keys = list(keys or collection_order())
    run = uuid.uuid4().hex
    aside = f"{out_dir}/_run-{run}"
    files = Files(spark, out_dir)
    files.delete(f"{out_dir}/{MANIFEST}")

    def one(key: str, tables: Tables) -> dict:
        began, path, draft = time.monotonic(), report_path(out_dir, key, single_file), report_path(aside, key, single_file)
        files.delete(path)
        try:
            report = build_report(key, tables, spark, as_of=as_of, severity_fn=severity_fn)
            if single_file:
                rows = write_csv_file(report, draft)
            else:
                seen = Observation()
                write_csv(report.observe(seen, F.count(F.lit(1)).alias("rows")), draft)
                rows = seen.get["rows"]
            files.replace(draft, path)
        except Exception as exc:  # noqa: BLE001 - one failing report must not stop the collection
            return {"report": key, "written": None, "reason": str(exc)}
        return {"report": key, "written": path, "rows": rows, "seconds": round(time.monotonic() - began, 3)}

    def every(tables: Tables) -> list[dict]:
        if concurrency <= 1:
            return [one(k, tables) for k in keys]
        for name in tables.names():  # create the shared (lazy) table DataFrames before the threads use them
            try:
                tables[name]
            except Exception:  # noqa: BLE001 - a report reading this table records the error
                pass
        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            return list(pool.map(lambda k: one(k, tables), keys))

    try:
        records = _with_blocks(spark, tables, keys, every)
    finally:
        files.delete(aside)
    manifest = {"run": run, "as_of": as_of, "complete": all(r["written"] for r in records), "reports": records}
    files.write(f"{out_dir}/{MANIFEST}", json.dumps(manifest, indent=2).encode())
    return records


def _with_blocks(spark: SparkSession, tables: Tables, keys: list[str], every: Callable[[Tables], list[dict]]) -> list[dict]:
    """``every`` over the tables with the run's shared blocks; where a block cannot be made, over the tables alone, so
    that each report records its own failure."""
    with ExitStack() as stack:
        try:
            tables = stack.enter_context(shared_blocks(spark, tables, keys))
        except Exception as exc:  # noqa: BLE001
            print(f"shared blocks not written: {exc}", file=sys.stderr)
        return every(tables)


def _tables(spark: SparkSession, args: argparse.Namespace) -> Tables:
    if args.parquet_root:
        return Tables.from_parquet(spark, args.parquet_root, fmt=args.format)
    if args.database:
        return read_snapshot(spark, args.database)
    return Tables.from_jdbc(spark, *jdbc_sources(args))


def jdbc_sources(args: argparse.Namespace) -> tuple[JdbcSource, JdbcSource]:
    """The operational and the audit source; each setting of the audit source falls back to the operational one."""
    ranges = dict(map(partition, args.partition or []))
    slices = fact_slicing(args.slices, dict(map(one_slicing, args.slice or []))) if args.slices else dict(map(one_slicing, args.slice or []))
    password = os.environ.get(args.password_env) if args.password_env else None
    audit_password = os.environ.get(args.audit_password_env) if args.audit_password_env else None
    operational = JdbcSource(url=args.jdbc_url, user=args.user, password=password, partitioning=ranges, slicing=slices)
    audit = JdbcSource(
        url=args.audit_jdbc_url or args.jdbc_url,
        user=args.audit_user or args.user,
        password=password if audit_password is None else audit_password,
        partitioning=ranges,
        slicing=slices,
    )
    return operational, audit


def partition(text: str) -> tuple[str, Partitioning]:
    """``TABLE:COLUMN:LOWER:UPPER:SLICES``."""
    table, column, lower, upper, slices = text.split(":")
    return table, Partitioning(column, int(lower), int(upper), int(slices))


def one_slicing(text: str) -> tuple[str, Slicing]:
    """``TABLE:COLUMN:SLICES``, with ``:even`` behind it for equal ranges."""
    table, column, slices, *even = text.split(":")
    if even not in ([], ["even"]):
        raise ValueError(f"{text!r} is not TABLE:COLUMN:SLICES[:even]")
    return table, Slicing(column, int(slices), even=bool(even))


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Security-posture report collection on Spark")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet-root", help="directory with one table per sub-directory")
    src.add_argument("--jdbc-url", help="operational database JDBC URL")
    src.add_argument("--database", help="catalog database with a snapshot")
    p.add_argument("--format", default="parquet", help="table format under --parquet-root")
    p.add_argument("--audit-jdbc-url", help="audit database JDBC URL (defaults to the operational one)")
    p.add_argument("--audit-user", help="audit database user (defaults to --user)")
    p.add_argument("--audit-password-env", help="environment variable with the audit password (defaults to the operational one)")
    p.add_argument("--partition", action="append", metavar="TABLE:COLUMN:LOWER:UPPER:SLICES", help="parallel JDBC read of a table; repeatable")
    p.add_argument("--slices", type=int, default=64, help="slices of each fact table over JDBC (0: none but those given)")
    p.add_argument("--slice", action="append", metavar="TABLE:COLUMN:SLICES[:even]", help="slices of one table over JDBC; repeatable")
    p.add_argument("--user", default="postgres")
    p.add_argument("--password-env", default="POSTURA_DB_PASSWORD")
    out = p.add_mutually_exclusive_group(required=True)
    out.add_argument("--out", help="output directory (any Spark-supported path)")
    out.add_argument("--snapshot", metavar="DATABASE", help="write the tables as a snapshot instead of running reports")
    p.add_argument("--buckets", type=int, default=200, help="buckets of a snapshot's tables")
    p.add_argument("--parts", action="store_true", help="leave each report a folder of part files, each with a header")
    p.add_argument("--severity-function", help="SQL function of the catalogue that rates a vulnerability")
    p.add_argument("--severity-arguments", nargs="+", default=["vendor_severity", "nvd_cvss3_severity"], help="columns it is called with")
    p.add_argument("--as-of", default=None, help="report instant 'YYYY-MM-DD HH:MM:SS' (default: now, UTC)")
    p.add_argument("--include-disabled", action="store_true")
    p.add_argument("--only", nargs="*", help="report keys to run")
    p.add_argument("--concurrency", type=int, default=4, help="reports submitted at a time")
    return p.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Command-line entry point; returns 0 when every report succeeded."""
    args = arguments(argv)

    spark = SparkSession.builder.appName("postura-collect").config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    apply_cluster_defaults(spark)
    as_of = args.as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    keys = args.only or collection_order(args.include_disabled)
    tables = _tables(spark, args)
    missing = tables.missing_columns()
    if missing:
        print(json.dumps({"missing_columns": missing}, indent=2), file=sys.stderr)
    if args.snapshot:
        write_snapshot(tables, spark, args.snapshot, args.buckets)
        return 0
    severity = catalog_severity(args.severity_function, args.severity_arguments) if args.severity_function else default_severity
    records = collect(spark, tables, args.out, as_of, keys, severity, args.concurrency, not args.parts)
    print(json.dumps({"as_of": as_of, "reports": records}, indent=2))
    return 0 if all(r["written"] for r in records) else 1


if __name__ == "__main__":
    sys.exit(main())
