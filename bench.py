"""Benchmark: every report key over the driver tables at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each report is forced with a ``noop`` write (full execution, no driver collect). One warm-up
pass runs first; the timed value per key is the median of $BENCH_REPEAT runs (default 3), and all
runs are printed beside it. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from postura import REPORTS, build_report  # noqa: E402
from postura.session import local_session  # noqa: E402
from testsupport.driver_fixture import AS_OF, posture_from_driver  # noqa: E402


def _sf(path: str) -> float | str:
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else path


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or list(REPORTS)

    spark = local_session(cpus, shuffle_partitions=cpus * 2, app="postura-bench")
    tables = posture_from_driver(spark, sf_dir)

    def run(key: str) -> float:
        t0 = time.perf_counter()
        build_report(key, tables, spark, as_of=AS_OF).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for key in keys:  # warm-up: JIT, file listing, Python workers
        run(key)
    runs = {key: [round(run(key), 3) for _ in range(repeat)] for key in keys}
    times = {key: statistics.median(r) for key, r in runs.items()}
    print(
        json.dumps(
            {
                "metric": "total_report_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "runs": runs,
                "sf": _sf(sf_dir),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
