"""Summarise every report's physical plan as a Markdown table (writes PLANS.md).

    python tools/plan_summary.py [sf_dir] [out.md]

Each report runs once; counts come from its final plan: shuffles that ran, shuffles that were another's again,
join strategies, partial top-k limits, windows, Expand (distinct aggregates), nested loops, scans.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from postura import REPORTS, build_report  # noqa: E402
from testsupport.driver_fixture import AS_OF, posture_from_driver  # noqa: E402
from postura.session import local_session  # noqa: E402

COLUMNS = [
    ("shuffles", r"(?<!, )Exchange (hash|range|Round|Single)"),
    ("reused shuffles", r"ReusedExchange .*, Exchange (hash|range|Round|Single)"),
    ("broadcasts", r"(?<!, )BroadcastExchange"),
    ("sort-merge joins", r"SortMergeJoin"),
    ("broadcast hash joins", r"BroadcastHashJoin"),
    ("nested-loop joins", r"BroadcastNestedLoopJoin|CartesianProduct"),
    ("partial top-k limits", r"WindowGroupLimit .*Partial"),
    ("windows", r"\bWindow \["),
    ("Expand", r"\bExpand \["),
    ("scans", r"FileScan parquet"),
]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = Path(sys.argv[2] if len(sys.argv) > 2 else Path(__file__).resolve().parents[1] / "PLANS.md")
    spark = local_session(8, 16, app="postura-plans")
    tables = posture_from_driver(spark, sf_dir)
    rows = []
    for key in REPORTS:
        df = build_report(key, tables, spark, as_of=AS_OF)
        df.collect()  # a noop write would run another plan than the one this DataFrame shows
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        rows.append([key] + [str(len(re.findall(p, plan))) for _, p in COLUMNS])
    head = "| report | " + " | ".join(c for c, _ in COLUMNS) + " |"
    sep = "|---" * (len(COLUMNS) + 1) + "|"
    lines = [
        "# Physical plans",
        "",
        f"Generated by `tools/plan_summary.py` on the driver tables at `{sf_dir}` (Spark {spark.version},",
        "AQE on, default broadcast threshold). Counts are from the final plan of one run: a shuffle that equals another is",
        "computed once and counted under reused shuffles, and joins whose sides proved small are broadcast joins.",
        "Scans count parquet reads of the driver tables the posture tables are derived from.",
        "",
        head,
        sep,
        *["| " + " | ".join(r) + " |" for r in rows],
        "",
    ]
    out.write_text("\n".join(lines))
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
