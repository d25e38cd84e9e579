"""Source-level guarantees of the library: nothing is pulled to the driver, cached or
local-checkpointed, and no Python UDF sits in a report."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1] / "postura"
# the corpus operators may run Python inside tasks; their own tests hold them to their rules
LIB = sorted(p for p in ROOT.rglob("*.py") if (ROOT / "llm") not in p.parents)

# the cuts of a table's slices: one row that the database aggregates
ALLOWED = {("slicing.py", "return df.limit(1).collect()")}
FORBIDDEN = {
    "driver collect": r"\.(collect|toPandas|toLocalIterator|take|head|first)\(",
    "cache / persist": r"\.(cache|persist)\(",
    "local checkpoint": r"localCheckpoint",
    "python udf": r"\b(udf|pandas_udf|applyInPandas|mapInPandas|mapInArrow)\b",
    "rdd api": r"\.rdd\b",
}


@pytest.mark.parametrize("rule", sorted(FORBIDDEN))
def test_library_source_avoids(rule):
    pattern = re.compile(FORBIDDEN[rule])
    hits = [
        f"{p.name}:{i}: {line.strip()}"
        for p in LIB
        for i, line in enumerate(p.read_text().splitlines(), 1)
        if pattern.search(line) and not line.lstrip().startswith("#") and (p.name, line.split("#")[0].strip()) not in ALLOWED
    ]
    assert not hits, hits
