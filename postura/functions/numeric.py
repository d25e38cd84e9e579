"""Exact integer formatting and rounding helpers.

PostgreSQL formats ratios with ``to_char(x, '990D00%')`` and casts averages with
``::int`` (round half away from zero). Doing that through doubles makes the last digit
depend on the engine, so both helpers work on integer operands only.

Reports aggregate plain sums and counts into named columns first and format them in the
projection after the aggregate: the aggregation buffers stay simple, and each label is one
SQL expression instead of a large tree of Column objects built over py4j.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDTH = {"990D00%": 8, "99D00%": 7, "fm990D00%": None}


def idiv(a: Column, b: Column) -> Column:
    """Integral division (``a div b``), truncating toward zero."""
    return F.call_function("div", a, b)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _round_ratio_sql(num: str, den: str, scale: int) -> str:
    # sums over a large table times 20000 would not fit a BIGINT; the quotient does
    n, d = f"CAST({num} AS DECIMAL(38,0))", f"CAST({den} AS DECIMAL(38,0))"
    return (
        f"(CASE WHEN {d} IS NULL OR {d} = 0 OR {n} IS NULL THEN CAST(NULL AS BIGINT) "
        f"ELSE (CASE WHEN ({n} < 0) <> ({d} < 0) THEN -1 ELSE 1 END) * "
        f"((abs({n}) * {2 * scale} + abs({d})) div (2 * abs({d}))) END)"
    )


def round_ratio(num: str, den: str, scale: int = 1) -> Column:
    """round(num * scale / den) half away from zero, as bigint; NULL when den is 0 or NULL.
    ``num`` and ``den`` are column names."""
    return F.expr(_round_ratio_sql(_q(num), _q(den), scale))


def avg_int(total: str, count: str) -> Column:
    """``avg(x)::int`` from the names of a sum column and a non-null-count column, exact."""
    return F.expr(f"CAST({_round_ratio_sql(_q(total), _q(count), 1)} AS INT)")


def pct_label(num: str, den: str, pattern: str = "990D00%") -> Column:
    """``to_char(num / den * 100, pattern)`` with exact half-up hundredths, from the names of
    the numerator and denominator columns.

    Patterns used by the reports: ``990D00%`` (width 8), ``99D00%`` (width 7, no leading zero
    below 1) and ``fm990D00%`` (no padding). A value wider than the pattern is printed whole.
    """
    if pattern not in _WIDTH:
        raise ValueError(f"unsupported pattern {pattern!r}")
    h = _round_ratio_sql(_q(num), _q(den), 10000)
    ip = f"(abs({h}) div 100)"
    int_txt = f"(CASE WHEN {ip} = 0 THEN '' ELSE CAST({ip} AS STRING) END)" if pattern == "99D00%" else f"CAST({ip} AS STRING)"
    label = (
        f"concat(CASE WHEN {h} < 0 THEN '-' ELSE '' END, {int_txt}, '.', "
        f"lpad(CAST(abs({h}) % 100 AS STRING), 2, '0'), '%')"
    )
    width = _WIDTH[pattern]
    if width is not None:
        label = f"(CASE WHEN length({label}) >= {width} THEN {label} ELSE lpad({label}, {width}, ' ') END)"
    return F.expr(f"CASE WHEN {h} IS NULL THEN CAST(NULL AS STRING) ELSE {label} END")
