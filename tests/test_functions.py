"""Column helpers against hand-computed values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postura.functions import pct_label, round_ratio  # noqa: F811
from postura.functions import avg_int, epoch_to_ts, month_key, month_label, pct_label, vuln_score, vuln_severity


def _one(spark, col, schema="a long, b long", rows=((1, 2),)):
    return spark.createDataFrame(list(rows), schema).select(col.alias("v")).collect()


@pytest.mark.parametrize(
    "num,den,pattern,expected",
    [
        (1, 2, "990D00%", "  50.00%"),
        (1, 800, "990D00%", "   0.13%"),  # 0.125 rounds half up
        (0, 5, "990D00%", "   0.00%"),
        (5, 5, "990D00%", " 100.00%"),
        (1, 3, "990D00%", "  33.33%"),
        (2, 3, "990D00%", "  66.67%"),
        (1, 0, "990D00%", None),
        (None, 3, "990D00%", None),
        (3, None, "990D00%", None),
        (3, -1, "990D00%", "-300.00%"),
        (11, -2, "990D00%", "-550.00%"),
        (0, -1, "990D00%", "   0.00%"),
        (123, 10, "990D00%", "1230.00%"),  # wider than the pattern: printed whole
        (1, 2, "99D00%", " 50.00%"),
        (1, 400, "99D00%", "   .25%"),
        (0, 7, "99D00%", "   .00%"),
        (1, 1, "99D00%", "100.00%"),
        (1, 3, "fm990D00%", "33.33%"),
        (0, 3, "fm990D00%", "0.00%"),
    ],
)
def test_pct_label(spark, num, den, pattern, expected):
    (row,) = _one(spark, pct_label("a", "b", pattern), rows=[(num, den)])
    assert row.v == expected


@pytest.mark.parametrize(
    "total,count,expected",
    [(5, 2, 3), (-5, 2, -3), (7, 3, 2), (8, 3, 3), (0, 4, 0), (3, 0, None), (None, 0, None), (1, 2, 1), (-1, 2, -1)],
)
def test_avg_int_rounds_half_away_from_zero(spark, total, count, expected):
    (row,) = _one(spark, avg_int("a", "b"), rows=[(total, count)])
    assert row.v == expected


def test_vuln_score_ladder(spark):
    schema = (
        "vendor_cvss3_score double, nvd_cvss3_score double, vendor_cvss2_score double, nvd_cvss2_score double, "
        "vendor_severity string, nvd_cvss3_severity string"
    )
    rows = [
        (7.5, 9.0, 5.0, 4.0, "high", "critical"),  # vendor cvss3 wins
        (0.0, 9.0, 5.0, 4.0, "", "critical"),  # nvd cvss3 when vendor severity empty
        (0.0, 9.0, 5.0, 4.0, "high", "critical"),  # vendor severity set: skip nvd cvss3 -> vendor cvss2
        (0.0, 0.0, 0.0, 4.0, "", ""),  # nvd cvss2 when vendor severity empty
        (0.0, 0.0, 0.0, None, "", ""),  # ... even when NULL
        (0.0, 0.0, 0.0, 4.0, "low", ""),  # else 0
    ]
    df = spark.createDataFrame(rows, schema)
    got = [r.s for r in df.select(vuln_score().alias("s")).collect()]
    assert got == [7.5, 9.0, 5.0, 4.0, None, 0.0]
    sev = [r.s for r in df.select(vuln_severity().alias("s")).collect()]
    assert sev == ["high", "critical", "high", "unknown", "unknown", "low"]


def test_severity_function_is_pluggable(spark):
    df = spark.createDataFrame([("high", "")], "vendor_severity string, nvd_cvss3_severity string")
    got = df.select(vuln_severity("", lambda p: F.upper(F.col(p + "vendor_severity"))).alias("s")).first().s
    assert got == "HIGH"


def test_epoch_to_ts_is_utc_wall_clock(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        (row,) = _one(spark, epoch_to_ts(F.col("a")), rows=[(990000000, 0)])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.v == dt.datetime(2001, 5, 16, 8, 0, 0)


def test_month_formats(spark):
    df = spark.createDataFrame([("2001-07-15 12:00:00",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
    row = df.select(month_label("t").alias("l"), month_key("t").alias("k")).first()
    assert (row.l, row.k) == ("Jul 01", "0701")


def test_epoch_to_ts_keeps_fractions(spark):
    df = spark.createDataFrame([(990000000.25,), (-1.5,)], "e double")
    got = [r.t for r in df.select(epoch_to_ts("e").alias("t")).collect()]
    assert got == [dt.datetime(2001, 5, 16, 8, 0, 0, 250000), dt.datetime(1969, 12, 31, 23, 59, 58, 500000)]


def test_ratios_of_large_sums_do_not_overflow(spark):
    df = spark.sql("SELECT CAST(500000000000000 AS BIGINT) AS n, CAST(1000000000000000 AS BIGINT) AS d, CAST(9000000000000000000 AS BIGINT) AS big")
    row = df.select(pct_label("n", "d").alias("p"), round_ratio("n", "d", 100).alias("r"), pct_label("big", "big").alias("q")).first()
    assert (row.p.strip(), row.r, row.q.strip()) == ("50.00%", 50, "100.00%")
