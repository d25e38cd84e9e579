"""Month spine: twelve instants, one a month, that end at the report instant.

The series steps cumulatively, each instant one month after the previous one with the day
clamped to the month's length, as the source database does (from 31 Mar: 30 Apr, 30 May,
..., 28 Feb, 28 Mar). The twelve instants are constants of the report instant, so they are
computed once on the driver and the spine is a 12-row relation built from literals: its size
is known before the job runs, and it is the only side these reports broadcast unconditionally.
"""

from __future__ import annotations

import calendar
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postura.functions.timefn import month_key, month_label


def _parse(as_of: _dt.datetime | str) -> _dt.datetime:
    return as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))


def add_months(ts: _dt.datetime, months: int) -> _dt.datetime:
    """Calendar month arithmetic with the day clamped to the target month's length."""
    index = ts.year * 12 + ts.month - 1 + months
    year, month = divmod(index, 12)
    day = min(ts.day, calendar.monthrange(year, month + 1)[1])
    return ts.replace(year=year, month=month + 1, day=day)


def month_instants(as_of: _dt.datetime | str, months: int = 12) -> list[_dt.datetime]:
    """The series values: start ``months - 1`` months before ``as_of``, step one month at a
    time from the previous value, stop at ``as_of``."""
    now = _parse(as_of)
    out = [add_months(now, -(months - 1))]
    while True:
        nxt = add_months(out[-1], 1)
        if nxt > now:
            return out
        out.append(nxt)


def month_spine(spark: SparkSession, as_of: _dt.datetime | str, months: int = 12) -> DataFrame:
    """Columns: ``idx`` (1 = oldest), ``datemonth`` (TIMESTAMP_NTZ), ``month`` ('Mon yy'),
    ``mkey`` ('MMyy'), ``ym`` (year * 12 + month - 1)."""
    instants = [
        F.struct(F.lit(i + 1).alias("idx"), F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz").alias("datemonth"))
        for i, ts in enumerate(month_instants(as_of, months))
    ]
    spine = spark.range(1).select(F.inline(F.array(*instants)))
    return F.broadcast(
        spine.select(
            "idx",
            "datemonth",
            month_label("datemonth").alias("month"),
            month_key("datemonth").alias("mkey"),
            (F.year("datemonth") * 12 + F.month("datemonth") - 1).alias("ym"),
        )
    )
