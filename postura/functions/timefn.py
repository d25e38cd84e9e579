"""Time helpers. All timestamps are TIMESTAMP_NTZ wall-clock values in UTC, so no report
depends on the session time zone."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def as_of_literal(as_of: _dt.datetime | str) -> Column:
    """The report instant (``now()``/``current_timestamp``) as a TIMESTAMP_NTZ literal."""
    text = as_of if isinstance(as_of, str) else as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp_ntz")


def as_of_date(as_of: _dt.datetime | str) -> Column:
    """``current_date`` at the report instant."""
    return F.to_date(as_of_literal(as_of))


def epoch_to_ts(col: str | Column) -> Column:
    """``to_timestamp(epoch_seconds)`` as a UTC wall-clock TIMESTAMP_NTZ; fractional seconds
    are kept to the microsecond."""
    c = F.col(col) if isinstance(col, str) else col
    micros = F.round(c.cast("decimal(20,6)") * 1000000).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, F.lit(EPOCH).cast("timestamp_ntz"))


def month_label(col: str | Column) -> Column:
    """``to_char(ts, 'Mon yy')``."""
    return F.date_format(col, "MMM yy")


def month_key(col: str | Column) -> Column:
    """``to_char(ts, 'mmyy')``: two-digit month and two-digit year (years a century apart collide)."""
    return F.date_format(col, "MMyy")
