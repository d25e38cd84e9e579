"""Unpivot a few columns of one row into labelled rows (``VALUES`` / ``UNION ALL`` of scalars)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_rows(
    df: DataFrame,
    pairs: Sequence[tuple[str, Column]],
    names: tuple[str, str],
    keep: Sequence[str | Column] = (),
) -> DataFrame:
    """For every input row emit one row per ``(label, value)`` pair via ``stack``.
    All values must share one type."""
    args: list[Column] = [F.lit(len(pairs))]
    for label, value in pairs:
        args += [F.lit(label), value]
    return df.select(*keep, F.stack(*args).alias(*names))
