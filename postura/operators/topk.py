"""Top-k rows per key (``DISTINCT ON``, ``row_number() ... = 1``, ``LIMIT 1 OFFSET 1``).

Written as ``row_number() <= k`` so Catalyst inserts a partial WindowGroupLimit before the
shuffle: every map task keeps at most k rows per key, so a key holding a third of the table
ships k rows per task instead of the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[Column],
    k: int = 1,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first ``k`` rows of each key under ``order`` (which must be a total order
    for deterministic output). ``rank_col`` keeps the 1-based rank as a column."""
    name = rank_col or "__rank"
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``."""
    return top_per_key(df, keys, order, k=1)
