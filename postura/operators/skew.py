"""Keep a join splittable when one key may hold a third of the rows.

AQE splits a skewed sort-merge-join partition only when both join inputs are read straight
from a join-required shuffle. A side that an earlier window, aggregate or join already
partitioned on the join key is joined in place (Spark also drops an explicit
``repartition(key)`` there as redundant), so a hot key on the other side would land whole in
one task. A key-less rebalance of that side (typically one row per key, so cheap) makes
Spark shuffle it by the join key right under the join; AQE can then split the hot
partition of the large side and replicate the matching small-side partition, and still
coalesce or broadcast the small side when it turns out small at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def splittable_side(df: DataFrame) -> DataFrame:
    """``df`` rebalanced without keys, so the join above it shuffles it by the join key."""
    return df.hint("rebalance")
