"""Join on ``r.key = l.k1 OR r.key = l.k2 OR ...`` without a nested-loop join.

A literal OR condition has no equi-join key, so Spark would plan a BroadcastNestedLoopJoin
(every left row against every right row). Instead the join goes by keys first: the distinct non-null keys
of the left rows, as narrow (row id, key) rows, are equi-joined to the right side, and the wide left rows
are joined once to what was found, by their id. A right row equals at most one distinct key of
a left row, so it matches that row exactly once, as under the OR.

The set of keys is known before the right side is read, so a right side that is itself built from
a large fact can be restricted to it: pass a function of the keys.

The left rows are needed twice, for their keys and for their columns. They are shuffled by id once, packed
so that both uses read the same columns, and the second use is that shuffle again (ReusedExchange).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.operators.packing import pack, unpack


def row_keys(left: DataFrame, row_id: str, keys: Sequence[Column]) -> DataFrame:
    """(row id, ``key``): one row for each distinct non-null key of a row, as text."""
    found = F.array_distinct(F.array_compact(F.array(*[k.cast("string") for k in keys])))
    # an inner explode would put a filter on the keys below a shuffle that the row's other uses share
    return left.select(row_id, F.explode_outer(found).alias("key")).where(F.col("key").isNotNull())


def any_key_join(
    left: DataFrame,
    row_id: str,
    keys: Sequence[Column],
    right: DataFrame | Callable[[DataFrame], DataFrame],
    right_key: str,
) -> DataFrame:
    """``left LEFT JOIN right ON right.right_key IN (keys...)``; keys are compared as text.

    ``row_id`` names a non-null column that tells the left rows apart. ``right`` may be a function that takes
    the distinct keys (one column, ``key``) and returns at least the right rows that have one of them.
    Output: all left columns plus the right columns other than ``right_key``, partitioned by the row id.
    """
    packed = pack(left, [row_id], row_id).repartition(row_id)
    keyed = row_keys(unpack(packed, left.columns), row_id, keys)
    rows = right(keyed.select("key").distinct()) if callable(right) else right
    rows = rows.select(F.col(right_key).alias("__rk"), *[c for c in rows.columns if c != right_key])
    found = keyed.join(rows, F.col("key") == F.col("__rk")).drop("key", "__rk").withColumnRenamed(row_id, "__id")
    wide = unpack(packed, left.columns)
    return wide.join(found, wide[row_id] == found["__id"], "left").drop("__id")
