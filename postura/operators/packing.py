"""Rows packed into one column, so that several uses of one relation share its shuffle.

Spark computes equal shuffles once (ReusedExchange), but it moves column pruning and filters of each use below the
shuffle, which makes them differ. A row packed into a one-element array is read whole or not at all, and neither
``element_at`` nor a key that cannot be null gives the optimiser anything to move. Worth it where the
relation is costly to make and the fields that a use does not need are few. Filters on fields belong before
``pack`` or above an aggregate, window or join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACKED = "__row"


def pack(df: DataFrame, ids: Sequence[str], *beside: str) -> DataFrame:
    """The rows of ``df`` in which no column of ``ids`` is null, each packed into one column; the columns named in
    ``beside``, which every use must read, also stand beside it, as keys to partition by."""
    for name in ids:
        df = df.where(F.col(name).isNotNull())
    return df.select(*beside, F.array(F.struct(*df.columns)).alias(PACKED))


def unpack(packed: DataFrame, names: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Fields of packed rows, or columns beside them; fields that ``pack`` was given as ``ids`` come out as never null,
    so that a join on them adds no filter below."""
    fields = packed.schema[PACKED].dataType.elementType

    def field(name: str) -> Column:
        if name in packed.columns:
            return F.col(name)
        value = F.element_at(PACKED, 1)[name]
        return F.coalesce(value, F.lit("0").cast(fields[name].dataType)) if name in ids else value

    return packed.select(*[field(n).alias(n) for n in names])
