"""Several exact distinct counts beside sums, by counting in levels.

``count(DISTINCT a), count(DISTINCT b), ...`` in one aggregate makes Spark repeat each input row once for every
count (Expand). Here the rows are first reduced to the combinations of the counted columns, with the sums beside
them; only these combinations are unpivoted into (column, value) rows, which are made distinct and counted. Every
level is an aggregate with a map-side part, so a hot group costs partial rows and not its input rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, str], sums: Mapping[str, Column]) -> DataFrame:
    """One row per ``keys`` (null keys are a group): the exact distinct non-null count of each column of ``distinct``
    (output name -> column) and the sum of each expression of ``sums`` (output name -> integer expression)."""
    values = [f"__v{i}" for i in range(len(distinct))]
    rows = df.select(*keys, *[F.col(c).cast("string").alias(v) for c, v in zip(distinct.values(), values)], *[e.cast("bigint").alias(s) for s, e in sums.items()])
    combos = rows.groupBy(*keys, *values).agg(*[F.sum(s).alias(s) for s in sums], F.lit(1).alias("__one"))
    none = [F.lit(None).cast("bigint").alias(s) for s in sums]
    carrier = F.struct(F.lit(-1).alias("__which"), F.lit(None).cast("string").alias("__value"), *[F.col(s) for s in sums])
    counted = [F.struct(F.lit(i).alias("__which"), F.col(v).alias("__value"), *none) for i, v in enumerate(values)]
    unpivoted = combos.select(*keys, F.inline(F.array(carrier, *counted)))
    single = unpivoted.groupBy(*keys, "__which", "__value").agg(*[F.sum(s).alias(s) for s in sums], F.lit(1).alias("__one"))
    counts = [F.count(F.when(F.col("__which") == i, F.col("__value"))).alias(name) for i, name in enumerate(distinct)]
    return single.groupBy(*keys).agg(*counts, *[F.sum(s).alias(s) for s in sums])
