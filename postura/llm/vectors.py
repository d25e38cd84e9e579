"""Vector columns: which vectors take part, and their matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.llm.common import reach_workers


def finite_vectors(vectors: DataFrame, element: str) -> DataFrame:
    """(vec_id long, vector array<element>) of the rows whose vector is not null and holds no null or non-finite component."""
    reach_workers(vectors.sparkSession)
    v = F.col("embedding").cast(f"array<{element}>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("vector"), bad.alias("_bad")).filter("vec_id is not null and vector is not null and not _bad").drop("_bad")


def asked(vec_id: Column, every: int) -> Column:
    return vec_id % every == 0


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as doubles; shorter ones are padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    wide = int(lengths.max(initial=0))
    if len(lengths) and (lengths == wide).all():
        return values.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide))
    out[np.arange(wide) < lengths[:, None]] = values
    return out


def align(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both padded with zeros to the wider one's width."""
    wide = max(a.shape[1], b.shape[1])
    pad = lambda m: m if m.shape[1] == wide else np.pad(m, ((0, 0), (0, wide - m.shape[1])))
    return pad(a), pad(b)
