"""Helpers for the operators on embeddings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Values a long holds, as double: scaled entries beyond are no long.
LONG_RANGE = float(1 << 63)


def scaled(table: DataFrame, id_col: str, vec_col: str, factor: int = 256) -> DataFrame:
    """(_id, _x): floor(factor * c) of every entry c, taken as double, as long.

    Rows whose vector is null or holds a null, a non-finite entry or one whose
    scaled value is beyond a long are left out.
    """
    inside = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * factor) < LONG_RANGE))
    rows = table.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v"))
    return rows.where(F.col("_v").isNotNull() & inside).select(
        "_id", F.transform("_v", lambda c: F.floor(c * factor).cast("long")).alias("_x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as rows; shorter lists end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def stacked(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.Table]:
    """Arrow batches gathered to about ``rows`` rows each."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` of long matrices without rounding: as double while every sum
    stays below 2^53, as long below 2^62, else as Python integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    if most < 1 << 62:
        return a @ b
    return a.astype(object) @ b.astype(object)
