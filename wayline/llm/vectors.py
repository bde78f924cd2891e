"""What the searches over vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, embedding) of the rows whose vector has components, all of them finite; not all zero unless `zero`."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where((F.size("embedding") > 0) & ~F.exists("embedding", bad))
    return rows if zero else rows.where(F.exists("embedding", lambda x: x != 0))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A matrix of a list column; shorter vectors end in zeros, which change no inner product."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    at = 0
    for i, n in enumerate(lengths):
        out[i, :n] = flat[at : at + n]
        at += n
    return out


def stacked(series, width: int) -> np.ndarray:
    """A matrix of a pandas column of lists, as matrix()."""
    out = np.zeros((len(series), width))
    for i, x in enumerate(series):
        out[i, : len(x)] = x
    return out


def is_query(every: int) -> Column:
    return F.pmod(F.col("vec_id"), F.lit(every)) == 0
