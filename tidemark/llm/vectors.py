"""Vectors that can be compared by cosine, as table rows and as arrays."""

import math
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def comparable(table, vector="embedding"):
    """`vec_id`, `v` (array of doubles) and its `dim`, of one row per id.

    Rows without id, and vectors that are null, empty, zero or hold null or non-finite
    components, are left out. Of several rows with one id the smallest vector counts.
    """
    v = F.col(vector).cast("array<double>")
    one_each = (table.where(F.col("vec_id").isNotNull()).select("vec_id", v.alias("v"))
                .groupBy("vec_id").agg(F.min("v").alias("v")))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return one_each.where(sound & F.exists("v", lambda x: x != 0)).select(
        "vec_id", "v", F.size("v").alias("dim"))


def matrix(column, dim):
    """An Arrow list column of `dim` doubles a row as a matrix."""
    values = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def unit(rows):
    """Rows of length one; scaled first, so that huge and tiny values survive."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def packed(rows):
    """A matrix as bytes: single precision where that loses nothing."""
    with np.errstate(over="ignore"):
        single = rows.astype("<f4")
    exact = np.array_equal(single.astype("<f8"), rows)
    return (b"s" + single.tobytes()) if exact else (b"d" + rows.astype("<f8").tobytes())


def unpacked(raw, dim):
    kind = "<f4" if raw[:1] == b"s" else "<f8"
    return np.frombuffer(raw, kind, offset=1).astype(float).reshape(-1, dim)
