"""Integer vectors: the rows of an embedding table as whole numbers, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sums of products below this bound are exact in float64, so a float matrix product gives whole numbers.
EXACT = 1 << 53


def usable(vec: Column) -> Column:
    """True for a vector that is not null and holds neither null nor a non-finite component."""
    fine = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vec.isNotNull() & fine, F.lit(False))


def floored(vec: Column, scale: int) -> Column:
    """Every component, as double, times ``scale``, rounded down to a long (saturated beyond a long)."""
    return F.transform(vec, lambda v: F.floor(v.cast("double") * F.lit(float(scale))))


def integer_rows(df: DataFrame, vec_col: str, scale: int, **keep: str) -> DataFrame:
    """The rows with a usable vector: the columns of ``keep`` (new name = old name), ``rid`` (one number a
    row) and ``ints``.  The caller saves the result, so that ``rid`` stays the same in later jobs."""
    vec = F.col(vec_col)
    return df.where(usable(vec)).select(*[F.col(old).alias(new) for new, old in keep.items()], F.monotonically_increasing_id().alias("rid"),
                                        floored(vec, scale).alias("ints"))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """A list column as an int64 matrix of ``width`` columns; shorter lists end in zeros."""
    at = lists.offsets.to_numpy()
    n = np.diff(at)
    flat = lists.values.to_numpy(zero_copy_only=False)[at[0]:at[-1]]
    if len(n) and (n == width).all():
        return flat.reshape(len(n), width)
    out = np.zeros((len(n), width), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(at[:-1] - at[0], n)] = flat
    return out


def widest(df: DataFrame) -> int:
    """Length of the longest vector (0 for an empty table)."""
    return df.agg(F.max(F.size("ints"))).first()[0] or 0
