"""Helpers for one-row statistics (never joined with a cross join) and for joins of tables that grow alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scalar(one_row: DataFrame, col: str):
    """Value of ``col`` in a one-row aggregate (bounded: a single row reaches the driver)."""
    row = one_row.select(col).first()
    return None if row is None else row[0]


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Side-by-side columns of several one-row frames: union (missing columns NULL) and one
    global aggregation that keeps each column's only non-NULL value — no join at all."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    cols = []
    for f in frames:
        cols += [c for c in f.columns if c not in cols]
    return out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])


def join_rows(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join of two tables that both grow with the rows, always by exchange.

    Spark's estimate of a few columns read back from a wide file is the file's size by the share of the
    types' widths; incompressible ids and values are many times that, so a broadcast chosen by it would put
    every row into the driver."""
    return left.join(right.hint("merge"), list(on), how)
