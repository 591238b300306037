"""Registry of named queries: a Spark plan plus an independent DuckDB oracle.

Every query reads whole tables from ``sf_dir`` (through the fixtures) and returns a lazy
DataFrame.  Computed doubles are rounded to 6 decimals in BOTH forms because summation
order differs between engines; integers are BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None):
    """Decorator: register ``fn(spark, sf_dir)`` under ``name`` with its oracle ``sql``."""
    def wrap(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, ops, (fn.__doc__ or "").strip())
        return fn
    return wrap


# Values built from short decimals often sit exactly on a rounding half-way point, where
# engines that sum in a different order land one ulp either side.  Both forms therefore
# round ``x + GUARD``: the guard has many significant digits, so no short-decimal value
# is a half-way point after it is added, and 1-ulp differences round the same way.
GUARD = 1.2345678e-10


def rnd(c: str | Column, digits: int = 6) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double") + F.lit(GUARD), digits)


def rsql(expr: str, digits: int = 6) -> str:
    """The DuckDB form of ``rnd``."""
    return f"round(CAST({expr} AS DOUBLE) + {GUARD}, {digits})"


def rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: rnd(c, digits) for c in cols})
