"""Attribute imputation.

All statistics are fitted on labelled rows only and applied to both splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.orderstats import order_stats
from panelcast.schema import MISSING_ROAD


def unambiguous_map(df: DataFrame, entity: str, attr: str) -> DataFrame:
    """A1: entity -> attr for entities whose non-NULL attr has exactly one distinct value.

    ``count_distinct`` is planned as a two-level aggregation (partial on (entity, attr)),
    so a hot entity is combined map-side."""
    known = df.where(F.col(attr).isNotNull())
    return (known.groupBy(entity)
            .agg(F.count_distinct(attr).alias("_nd"), F.max(attr).alias(attr))
            .where(F.col("_nd") == 1).select(entity, attr))


def group_mode(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """A2: most frequent non-NULL value per group; ties -> smallest value.

    Counts per (group, value) first (partial aggregation), then ``min_by`` over
    (-count, value) — both steps combine map-side, so no group is gathered in one task."""
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, value)
              .agg(F.count(F.lit(1)).alias("_cnt")))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct((-F.col("_cnt")).alias("c"), F.col(value).alias("v")))
        .alias(alias or value))


def impute_from_map(df: DataFrame, mapping: DataFrame, entity: str, attr: str,
                    flag: str = "roadtype_was_missing", missing: str = MISSING_ROAD) -> DataFrame:
    """A3 = P12 + J6 + P13: flag NULLs, fill from the entity map, then a literal."""
    m = mapping.select(entity, F.col(attr).alias("_mapped"))
    return (df.join(m, entity, "left")
            .withColumn(flag, F.col(attr).isNull().cast("bigint"))
            .withColumn(attr, F.coalesce(F.col(attr), F.col("_mapped"), F.lit(missing)))
            .drop("_mapped"))


def numeric_medians(labelled: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4 (fit): exact median of each numeric column over labelled rows, NULLs skipped.

    The columns are unpivoted into (name, value) so ONE skew-safe order-statistics pass
    serves all of them.  Result: one row per column (name, median)."""
    if not cols:
        raise ValueError("no numeric columns")
    long = labelled.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])).alias("_kv")
    ).select("_kv.name", "_kv.value")
    st = order_stats(long, ["name"], "value",
                     {"_lo": lambda n: F.floor(n / 2) - 1, "_mid": lambda n: F.floor(n / 2)})
    return st.select("name", F.when(F.col("_n") % 2 == 1, F.col("_mid"))
                     .otherwise((F.col("_lo") + F.col("_mid")) / 2).alias("median"))


def fill_medians(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """A4 (apply): NULL -> fitted median."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float(m)) if m is not None else F.lit(None))
                           for c, m in medians.items()})


def collect_medians(medians: DataFrame) -> dict[str, float]:
    """The median table has one row per numeric column (bounded by the schema)."""
    return {r["name"]: r["median"] for r in medians.collect()}
