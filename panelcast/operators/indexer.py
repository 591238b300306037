"""Categorical indexing (C1, C2, P14) and the cell enrichment table.

Label codes are 0.. in ascending string order of the values seen in BOTH splits, NULL
read as the text ``'nan'``.  All columns are encoded in one pass: the (column, value)
pairs are unpivoted, ordered by a distributed global ordinal, and each column's codes
start at its first position.  Nothing is collected to the driver, so a cell id with
hundreds of millions of values is encoded like any other column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.geohash import decode_center, prefix
from panelcast.operators.ordinal import global_ordinal
from panelcast.schema import NULL_CATEGORY
from panelcast.session import cut_lineage


def category_text(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(NULL_CATEGORY))


def value_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (column, value-as-text) pairs of ``cols``."""
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), category_text(c).alias("value")) for c in cols])).alias("_p")
    ).select("_p.column", "_p.value").distinct()


def code_tables(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C1 (fit): long table (column, value, code)."""
    return codes_from_pairs(value_pairs(df, cols))


def codes_from_pairs(pairs: DataFrame) -> DataFrame:
    """Codes 0.. per column in ascending value order, from distinct (column, value) pairs."""
    ordered = global_ordinal(pairs, ["column", "value"], name="_pos")
    first = ordered.groupBy("column").agg(F.min("_pos").alias("_first"))
    codes = (ordered.join(F.broadcast(first), "column")   # one row per encoded column
             .select("column", "value", (F.col("_pos") - F.col("_first")).cast("bigint").alias("code")))
    # one row per distinct value: written once, then every column's lookup reads the small table
    return cut_lineage(codes, "codes")


def apply_codes(df: DataFrame, codes: DataFrame, cols: Sequence[str], suffix: str = "_le") -> DataFrame:
    """C1 (apply): add ``<col>_le`` for every column (a lookup join per column)."""
    for c in cols:
        table = codes.where(F.col("column") == c).select(F.col("value").alias("_val"),
                                                          F.col("code").alias(f"{c}{suffix}"))
        df = (df.withColumn("_val", category_text(c)).join(table, "_val", "left").drop("_val"))
    return df


def interaction_codes(df: DataFrame, pairs=(("RoadType_le", "roadtype_hour_le"),
                                            ("Weather_le", "weather_hour_le")), hour: str = "hour") -> DataFrame:
    """``code*24 + hour``."""
    return df.withColumns({out: (F.col(src) * 24 + F.col(hour)).cast("bigint") for src, out in pairs})


def cell_table(df: DataFrame, entity: str = "geohash") -> DataFrame:
    """P10 + P11 as an enrichment job: decode each DISTINCT cell once, join back."""
    cells = df.select(entity).distinct()
    lat, lon = decode_center(entity)
    return cells.select(entity, lat.alias("lat"), lon.alias("lon"),
                        prefix(entity, 4).alias("prefix4"), prefix(entity, 5).alias("prefix5"))
