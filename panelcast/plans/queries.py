"""Registered queries: one per inventory operator group (see README for the id map).

Importing this module fills ``catalog.REGISTRY``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.functions.timefeat import add_time_features
from panelcast.operators.lags import lag_block
from panelcast.plans.catalog import query, rounded, rsql
from panelcast.schema import LAG_COLS, LAG_STEPS, ROLL_WINDOWS
from panelcast.sources import fixtures as fx

# --- shared SQL pieces (DuckDB) ---------------------------------------------
TIME_SQL = """
pt AS (
  SELECT *, CAST(split_part("timestamp", ':', 1) AS BIGINT) AS hour,
            CAST(split_part("timestamp", ':', 2) AS BIGINT) AS minute
  FROM panel
),
ptt AS (SELECT *, day * 1440 + hour * 60 + minute AS t, hour * 60 + minute AS time_of_day FROM pt)"""


def _panel_sql(*more: str) -> str:
    return fx.with_sql(fx.CELL_PANEL_SQL, TIME_SQL, *more)


def _lag_sql(src: str, entity: str, rid: str, y: str, step: int) -> str:
    joins = "\n".join(
        f"LEFT JOIN {src} l{k} ON l{k}.{entity} = p.{entity} AND l{k}.t = p.t - {k * step}" for k in LAG_STEPS)
    lag_cols = ", ".join(f"{rsql(f'l{k}.{y}')} AS lag_{k}" for k in LAG_STEPS)
    roll_cols = ", ".join(
        f"{rsql(f'avg(p.{y}) OVER w{w}')} AS roll_mean_{w}, {rsql(f'stddev_samp(p.{y}) OVER w{w}')} AS roll_std_{w}"
        for w in ROLL_WINDOWS)
    windows = ", ".join(
        f"w{w} AS (PARTITION BY p.{entity} ORDER BY p.t ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
        for w in ROLL_WINDOWS)
    return f"SELECT {rid}, {lag_cols}, {roll_cols}\nFROM {src} p\n{joins}\nWINDOW {windows}"


# --- J1 / W1-W4 --------------------------------------------------------------
@query("lag_rolling", "J1 W1 W2 W3 W4 T2 U1 P7",
       _panel_sql() + _lag_sql("ptt", "geohash", 'p."Index"', "demand", 15))
def q_lag_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact-time lags and previous-row rolling stats on the labelled+unlabelled cell panel."""
    p = add_time_features(fx.cell_panel(spark, sf_dir))
    out = lag_block(p.select("Index", "geohash", "t", "demand"), "geohash", "t", "demand", 15)
    return rounded(out.select("Index", *LAG_COLS), LAG_COLS)


@query("lag_rolling_dense", "J1 W1 W3 W4",
       fx.with_sql(fx.DENSE_PANEL_SQL, "dd AS (SELECT * FROM dense)")
       + _lag_sql("dd", "entity", "p.entity, p.slot", "y", 15))
def q_lag_rolling_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags and rolling stats on the dense (event type, slot) panel, where most lags exist."""
    p = fx.dense_panel(spark, sf_dir)
    out = lag_block(p.select("entity", "slot", "t", "y"), "entity", "t", "y", 15)
    return rounded(out.select("entity", "slot", *LAG_COLS), LAG_COLS)


# The other query modules register themselves on import (they import helpers from here).
from panelcast.plans import q_features  # noqa: E402,F401
from panelcast.plans import q_encode  # noqa: E402,F401
from panelcast.plans import q_models  # noqa: E402,F401
from panelcast.plans import q_profile  # noqa: E402,F401
from panelcast.plans import q_jobs  # noqa: E402,F401
from panelcast.plans import q_supplier  # noqa: E402,F401
from panelcast.plans import q_extra  # noqa: E402,F401
