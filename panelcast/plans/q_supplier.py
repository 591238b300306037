"""Queries on the supplier panel (F3): larger groups, a few very hot keys (return flag)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.encode import encode_all
from panelcast.operators.lags import lag_block
from panelcast.operators.splits import full_fit_roles
from panelcast.plans.catalog import query, rounded, rsql
from panelcast.plans.queries import _lag_sql
from panelcast.schema import LAG_COLS
from panelcast.sources import fixtures as fx

SUPPLIER_SPECS = ((("entity",), "te_s"), (("month",), "te_m"), (("l_returnflag",), "te_rf"),
                  (("entity", "month"), "te_sm"))
SUPPLIER_TE_COLS = tuple(f"{p}_{s}" for _, p in SUPPLIER_SPECS for s in ("mean", "med"))


@query("supplier_lags", "J1 W1 W3 W4",
       fx.with_sql(fx.SUPPLIER_PANEL_SQL, "sp AS (SELECT * FROM supplier)")
       + _lag_sql("sp", "entity", "p.row_id", "y", 1440))
def q_supplier_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily lags (1, 2, 4, 96, 192 days) and previous-row rolling stats per supplier."""
    p = fx.supplier_panel(spark, sf_dir)
    out = lag_block(p.select("row_id", "entity", "t", "y"), "entity", "t", "y", 1440)
    return rounded(out.select("row_id", *LAG_COLS), LAG_COLS)


def _supplier_loo_sql() -> str:
    ctes = ["fit AS (SELECT * FROM supplier WHERE split = 'train')",
            "g AS (SELECT avg(y) AS gm, median(y) AS gmed FROM fit)"]
    cols, joins = [], []
    for i, (keys, p) in enumerate(SUPPLIER_SPECS):
        kl = ", ".join(keys)
        on = " AND ".join(f"x.{k} = r.{k}" for k in keys)
        ctes.append(f"s{i} AS (SELECT {kl}, count(*) AS n, sum(y) AS s, median(y) AS md FROM fit GROUP BY {kl})")
        # exact leave-one-out median for small groups only, by pairing rows inside those groups
        ctes.append(f"""l{i} AS (SELECT r.row_id, median(x.y) AS lm FROM fit r JOIN s{i} USING ({kl})
                      JOIN fit x ON {on} AND x.row_id <> r.row_id WHERE s{i}.n BETWEEN 2 AND 20 GROUP BY r.row_id)""")
        joins.append(f"LEFT JOIN s{i} USING ({kl}) LEFT JOIN l{i} ON l{i}.row_id = r.row_id")
        cols.append(rsql(f"""CASE WHEN r.split = 'train' THEN
            (CASE WHEN s{i}.n > 1 THEN (s{i}.s - r.y) / (s{i}.n - 1) ELSE g.gm END)
            ELSE coalesce(s{i}.s / s{i}.n, g.gm) END""") + f" AS {p}_mean")
        cols.append(rsql(f"""CASE WHEN r.split = 'train' THEN
            (CASE WHEN s{i}.n IS NULL OR s{i}.n <= 1 THEN g.gmed WHEN s{i}.n <= 20 THEN l{i}.lm ELSE s{i}.md END)
            ELSE coalesce(s{i}.md, g.gmed) END""") + f" AS {p}_med")
    return (fx.with_sql(fx.SUPPLIER_PANEL_SQL, *ctes) + "SELECT r.row_id, " + ", ".join(cols)
            + "\nFROM supplier r CROSS JOIN g " + " ".join(joins))


@query("supplier_loo", "A5 W5 W6 W7 J2 J3", _supplier_loo_sql())
def q_supplier_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOO mean/median encodings by supplier, month, return flag (3 hot keys) and supplier x month."""
    return _supplier_loo(spark, sf_dir)


@query("supplier_loo_skew", "A5 W5 W6 W7", _supplier_loo_sql())
def q_supplier_loo_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same encodings over 64 range partitions: the return-flag and month groups (a third / a
    twelfth of all rows) spread over many of them, so their medians come from running sums across."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "64")
    try:
        return _supplier_loo(spark, sf_dir)
    finally:
        spark.conf.set(setting, before)


def _supplier_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.supplier_panel(spark, sf_dir)
    rows = full_fit_roles(p.where(F.col("split") == "train"), p.where(F.col("split") == "test"))
    enc = encode_all(rows, "y", "row_id", loo_specs=SUPPLIER_SPECS, folds=[-1])
    return rounded(enc.select("row_id", *SUPPLIER_TE_COLS), SUPPLIER_TE_COLS)
