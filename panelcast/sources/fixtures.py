"""Panels derived from the given tables (see FIXTURES.md).

Each fixture exists twice: as a Spark plan (``*_panel(spark, sf_dir)``) and as a DuckDB
SQL common-table expression (``*_SQL``) used by the oracles.  Both are pure integer /
decimal arithmetic over whole tables, so their rows agree exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.schema import PanelSpec

# Fixed values of the fixture definitions.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
EPOCH = "2024-01-01 00:00:00"
SLOT_SECONDS = 900
LABEL_LAST_SLOT = 2216           # labels hidden after day 23, 2:00
ROAD_TYPES = ("Highway", "Arterial", "Local", "Residential")
WEATHERS = ("Clear", "Rain", "Fog")
SUPPLIER_EPOCH = "1995-01-01 00:00:00"
SUPPLIER_LABEL_LAST_DAY = 2000   # supplier panel: days after this are unlabelled

# The events panel: 15-minute steps, scale reference = day < 12, target = day >= 12, slot = hour.
EVENTS_SPEC = PanelSpec(target_day=12, scale_slot="hour")
DENSE_SPEC = PanelSpec(entity="entity", target="y", row_id="row_id", categorical=(), numeric=(),
                       target_day=12, scale_slot="hour")
SUPPLIER_SPEC = PanelSpec(entity="entity", target="y", row_id="row_id", categorical=(), numeric=(),
                          step_minutes=1440, target_day=2000, scale_slot="month")


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _b32(c):
    return F.substring(F.lit(BASE32), (c + 1).cast("int"), 1)


def _event_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    epoch = F.unix_timestamp(F.lit(EPOCH).cast("timestamp_ntz"))
    return ev.select(
        F.col("user_id").alias("u"),
        F.col("event_type"),
        F.floor((F.unix_timestamp("ts") - epoch) / SLOT_SECONDS).cast("bigint").alias("slot"),
        F.col("value").cast("decimal(18,4)").alias("v"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def cell_id(u):
    """The cell id of user ``u``: distinct for every user below 2^25."""
    return F.concat(F.lit("qp"), _b32(F.floor(u / 1024) % 32), _b32(u % 4), _b32(F.floor(u / 4) % 8),
                    _b32(F.floor(u / 32) % 32), _b32(F.floor(u / 32768) % 32), _b32(F.floor(u / 1048576) % 32))


def cell_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a labelled + unlabelled demand panel of (cell, 15-minute slot) rows."""
    g = (_event_slots(spark, sf_dir).groupBy("u", "slot")
         .agg((F.sum("v").cast("double") / 1000).alias("d"), F.max("k").alias("k")))
    u, slot = F.col("u"), F.col("slot")
    q = F.pmod(slot, F.lit(96))
    day = F.floor(slot / 96).cast("bigint")
    labelled = slot <= LABEL_LAST_SLOT
    road = (F.when(((day + q + u) % 11) == 0, F.lit(None).cast("string"))
            .when(((u % 10) == 0) & ((q % 2) == 0), F.lit("Highway"))
            .otherwise(F.element_at(F.array(*[F.lit(r) for r in ROAD_TYPES]),
                                    ((F.floor(u / 7) % 4) + 1).cast("int"))))
    return g.select(
        (u * 4096 + slot).cast("bigint").alias("Index"),
        cell_id(u).alias("geohash"),
        day.alias("day"),
        F.concat((F.floor(q / 4)).cast("string"), F.lit(":"), ((q % 4) * 15).cast("string")).alias("timestamp"),
        F.when(labelled, F.least(F.col("d"), F.lit(1.0))).alias("demand"),
        road.alias("RoadType"),
        F.when(((u + day) % 13) == 0, F.lit(None).cast("double"))
         .otherwise((1 + u % 5).cast("double")).alias("NumberofLanes"),
        F.when((u % 3) == 0, F.lit("Allowed")).otherwise(F.lit("Not Allowed")).alias("LargeVehicles"),
        F.when((u % 2) == 0, F.lit("Yes")).otherwise(F.lit("No")).alias("Landmarks"),
        F.when((F.col("k") % 17) == 0, F.lit(None).cast("double"))
         .otherwise((10 + F.col("k") % 25).cast("double")).alias("Temperature"),
        F.element_at(F.array(*[F.lit(w) for w in WEATHERS]), ((day % 3) + 1).cast("int")).alias("Weather"),
        F.when(labelled, F.lit("train")).otherwise(F.lit("test")).alias("split"),
    )


def dense_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, slot) panel — dense in time, used for lags and rolling windows."""
    g = (_event_slots(spark, sf_dir).groupBy("event_type", "slot")
         .agg((F.sum("v").cast("double") / 1000).alias("y")))
    slot = F.col("slot")
    labelled = slot <= LABEL_LAST_SLOT
    q = F.pmod(slot, F.lit(96))
    return g.select(
        F.col("event_type").alias("entity"),
        slot.alias("slot"),
        (slot * 15).cast("bigint").alias("t"),
        F.floor(slot / 96).cast("bigint").alias("day"),
        F.concat((F.floor(q / 4)).cast("string"), F.lit(":"), ((q % 4) * 15).cast("string")).alias("timestamp"),
        F.when(labelled, F.col("y")).alias("y"),
        F.when(labelled, F.lit("train")).otherwise(F.lit("test")).alias("split"),
    )


def supplier_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(supplier, ship day) panel from lineitem — larger groups for timing."""
    li = _read(spark, sf_dir, "lineitem")
    day = F.datediff(F.col("l_shipdate"), F.lit(SUPPLIER_EPOCH).cast("timestamp_ntz")).cast("bigint")
    g = (li.select(F.col("l_suppkey").alias("entity"), day.alias("day"),
                   F.col("l_quantity").cast("decimal(18,4)").alias("q"),
                   F.month("l_shipdate").cast("bigint").alias("month"),
                   F.col("l_returnflag"))
         .groupBy("entity", "day")
         .agg(F.sum("q").cast("double").alias("y"), F.max("month").alias("month"),
              F.max("l_returnflag").alias("l_returnflag")))
    labelled = F.col("day") <= SUPPLIER_LABEL_LAST_DAY
    return g.select(
        (F.col("entity") * 10000 + F.col("day")).cast("bigint").alias("row_id"),
        F.col("entity").cast("string").alias("entity"),
        F.col("day"),
        (F.col("day") * 1440).cast("bigint").alias("t"),
        F.lit("0:0").alias("timestamp"),
        F.col("month"),
        F.col("l_returnflag"),
        F.when(labelled, F.col("y")).alias("y"),
        F.when(labelled, F.lit("train")).otherwise(F.lit("test")).alias("split"),
    )


# ---------------------------------------------------------------------------
# DuckDB forms of the same fixtures (used only by the oracles)
# ---------------------------------------------------------------------------
def _b32_sql(expr: str) -> str:
    return f"substr('{BASE32}', CAST(({expr}) AS INTEGER) + 1, 1)"


CELL_ID_SQL = "'qp' || " + " || ".join(_b32_sql(e) for e in (
    "(u // 1024) % 32", "u % 4", "(u // 4) % 8", "(u // 32) % 32", "(u // 32768) % 32", "(u // 1048576) % 32"))


EVENT_SLOTS_SQL = f"""
ev AS (
  SELECT user_id AS u, event_type,
         (epoch_us(ts) - epoch_us(TIMESTAMP '{EPOCH}')) // {SLOT_SECONDS * 1_000_000} AS slot,
         CAST(value AS DECIMAL(18,4)) AS v,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
)"""

CELL_PANEL_SQL = f"""{EVENT_SLOTS_SQL},
cp_agg AS (SELECT u, slot, CAST(SUM(v) AS DOUBLE) / 1000 AS d, MAX(k) AS k FROM ev GROUP BY u, slot),
cp_slots AS (SELECT *, slot // 96 AS dday, slot % 96 AS q FROM cp_agg),
panel AS (
  SELECT CAST(u * 4096 + slot AS BIGINT) AS "Index",
         {CELL_ID_SQL} AS geohash,
         CAST(dday AS BIGINT) AS day,
         CAST(q // 4 AS VARCHAR) || ':' || CAST((q % 4) * 15 AS VARCHAR) AS "timestamp",
         CASE WHEN slot <= {LABEL_LAST_SLOT} THEN least(d, CAST(1.0 AS DOUBLE)) END AS demand,
         CASE WHEN (dday + q + u) % 11 = 0 THEN NULL
              WHEN u % 10 = 0 AND q % 2 = 0 THEN 'Highway'
              ELSE ['{"','".join(ROAD_TYPES)}'][CAST((u // 7) % 4 AS INTEGER) + 1] END AS "RoadType",
         CASE WHEN (u + dday) % 13 = 0 THEN NULL ELSE CAST(1 + u % 5 AS DOUBLE) END AS "NumberofLanes",
         CASE WHEN u % 3 = 0 THEN 'Allowed' ELSE 'Not Allowed' END AS "LargeVehicles",
         CASE WHEN u % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Landmarks",
         CASE WHEN k % 17 = 0 THEN NULL ELSE CAST(10 + k % 25 AS DOUBLE) END AS "Temperature",
         ['{"','".join(WEATHERS)}'][CAST(dday % 3 AS INTEGER) + 1] AS "Weather",
         CASE WHEN slot <= {LABEL_LAST_SLOT} THEN 'train' ELSE 'test' END AS split
  FROM cp_slots
)"""

DENSE_PANEL_SQL = f"""{EVENT_SLOTS_SQL},
dg AS (SELECT event_type, slot, CAST(SUM(v) AS DOUBLE) / 1000 AS y FROM ev GROUP BY event_type, slot),
dense AS (
  SELECT event_type AS entity, CAST(slot AS BIGINT) AS slot, CAST(slot * 15 AS BIGINT) AS t,
         CAST(slot // 96 AS BIGINT) AS day,
         CASE WHEN slot <= {LABEL_LAST_SLOT} THEN y END AS y,
         CASE WHEN slot <= {LABEL_LAST_SLOT} THEN 'train' ELSE 'test' END AS split
  FROM dg
)"""

SUPPLIER_PANEL_SQL = f"""
sp0 AS (
  SELECT l_suppkey AS entity,
         CAST(date_diff('day', DATE '{SUPPLIER_EPOCH[:10]}', CAST(l_shipdate AS DATE)) AS BIGINT) AS day,
         CAST(l_quantity AS DECIMAL(18,4)) AS q, CAST(month(l_shipdate) AS BIGINT) AS month, l_returnflag
  FROM lineitem
),
supplier AS (
  SELECT CAST(entity * 10000 + day AS BIGINT) AS row_id, CAST(entity AS VARCHAR) AS entity, day,
         CAST(day * 1440 AS BIGINT) AS t, MAX(month) AS month, MAX(l_returnflag) AS l_returnflag,
         CASE WHEN day <= {SUPPLIER_LABEL_LAST_DAY} THEN CAST(SUM(q) AS DOUBLE) END AS y,
         CASE WHEN day <= {SUPPLIER_LABEL_LAST_DAY} THEN 'train' ELSE 'test' END AS split
  FROM sp0 GROUP BY entity, day
)"""


def with_sql(*ctes: str) -> str:
    """Join CTE bodies into a ``WITH`` prefix."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
