"""Queries for time / spatial / imputation / indexing operators and the R1 job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.geohash import GEOHASH_ALPHABET, prefix
from panelcast.functions.timefeat import add_time_features, log1p_target, slot_datetime, sort_key
from panelcast.operators.impute import (group_mode, impute_from_map, numeric_medians, unambiguous_map)
from panelcast.operators.indexer import apply_codes, cell_table, code_tables, interaction_codes
from panelcast.plans.catalog import query, rnd, rounded, rsql
from panelcast.plans.features import build_base_features
from panelcast.plans.queries import _lag_sql, _panel_sql
from panelcast.schema import BASE_COLS, LAG_COLS
from panelcast.session import cut_lineage
from panelcast.sources import fixtures as fx

TRIG = ("sin_hour", "cos_hour", "sin_tod", "cos_tod", "sin_dow", "cos_dow")

TIME_FEAT_SQL = """
tf AS (
  SELECT *, ((day % 7) + 7) % 7 AS day_mod7, day * 10000 + hour * 100 + minute AS sort_key
  FROM ptt
),
tf2 AS (
  SELECT *, CASE WHEN day_mod7 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
         sin(2 * pi() * hour / 24) AS sin_hour, cos(2 * pi() * hour / 24) AS cos_hour,
         sin(2 * pi() * time_of_day / 1440) AS sin_tod, cos(2 * pi() * time_of_day / 1440) AS cos_tod,
         sin(2 * pi() * day_mod7 / 7) AS sin_dow, cos(2 * pi() * day_mod7 / 7) AS cos_dow,
         CASE WHEN hour < 5 THEN 0 WHEN hour < 9 THEN 1 WHEN hour < 12 THEN 2 WHEN hour < 15 THEN 3 ELSE 4 END
           AS tod_bucket
  FROM tf
)"""


@query("time_features", "P1 P2 P3 P4 P5 P6 P7 P8",
       _panel_sql(TIME_FEAT_SQL) + f"""
SELECT "Index", hour, minute, time_of_day, day_mod7, CAST(is_weekend AS BIGINT) AS is_weekend,
       CAST(tod_bucket AS BIGINT) AS tod_bucket, t, sort_key,
       {", ".join(f"{rsql(c)} AS {c}" for c in TRIG)}
FROM tf2""")
def q_time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock parse, time of day, weekday flags, cyclic pairs, buckets, absolute minute, sort key."""
    p = add_time_features(fx.cell_panel(spark, sf_dir))
    p = p.withColumn("sort_key", sort_key(F.col("day"), F.col("hour"), F.col("minute")))
    return rounded(p.select("Index", "hour", "minute", "time_of_day", "day_mod7", "is_weekend", "tod_bucket",
                            "t", "sort_key", *TRIG), TRIG)


@query("slot_datetime", "P9 P19 P22",
       _panel_sql() + f"""
SELECT "Index",
       strftime(TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(day AS INTEGER)) + to_hours(CAST(hour AS INTEGER))
                + to_minutes(CAST(minute AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS slot_dt,
       geohash || '|' || CAST(day AS VARCHAR) || ' ' || "timestamp" AS cell_time_key,
       {rsql('ln(1 + demand)')} AS log1p_demand
FROM ptt""")
def q_slot_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datetime built from day + clock, the composite (cell, time) key and log1p of the target."""
    p = add_time_features(fx.cell_panel(spark, sf_dir))
    dt = slot_datetime(F.col("day"), F.col("hour"), F.col("minute"))
    return p.select("Index", F.date_format(dt, "yyyy-MM-dd HH:mm:ss").alias("slot_dt"),
                    F.concat_ws("|", "geohash", F.concat_ws(" ", F.col("day").cast("string"), "timestamp"))
                    .alias("cell_time_key"),
                    rnd(log1p_target("demand")).alias("log1p_demand"))


def _decode_sql(g: str, max_len: int = 12) -> tuple[str, str]:
    """Bisection-sum form of the geohash centre (a different formulation from the Spark fold)."""
    lon_terms, lat_terms = [], []
    for i in range(max_len):
        d = f"(strpos('{GEOHASH_ALPHABET}', substr({g}, {i + 1}, 1)) - 1)"
        for j in range(5):
            gbit = 5 * i + j
            bit = f"((CASE WHEN length({g}) > {i} THEN {d} ELSE 0 END >> {4 - j}) & 1)"
            if gbit % 2 == 0:
                lon_terms.append(f"{bit} * {360.0 / 2 ** (gbit // 2 + 1)!r}")
            else:
                lat_terms.append(f"{bit} * {180.0 / 2 ** ((gbit - 1) // 2 + 1)!r}")
    valid = " AND ".join(
        f"(length({g}) <= {i} OR strpos('{GEOHASH_ALPHABET}', substr({g}, {i + 1}, 1)) > 0)" for i in range(max_len))
    valid = f"length({g}) > 0 AND length({g}) <= {max_len} AND {valid}"
    lon = (f"CASE WHEN {valid} THEN -180.0 + {' + '.join(lon_terms)} "
           f"+ 360.0 / pow(2, (5 * length({g}) + 1) // 2 + 1) END")
    lat = (f"CASE WHEN {valid} THEN -90.0 + {' + '.join(lat_terms)} "
           f"+ 180.0 / pow(2, (5 * length({g})) // 2 + 1) END")
    return lat, lon


_LAT, _LON = _decode_sql("geohash")


@query("geohash_decode", "P10 P11",
       _panel_sql() + f"""
SELECT geohash, {rsql(_LAT, 9)} AS lat, {rsql(_LON, 9)} AS lon,
       substr(geohash, 1, 4) AS prefix4, substr(geohash, 1, 5) AS prefix5
FROM (SELECT DISTINCT geohash FROM panel)""")
def q_geohash_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell centre and prefix regions, decoded once per distinct cell."""
    cells = cell_table(fx.cell_panel(spark, sf_dir))
    return rounded(cells, ["lat", "lon"], 9)


@query("roadtype_map", "A1",
       _panel_sql() + """
SELECT geohash, max(RoadType) AS RoadType FROM panel
WHERE split = 'train' AND RoadType IS NOT NULL
GROUP BY geohash HAVING count(DISTINCT RoadType) = 1""")
def q_roadtype_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose known RoadType is unambiguous in the labelled rows."""
    p = fx.cell_panel(spark, sf_dir)
    return unambiguous_map(p.where(F.col("split") == "train"), "geohash", "RoadType")


@query("roadtype_mode", "A2",
       _panel_sql() + """
SELECT geohash, RoadType AS mode_roadtype FROM (
  SELECT geohash, RoadType, row_number() OVER (PARTITION BY geohash ORDER BY cnt DESC, RoadType) AS rn
  FROM (SELECT geohash, RoadType, count(*) AS cnt FROM panel WHERE RoadType IS NOT NULL GROUP BY ALL)
) WHERE rn = 1""")
def q_roadtype_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent RoadType per cell, ties to the smallest value."""
    return group_mode(fx.cell_panel(spark, sf_dir), ["geohash"], "RoadType", "mode_roadtype")


ROAD_IMPUTE_SQL = """
rmap AS (SELECT geohash, max(RoadType) AS mapped FROM panel
         WHERE split = 'train' AND RoadType IS NOT NULL GROUP BY geohash HAVING count(DISTINCT RoadType) = 1),
imp AS (SELECT p.*, CAST(p.RoadType IS NULL AS BIGINT) AS roadtype_was_missing,
               coalesce(p.RoadType, m.mapped, 'Missing') AS rt_imputed
        FROM panel p LEFT JOIN rmap m USING (geohash))"""


@query("roadtype_impute", "A3 P12 P13 J6",
       _panel_sql(ROAD_IMPUTE_SQL) + """
SELECT "Index", rt_imputed AS RoadType, roadtype_was_missing FROM imp""")
def q_roadtype_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RoadType imputed from unambiguous cells, else 'Missing', with the missing flag."""
    p = fx.cell_panel(spark, sf_dir)
    m = unambiguous_map(p.where(F.col("split") == "train"), "geohash", "RoadType")
    return impute_from_map(p, m, "geohash", "RoadType").select("Index", "RoadType", "roadtype_was_missing")


@query("roadtype_impute_counts", "A3",
       _panel_sql(ROAD_IMPUTE_SQL) + """
SELECT split, CAST(sum(roadtype_was_missing) AS BIGINT) AS was_missing,
       CAST(sum(CASE WHEN roadtype_was_missing = 1 AND rt_imputed <> 'Missing' THEN 1 ELSE 0 END) AS BIGINT) AS filled,
       CAST(sum(CASE WHEN rt_imputed = 'Missing' THEN 1 ELSE 0 END) AS BIGINT) AS remain_missing
FROM imp GROUP BY split""")
def q_roadtype_impute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many RoadType NULLs were filled and how many stay 'Missing', per split."""
    p = fx.cell_panel(spark, sf_dir)
    m = unambiguous_map(p.where(F.col("split") == "train"), "geohash", "RoadType")
    imp = impute_from_map(p, m, "geohash", "RoadType")
    miss = F.col("roadtype_was_missing") == 1
    return imp.groupBy("split").agg(
        F.sum("roadtype_was_missing").cast("bigint").alias("was_missing"),
        F.sum(F.when(miss & (F.col("RoadType") != "Missing"), 1).otherwise(0)).cast("bigint").alias("filled"),
        F.sum(F.when(F.col("RoadType") == "Missing", 1).otherwise(0)).cast("bigint").alias("remain_missing"))


@query("median_impute", "A4 P13",
       _panel_sql() + f"""
, med AS (SELECT median(NumberofLanes) AS ml, median(Temperature) AS mt FROM panel WHERE split = 'train')
SELECT "Index", {rsql('coalesce(NumberofLanes, ml)')} AS NumberofLanes,
       {rsql('coalesce(Temperature, mt)')} AS Temperature
FROM panel, med""")
def q_median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric NULLs filled with the exact labelled-row median (one skew-safe pass for all columns)."""
    p = fx.cell_panel(spark, sf_dir)
    med = {r["name"]: r["median"] for r in
           numeric_medians(p.where(F.col("split") == "train"), ["NumberofLanes", "Temperature"]).collect()}
    return p.select("Index", *[rnd(F.coalesce(F.col(c), F.lit(med[c]))).alias(c) for c in med])


LE_SQL_COLS = ("RoadType", "Weather", "LargeVehicles", "Landmarks", "geohash", "prefix5", "prefix4")


def _codes_sql() -> str:
    parts = []
    for c in LE_SQL_COLS:
        parts.append(f"SELECT DISTINCT '{c}' AS col, coalesce(CAST({c} AS VARCHAR), 'nan') AS value FROM enc")
    return ("codes AS (SELECT col, value, dense_rank() OVER (PARTITION BY col ORDER BY value) - 1 AS code FROM ("
            + " UNION ".join(parts) + "))")


ENC_SQL = ROAD_IMPUTE_SQL + """,
enc AS (SELECT i.* EXCLUDE (RoadType), rt_imputed AS RoadType, substr(geohash, 1, 5) AS prefix5,
               substr(geohash, 1, 4) AS prefix4 FROM imp i),
""" + _codes_sql()


@query("label_codes", "C1 U2 P14",
       _panel_sql(ENC_SQL) + """
, wide AS (
  SELECT e."Index", e.hour,
""" + ",\n".join(
           f"    (SELECT code FROM codes c WHERE c.col = '{c}' AND c.value = coalesce(CAST(e.{c} AS VARCHAR), 'nan'))"
           f" AS {c}_le" for c in LE_SQL_COLS) + """
  FROM (SELECT enc.*, CAST(split_part("timestamp", ':', 1) AS BIGINT) AS hour FROM enc) e
)
SELECT "Index", """ + ", ".join(f"CAST({c}_le AS BIGINT) AS {c}_le" for c in LE_SQL_COLS) + """,
       CAST(RoadType_le * 24 + hour AS BIGINT) AS roadtype_hour_le,
       CAST(Weather_le * 24 + hour AS BIGINT) AS weather_hour_le
FROM wide""")
def q_label_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes 0.. in ascending order over both splits (after RoadType imputation) and hour interactions."""
    p = add_time_features(fx.cell_panel(spark, sf_dir))
    m = unambiguous_map(p.where(F.col("split") == "train"), "geohash", "RoadType")
    p = impute_from_map(p, m, "geohash", "RoadType")
    p = p.withColumns({"prefix5": prefix("geohash", 5), "prefix4": prefix("geohash", 4)})
    p = interaction_codes(apply_codes(p, code_tables(p, LE_SQL_COLS), LE_SQL_COLS))
    return p.select("Index", *[f"{c}_le" for c in LE_SQL_COLS], "roadtype_hour_le", "weather_hour_le")


_BASE_DOUBLES = ("sin_hour", "cos_hour", "sin_tod", "cos_tod", "sin_dow", "cos_dow", "lat", "lon",
                 "NumberofLanes", "Temperature")


def _base_features_sql() -> str:
    lag = _lag_sql("ptt", "geohash", 'p."Index"', "demand", 15)
    return _panel_sql(TIME_FEAT_SQL, ENC_SQL) + f"""
, med AS (SELECT median(NumberofLanes) AS ml, median(Temperature) AS mt FROM panel WHERE split = 'train')
, lags AS ({lag})
, b AS (
  SELECT t."Index", t.day, t.hour, t.minute, t.time_of_day, t.day_mod7, t.is_weekend, t.tod_bucket,
         t.sin_hour, t.cos_hour, t.sin_tod, t.cos_tod, t.sin_dow, t.cos_dow,
         {_LAT.replace('geohash', 't.geohash')} AS lat, {_LON.replace('geohash', 't.geohash')} AS lon,
         coalesce(t.NumberofLanes, med.ml) AS NumberofLanes, coalesce(t.Temperature, med.mt) AS Temperature,
""" + ",\n".join(
        f"         (SELECT code FROM codes c WHERE c.col = '{c}' AND c.value = coalesce(CAST(e.{c} AS VARCHAR), 'nan'))"
        f" AS {c}_le" for c in LE_SQL_COLS) + """,
         e.roadtype_was_missing
  FROM tf2 t JOIN enc e USING ("Index"), med
)
SELECT b."Index", """ + ", ".join(
        (rsql(f"b.{c}") + f" AS {c}") if c in _BASE_DOUBLES else
        ("CAST(b.RoadType_le * 24 + b.hour AS BIGINT) AS roadtype_hour_le" if c == "roadtype_hour_le" else
         "CAST(b.Weather_le * 24 + b.hour AS BIGINT) AS weather_hour_le" if c == "weather_hour_le" else
         f"CAST(b.{c} AS BIGINT) AS {c}")
        for c in BASE_COLS) + ", " + ", ".join(f"l.{c}" for c in LAG_COLS) + """
FROM b JOIN lags l USING ("Index")"""


@query("base_features", "R1 P18 U1 J10", _base_features_sql())
def q_base_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole base feature table (27 base + 9 lag columns) for both splits."""
    # the input panel is stored once (as a real input file would be); the fits then scan it
    feats = build_base_features(cut_lineage(fx.cell_panel(spark, sf_dir)), fx.EVENTS_SPEC)
    out = feats.select("Index", *BASE_COLS, *LAG_COLS)
    out = rounded(out, list(_BASE_DOUBLES) + list(LAG_COLS))
    return out.withColumns({c: F.col(c).cast("bigint") for c in BASE_COLS if c not in _BASE_DOUBLES})
