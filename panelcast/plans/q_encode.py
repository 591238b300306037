"""Queries for encodings, folds and cross-period calibration (R2 and its parts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.operators.crossperiod import scale_summary
from panelcast.operators.encode import (encode_rows, global_key_stats, global_loo_encode, lookup_with_row_fallback,
                                        merge_encodings, smoothed_encode)
from panelcast.operators.splits import fold_report, group_folds, temporal_positions, time_holdout, with_target_share
from panelcast.plans.catalog import query, rounded, rsql
from panelcast.plans.encodings import add_all_encodings, cross_period_scale, encoding_inputs, fold_rows, full_rows
from panelcast.plans.features import materialized_features
from panelcast.plans.q_features import ENC_SQL
from panelcast.plans.queries import _panel_sql
from panelcast.schema import GLOBAL_RT_SPECS, LOO_TE_COLS, LOO_TE_SPECS
from panelcast.sources import fixtures as fx

SPEC = fx.EVENTS_SPEC

# Base features the encodings need, in DuckDB (imputed RoadType / lanes, time columns, lag_96).
FEAT_SQL = ENC_SQL + """,
med AS (SELECT median(NumberofLanes) AS ml FROM panel WHERE split = 'train'),
feat0 AS (
  SELECT e."Index", e.geohash, e.day, e.split, e.demand, e.RoadType, e.LargeVehicles, e.prefix5,
         coalesce(e.NumberofLanes, med.ml) AS NumberofLanes,
         CAST(split_part(e."timestamp", ':', 1) AS BIGINT) AS hour,
         CAST(split_part(e."timestamp", ':', 2) AS BIGINT) AS minute
  FROM enc e, med
),
feat1 AS (
  SELECT *, hour * 60 + minute AS time_of_day, day * 1440 + hour * 60 + minute AS t,
         day * 10000 + hour * 100 + minute AS sort_key,
         CASE WHEN ((day % 7) + 7) % 7 IN (5, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN hour < 5 THEN 0 WHEN hour < 9 THEN 1 WHEN hour < 12 THEN 2 WHEN hour < 15 THEN 3 ELSE 4 END
           AS tod_bucket
  FROM feat0
),
feat AS (
  SELECT f.*, l.demand AS lag_96 FROM feat1 f LEFT JOIN feat1 l ON l.geohash = f.geohash AND l.t = f.t - 1440
)"""

FOLDS_SQL = """,
lab AS (SELECT *, row_number() OVER (ORDER BY sort_key, "Index") - 1 AS pos FROM feat WHERE split = 'train'),
nn AS (SELECT count(*) AS n, count(*) // 6 AS s FROM lab),
fr AS (
  SELECT l.*, CAST(f.range AS BIGINT) AS fold,
         CASE WHEN l.pos < nn.n - 5 * nn.s + f.range * nn.s THEN 'train' ELSE 'val' END AS role
  FROM lab l, nn, range(5) f
  WHERE l.pos < nn.n - 5 * nn.s + (f.range + 1) * nn.s
  UNION ALL
  SELECT t.*, -1 AS pos, CAST(f.range AS BIGINT) AS fold, 'test' AS role FROM feat t, range(5) f WHERE t.split = 'test'
)"""

FULL_SQL = """,
fr AS (
  SELECT *, CAST(-1 AS BIGINT) AS fold, CASE WHEN split = 'train' THEN 'train' ELSE 'test' END AS role FROM feat
)"""


def _keys_eq(keys, a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def _encode_sql(specs, with_extras: bool) -> str:
    """Encodings over ``fr`` (fold, role) rows: one SELECT with joined sketches."""
    ctes = ["fit AS (SELECT * FROM fr WHERE role = 'train')",
            "gstat AS (SELECT fold, avg(demand) AS gm, median(demand) AS gmed, stddev_samp(demand) AS gsd "
            "FROM fit GROUP BY fold)"]
    cols, joins = [], []
    for i, (keys, prefix) in enumerate(specs):
        kl = ", ".join(keys)
        ctes.append(f"s{i} AS (SELECT fold, {kl}, count(*) AS n, sum(demand) AS s, median(demand) AS md "
                    f"FROM fit GROUP BY fold, {kl})")
        joins.append(f"LEFT JOIN s{i} ON s{i}.fold = r.fold AND {_keys_eq(keys, f's{i}', 'r')}")
        loo_med = (f"(SELECT median(x.demand) FROM fit x WHERE x.fold = r.fold AND {_keys_eq(keys, 'x', 'r')} "
                   f"AND x.\"Index\" <> r.\"Index\")")
        cols.append(f"""CASE WHEN r.role = 'train' THEN
             (CASE WHEN s{i}.n > 1 THEN (s{i}.s - r.demand) / (s{i}.n - 1) ELSE gstat.gm END)
           ELSE coalesce(s{i}.s / s{i}.n, gstat.gm) END AS {prefix}_mean""")
        cols.append(f"""CASE WHEN r.role = 'train' THEN
             (CASE WHEN s{i}.n IS NULL OR s{i}.n <= 1 THEN gstat.gmed WHEN s{i}.n <= 20 THEN {loo_med}
                   ELSE s{i}.md END)
           ELSE coalesce(s{i}.md, gstat.gmed) END AS {prefix}_med""")
    extra_cols = []
    if with_extras:
        ctes.append("rt AS (SELECT fold, RoadType, sum(demand) AS s, count(*) AS n FROM fit GROUP BY ALL)")
        ctes.append("ghc AS (SELECT fold, geohash, CAST(count(*) AS DOUBLE) AS c FROM fit GROUP BY ALL)")
        ctes.append("ghcf AS (SELECT fold, avg(c) AS fb FROM ghc GROUP BY fold)")
        ctes.append("ghs AS (SELECT fold, geohash, hour, stddev_samp(demand) AS sd FROM fit GROUP BY ALL)")
        ctes.append("""per AS (SELECT geohash, hour, avg(CASE WHEN day >= 12 THEN demand END) AS tg,
                               avg(CASE WHEN day < 12 THEN demand END) AS rf
                        FROM feat WHERE split = 'train' AND demand IS NOT NULL GROUP BY ALL)""")
        ctes.append("""sc AS (SELECT geohash, avg(least(greatest(tg / greatest(rf, 1e-6), 0.2), 5.0)) AS scale
                       FROM per WHERE tg IS NOT NULL AND rf IS NOT NULL GROUP BY geohash)""")
        ctes.append("scm AS (SELECT avg(scale) AS ms FROM sc)")
        joins += ["LEFT JOIN rt ON rt.fold = r.fold AND rt.RoadType = r.RoadType",
                  "LEFT JOIN ghc ON ghc.fold = r.fold AND ghc.geohash = r.geohash",
                  "LEFT JOIN ghcf ON ghcf.fold = r.fold",
                  "LEFT JOIN ghs ON ghs.fold = r.fold AND ghs.geohash = r.geohash AND ghs.hour = r.hour",
                  "LEFT JOIN sc ON sc.geohash = r.geohash", "CROSS JOIN scm"]
        extra_cols = ["coalesce((rt.s + 10 * gstat.gm) / (rt.n + 10), gstat.gm) AS te_roadtype",
                      "coalesce(ghc.c, ghcf.fb) AS gh_count",
                      "coalesce(ghs.sd, gstat.gsd) AS gh_hr_std",
                      "r.lag_96 AS lag_96",
                      "CASE WHEN r.day < 12 THEN 1.0 ELSE coalesce(sc.scale, scm.ms) END AS gh_day49_scale"]
    body = ("SELECT r.\"Index\", r.fold, r.role,\n  " + ",\n  ".join(cols + extra_cols)
            + "\nFROM fr r LEFT JOIN gstat ON gstat.fold = r.fold\n" + "\n".join(joins))
    return ",\n" + ",\n".join(ctes) + f",\nencoded AS ({body})\n"


def _final_select(cols) -> str:
    return ("SELECT \"Index\", fold, role, " + ", ".join(f"{rsql(c)} AS {c}" for c in cols) + " FROM encoded")


def _feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R1 materialised once per session and data folder (reliable checkpoint)."""
    return materialized_features(spark, sf_dir, SPEC)


@query("loo_target_encoding", "A5 A6 W5 W6 W7 J2 J3 M6",
       _panel_sql(FEAT_SQL, FULL_SQL.lstrip(",\n")) + _encode_sql(LOO_TE_SPECS, False)
       + _final_select(LOO_TE_COLS))
def q_loo_target_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8 LOO mean/median encodings: labelled rows leave themselves out, unlabelled rows use the maps."""
    rows = full_rows(_feature_rows(spark, sf_dir), SPEC)
    out = encode_rows(rows, "demand", loo_specs=LOO_TE_SPECS, folds=[-1])
    return rounded(out.select("Index", "fold", "role", *LOO_TE_COLS), LOO_TE_COLS)


@query("group_sketch", "A5 A6 W6",
       _panel_sql(FEAT_SQL) + f""",
lab AS (SELECT * FROM feat WHERE split = 'train')
SELECT geohash, hour, CAST(count(*) AS BIGINT) AS n, {rsql('sum(demand)')} AS sum_y,
       {rsql('avg(demand)')} AS mean_y, {rsql('median(demand)')} AS median_y
FROM lab GROUP BY geohash, hour""")
def q_group_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (cell, hour) count, sum, mean and exact median of the labelled target."""
    from panelcast.operators.orderstats import median_ranks, order_stats
    from panelcast.operators.encode import group_median
    lab = _feature_rows(spark, sf_dir).where(F.col("split") == "train")
    st = order_stats(lab, ["geohash", "hour"], "demand", median_ranks(), with_sum=True)
    out = st.select("geohash", "hour", F.col("_n").cast("bigint").alias("n"), F.col("_sum").alias("sum_y"),
                    (F.col("_sum") / F.col("_n")).alias("mean_y"),
                    group_median(F.col("_n"), F.col("_lo"), F.col("_mid")).alias("median_y"))
    return rounded(out, ["sum_y", "mean_y", "median_y"])


ENC_COLS = ("te_roadtype",) + LOO_TE_COLS + ("gh_count", "gh_hr_std", "lag96_dev", "gh_day49_scale")


@query("fold_encodings", "R2 V1 T1 W7 A7 A11 A12 P16 P17 J7",
       _panel_sql(FEAT_SQL, FOLDS_SQL.lstrip(",\n")) + _encode_sql(LOO_TE_SPECS, True)
       + ", enc2 AS (SELECT *, lag_96 - te_gh_tod_mean AS lag96_dev FROM encoded)\n"
       + "SELECT \"Index\", fold, role, " + ", ".join(f"{rsql(c)} AS {c}" for c in ENC_COLS) + " FROM enc2")
def q_fold_encodings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All fold-aware encodings for 5 forward-chaining folds in one plan (train/val/test roles)."""
    feats = _feature_rows(spark, sf_dir)
    rows = fold_rows(feats, SPEC, 5, columns=encoding_inputs(SPEC), explode=False)
    out = add_all_encodings(rows, SPEC, scale=cross_period_scale(feats, SPEC), folds=range(5))
    return rounded(out.select("Index", "fold", "role", *ENC_COLS), ENC_COLS)


@query("smoothed_roadtype_te", "A7",
       _panel_sql(FEAT_SQL, FULL_SQL.lstrip(",\n")) + f""",
fit AS (SELECT * FROM fr WHERE role = 'train'),
g AS (SELECT avg(demand) AS gm FROM fit),
rt AS (SELECT RoadType, sum(demand) AS s, count(*) AS n FROM fit GROUP BY RoadType)
SELECT "Index", {rsql('coalesce((rt.s + 10 * g.gm) / (rt.n + 10), g.gm)')} AS te_roadtype
FROM fr LEFT JOIN rt USING (RoadType), g""")
def q_smoothed_roadtype_te(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bayesian-smoothed RoadType mean (alpha = 10) fitted on all labelled rows."""
    rows = full_rows(_feature_rows(spark, sf_dir), SPEC)
    return rounded(smoothed_encode(rows, ["RoadType"], "te_roadtype", "demand", "Index")
                   .select("Index", "te_roadtype"), ["te_roadtype"])


_GRT = ", ".join(f"{p}_mean" for _, p in GLOBAL_RT_SPECS)


@query("global_roadtype_te", "A10 W8",
       _panel_sql(FEAT_SQL, FOLDS_SQL.lstrip(",\n")) + """,
labg AS (SELECT * FROM feat WHERE split = 'train'),
""" + ",\n".join(
           f"g{i} AS (SELECT {', '.join(k)}, sum(demand) AS gs, count(demand) AS gc FROM labg GROUP BY ALL),\n"
           f"gg{i} AS (SELECT sum(gs) / sum(gc) AS gg FROM g{i})" for i, (k, _) in enumerate(GLOBAL_RT_SPECS)) + """
SELECT r."Index", r.fold, r.role, """ + ", ".join(
           rsql(f"CASE WHEN r.role = 'train' THEN (CASE WHEN g{i}.gc > 1 THEN (g{i}.gs - r.demand) / (g{i}.gc - 1) "
                f"ELSE gg{i}.gg END) ELSE coalesce(g{i}.gs / g{i}.gc, gg{i}.gg) END") + f" AS {p}_mean"
           for i, (_, p) in enumerate(GLOBAL_RT_SPECS)) + "\nFROM fr r " + " ".join(
           f"LEFT JOIN g{i} ON {_keys_eq(k, f'g{i}', 'r')} CROSS JOIN gg{i}" for i, (k, _) in enumerate(GLOBAL_RT_SPECS)))
def q_global_roadtype_te(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Global RoadType x time means with the per-row LOO correction, for every fold row."""
    feats = _feature_rows(spark, sf_dir)
    rows = fold_rows(feats, SPEC, 5)
    lab = feats.where(F.col("split") == "train")
    parts = [global_loo_encode(rows, global_key_stats(lab, list(k), "demand"), list(k), f"{p}_mean", "demand",
                               "Index") for k, p in GLOBAL_RT_SPECS]
    out = merge_encodings(rows.select("Index", "fold", "role"), parts, "Index")
    cols = [f"{p}_mean" for _, p in GLOBAL_RT_SPECS]
    return rounded(out, cols)


@query("row_fallback_lookup", "J4",
       _panel_sql(FEAT_SQL) + f""",
lab AS (SELECT * FROM feat WHERE split = 'train' AND day < 12),
m AS (SELECT RoadType, hour, avg(demand) AS v FROM lab GROUP BY ALL),
rtm AS (SELECT RoadType, avg(demand) AS rv FROM lab GROUP BY ALL),
g AS (SELECT avg(demand) AS gv FROM lab)
SELECT f."Index", {rsql('coalesce(m.v, rtm.rv, g.gv)')} AS te_rt_hr
FROM feat f LEFT JOIN m USING (RoadType, hour) LEFT JOIN rtm USING (RoadType), g""")
def q_row_fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(RoadType, hour) mean fitted on early days; unseen keys fall back to the row's RoadType mean, then global."""
    feats = _feature_rows(spark, sf_dir)
    lab = feats.where((F.col("split") == "train") & (F.col("day") < 12))
    m = lab.groupBy("RoadType", "hour").agg(F.avg("demand").alias("v"))
    rtm = lab.groupBy("RoadType").agg(F.avg("demand").alias("rv"))
    gv = lab.agg(F.avg("demand").alias("gv")).first()["gv"]
    rows = feats.join(rtm, "RoadType", "left")
    out = lookup_with_row_fallback(rows, m, ["RoadType", "hour"], "v", "rv", gv, "te_rt_hr")
    return rounded(out.select("Index", "te_rt_hr"), ["te_rt_hr"])


@query("cross_period_scale", "A8 J5 P15",
       _panel_sql(FEAT_SQL) + f""",
per AS (SELECT geohash, hour, avg(CASE WHEN day >= 12 THEN demand END) AS tg,
               avg(CASE WHEN day < 12 THEN demand END) AS rf
        FROM feat WHERE split = 'train' AND demand IS NOT NULL GROUP BY ALL)
SELECT geohash, {rsql('avg(least(greatest(tg / greatest(rf, 1e-6), 0.2), 5.0))')} AS scale
FROM per WHERE tg IS NOT NULL AND rf IS NOT NULL GROUP BY geohash""")
def q_cross_period_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-cell target/reference period ratio, averaged over hours present in both periods."""
    return rounded(cross_period_scale(_feature_rows(spark, sf_dir), SPEC), ["scale"])


@query("cross_period_scale_slot", "A8",
       _panel_sql(FEAT_SQL) + f""",
per AS (SELECT geohash, time_of_day, avg(CASE WHEN day >= 12 THEN demand END) AS tg,
               avg(CASE WHEN day < 12 THEN demand END) AS rf
        FROM feat WHERE split = 'train' AND demand IS NOT NULL GROUP BY ALL)
SELECT geohash, {rsql('avg(least(greatest(tg / greatest(rf, 1e-6), 0.2), 5.0))')} AS scale
FROM per WHERE tg IS NOT NULL AND rf IS NOT NULL GROUP BY geohash""")
def q_cross_period_scale_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ratio with the default slot, the exact time of day."""
    from dataclasses import replace
    return rounded(cross_period_scale(_feature_rows(spark, sf_dir), replace(SPEC, scale_slot="time_of_day")), ["scale"])


@query("scale_summary", "A9",
       _panel_sql(FEAT_SQL) + f""",
per AS (SELECT geohash, hour, avg(CASE WHEN day >= 12 THEN demand END) AS tg,
               avg(CASE WHEN day < 12 THEN demand END) AS rf
        FROM feat WHERE split = 'train' AND demand IS NOT NULL GROUP BY ALL),
sc AS (SELECT geohash, avg(least(greatest(tg / greatest(rf, 1e-6), 0.2), 5.0)) AS scale
       FROM per WHERE tg IS NOT NULL AND rf IS NOT NULL GROUP BY geohash)
SELECT CAST(count(*) AS BIGINT) AS cells, {rsql('avg(scale)')} AS mean_scale,
       {rsql('median(scale)')} AS median_scale FROM sc""")
def q_scale_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of cells, mean and median of the cross-period scale."""
    s = scale_summary(cross_period_scale(_feature_rows(spark, sf_dir), SPEC))
    return rounded(s, ["mean_scale", "median_scale"])


@query("fold_report", "T1 V1 W9 R4",
       _panel_sql(FEAT_SQL, FOLDS_SQL.lstrip(",\n")) + """
SELECT fold, role, CAST(count(*) AS BIGINT) AS rows,
       printf('day%d %02d:%02d', min(sort_key) // 10000, (min(sort_key) % 10000) // 100, min(sort_key) % 100) AS first,
       printf('day%d %02d:%02d', max(sort_key) // 10000, (max(sort_key) % 10000) // 100, max(sort_key) % 100) AS last
FROM fr WHERE role <> 'test' GROUP BY fold, role""")
def q_fold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and first/last (day, H:M) of every fold's train and validation part."""
    feats = _feature_rows(spark, sf_dir)
    rows = fold_rows(feats, SPEC, 5, include_test=False)
    return fold_report(rows)


@query("temporal_positions", "T1 P8",
       _panel_sql(FEAT_SQL) + """
SELECT "Index", CAST(row_number() OVER (ORDER BY sort_key, "Index") - 1 AS BIGINT) AS pos
FROM feat WHERE split = 'train'""")
def q_temporal_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stable global temporal position of every labelled row (ties by row id)."""
    lab = _feature_rows(spark, sf_dir).where(F.col("split") == "train")
    return temporal_positions(lab, SPEC).select("Index", "pos")


@query("group_folds", "V2",
       _panel_sql(FEAT_SQL) + """,
cells AS (SELECT geohash, dense_rank() OVER (ORDER BY geohash) - 1 AS code FROM (SELECT DISTINCT geohash FROM feat))
SELECT CAST(c.code % 5 AS BIGINT) AS fold, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT f.geohash) AS BIGINT) AS cells
FROM feat f JOIN cells c USING (geohash) WHERE f.split = 'train' GROUP BY ALL""")
def q_group_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds by cell (rank of the cell mod 5): rows and cells per fold."""
    feats = _feature_rows(spark, sf_dir).where(F.col("split") == "train")
    g = group_folds(feats, "geohash_le", 5)
    return g.groupBy("fold").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                 F.count_distinct("geohash").cast("bigint").alias("cells"))


@query("time_holdout", "V3",
       _panel_sql(FEAT_SQL) + """
SELECT CASE WHEN t <= 20 * 1440 THEN 'train' ELSE 'test' END AS role, CAST(count(*) AS BIGINT) AS rows,
       CAST(min(t) AS BIGINT) AS t_min, CAST(max(t) AS BIGINT) AS t_max
FROM feat WHERE split = 'train' GROUP BY ALL""")
def q_time_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out by time: labelled rows up to day 20 train, later ones test."""
    feats = _feature_rows(spark, sf_dir).where(F.col("split") == "train")
    h = time_holdout(feats, "t", 20 * 1440)
    return h.groupBy("role").agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                                 F.min("t").cast("bigint").alias("t_min"), F.max("t").cast("bigint").alias("t_max"))


@query("target_share_folds", "V4",
       _panel_sql(FEAT_SQL, FOLDS_SQL.lstrip(",\n")) + """,
pick AS (SELECT *, day >= 12 AND "Index" % 4 = 0 AS picked FROM fr WHERE role <> 'test'),
moved AS (SELECT DISTINCT "Index" FROM pick WHERE picked AND role = 'val'),
final AS (
  SELECT fold, role FROM pick WHERE NOT picked
  UNION ALL
  SELECT CAST(f.range AS BIGINT) AS fold, 'train' AS role FROM moved, range(5) f
)
SELECT fold, role, CAST(count(*) AS BIGINT) AS rows FROM final GROUP BY ALL""")
def q_target_share_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward folds where every 4th target-period row trains in all folds instead of validating."""
    feats = _feature_rows(spark, sf_dir)
    rows = fold_rows(feats, SPEC, 5, include_test=False)
    v4 = with_target_share(rows, "day", 12, "Index", 4, 5)
    return v4.groupBy("fold", "role").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
