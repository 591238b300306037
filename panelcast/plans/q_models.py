"""Queries over prediction tables, metrics, checks and seasonal baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.timefeat import add_time_features

from panelcast.operators.blend import blend, complete_families, fold_average, oof_assembly
from panelcast.operators.checks import duplicate_keys, id_report, range_report, shape_report
from panelcast.operators.crossperiod import (calibrate, clip, median_ratio_baseline, seasonal_baseline,
                                             seasonal_fit, stack_ols)
from panelcast.operators.lags import lag_block
from panelcast.operators.rows import combine_rows, join_rows
from panelcast.operators.metrics import coverage, importance_share, inflation, lag_signal, r2, summary
from panelcast.plans.catalog import query, rnd, rounded, rsql
from panelcast.plans.encodings import cross_period_scale, fold_rows
from panelcast.plans.features import materialized_features
from panelcast.plans.q_encode import FEAT_SQL, FOLDS_SQL
from panelcast.plans.queries import _lag_sql, _panel_sql
from panelcast.sources import fixtures as fx
from panelcast.sources import predictions as pr

SPEC = fx.EVENTS_SPEC


def _preds_sql(*more: str, **kw) -> str:
    return fx.with_sql(fx.CELL_PANEL_SQL, pr.predictions_sql(**kw), *more)


@query("complete_families", "S9", _preds_sql() + """
SELECT family FROM preds GROUP BY family HAVING count(DISTINCT fold) = 5""")
def q_complete_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model families that have predictions from all 5 folds."""
    return complete_families(pr.predictions(spark, sf_dir), 5)


@query("fold_average", "M3 P15", _preds_sql() + f"""
SELECT row_id, family, {rsql('least(greatest(avg(pred), 0.0), 1.0)')} AS pred FROM preds GROUP BY ALL""")
def q_fold_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over folds per (row, family), clipped to [0, 1]."""
    return rounded(fold_average(pr.predictions(spark, sf_dir)), ["pred"])


@query("seed_average", "M13", _preds_sql(seeds=(42, 43, 44)) + f"""
SELECT row_id, family, {rsql('least(greatest(avg(pred), 0.0), 1.0)')} AS pred FROM preds GROUP BY ALL""")
def q_seed_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean over folds and seeds per (row, family)."""
    return rounded(fold_average(pr.predictions(spark, sf_dir, seeds=(42, 43, 44))), ["pred"])


BLEND_SQL = f"""fa AS (SELECT row_id, family, least(greatest(avg(pred), 0.0), 1.0) AS pred FROM preds GROUP BY ALL),
{pr.WEIGHTS_SQL},
bl AS (SELECT row_id, least(greatest(sum(weight * pred) / sum(weight), 0.0), 1.0) AS pred
       FROM fa JOIN weights USING (family) GROUP BY row_id)"""


@query("family_blend", "M8 M3 P15", _preds_sql(BLEND_SQL) + f"SELECT row_id, {rsql('pred')} AS pred FROM bl")
def q_family_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold-averaged families blended with normalised weights (a 0.7, b 0.3), clipped."""
    fa = fold_average(pr.predictions(spark, sf_dir))
    return rounded(blend(fa, pr.weights_table(spark)), ["pred"])


SCALE_SQL = """,
per AS (SELECT geohash, hour, avg(CASE WHEN day >= 12 THEN demand END) AS tg,
               avg(CASE WHEN day < 12 THEN demand END) AS rf
        FROM feat WHERE split = 'train' AND demand IS NOT NULL GROUP BY ALL),
sc AS (SELECT geohash, avg(least(greatest(tg / greatest(rf, 1e-6), 0.2), 5.0)) AS scale
       FROM per WHERE tg IS NOT NULL AND rf IS NOT NULL GROUP BY geohash),
scm AS (SELECT avg(scale) AS ms FROM sc)"""

CALIB_SQL = fx.with_sql(fx.CELL_PANEL_SQL, pr.predictions_sql(labelled_only=False).replace(
    "AS pred\n  FROM panel p,", "AS pred, p.split\n  FROM panel p,"), BLEND_SQL.replace(
    "FROM preds GROUP BY ALL", "FROM preds WHERE split = 'test' GROUP BY ALL"))
CALIB_SQL = CALIB_SQL[:-1] + ",\n" + FEAT_SQL.strip().lstrip(",") + SCALE_SQL + """,
cal AS (
  SELECT b.row_id AS "Index", least(greatest(b.pred * (0.2 * coalesce(sc.scale, scm.ms) + 0.8), 0.0), 1.0) AS demand
  FROM bl b JOIN panel p ON p."Index" = b.row_id LEFT JOIN sc ON sc.geohash = p.geohash, scm
)
"""


def blended_test(panel: DataFrame, weights: DataFrame) -> DataFrame:
    """(row_id, pred, geohash): the blended predictions of the unlabelled rows, found before the rows are
    multiplied by family and fold."""
    test = panel.where((F.col("split") == "test") & F.col("Index").isNotNull())
    bl = blend(fold_average(pr.prediction_table(test, labelled_only=False)), weights)
    return join_rows(bl, test.select(F.col("Index").alias("row_id"), "geohash"), ["row_id"])


def _calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = fx.cell_panel(spark, sf_dir)
    bl = blended_test(panel, pr.weights_table(spark))
    scale = cross_period_scale(add_time_features(panel), SPEC)   # needs cell, hour, day, target only
    cal = calibrate(bl, scale, "geohash", "pred", alpha=0.2)
    return cal.select(F.col("row_id").alias("Index"), F.col("pred").alias("demand"))


@query("calibrated_submission", "M9 J7 M8 S2 R6", CALIB_SQL + f"""SELECT "Index", {rsql('demand')} AS demand FROM cal""")
def q_calibrated_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled rows: blended predictions x (0.2*cell scale + 0.8), clipped — the submission table."""
    return rounded(_calibrated(spark, sf_dir), ["demand"])


@query("submission_checks", "Q1 Q2 Q3 Q4", CALIB_SQL + """,
ids AS (SELECT "Index" FROM panel WHERE split = 'test'),
o AS (SELECT "Index", count(*) AS n FROM cal GROUP BY "Index")
SELECT (SELECT CAST(count(*) AS BIGINT) FROM cal) AS rows,
       (SELECT CAST(count(*) AS BIGINT) FROM ids) AS expected_rows,
       TRUE AS columns_ok,
       (SELECT CAST(count(*) AS BIGINT) FROM ids WHERE "Index" NOT IN (SELECT "Index" FROM o)) AS missing_ids,
       (SELECT CAST(count(*) AS BIGINT) FROM o WHERE "Index" NOT IN (SELECT "Index" FROM ids)) AS extra_ids,
       (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM o WHERE n > 1) AS duplicate_ids,
       (SELECT bool_and(coalesce(demand BETWEEN 0 AND 1, FALSE)) FROM cal) AS in_range,
       (SELECT """ + rsql("avg(demand)") + """ FROM cal) AS mean""")
def q_submission_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape, id-set equality, [0,1] range and mean of the calibrated submission."""
    sub = _calibrated(spark, sf_dir)
    src = fx.cell_panel(spark, sf_dir).where(F.col("split") == "test")
    shape = shape_report(sub, src, ["Index", "demand"])
    ids = id_report(sub, src, "Index")
    rng = range_report(sub, "demand").select("in_range", rnd("mean").alias("mean"))
    return combine_rows(shape, ids, rng)


OOF_SQL = FEAT_SQL + FOLDS_SQL + """,
vr AS (SELECT "Index" AS row_id, fold FROM fr WHERE role = 'val'),
oof AS (
  SELECT l.row_id, l.y, pp.pred, pp.fold, pp.run FROM
    (SELECT "Index" AS row_id, demand AS y FROM feat WHERE split = 'train') l
    LEFT JOIN (SELECT p.row_id, p.fold, p.run, p.pred FROM preds p JOIN vr USING (row_id, fold)
               WHERE p.family = 'a') pp USING (row_id)
)"""


def _oof(spark: SparkSession, sf_dir: str, runs=("full",)) -> DataFrame:
    feats = materialized_features(spark, sf_dir, SPEC)
    narrow = ["Index", "split", "demand", "day", "timestamp"]
    lab = (feats.where((F.col("split") == "train") & F.col("Index").isNotNull())
           .select(F.col("Index").alias("row_id"), F.col("demand").alias("y"), F.explode(F.array(*map(F.lit, runs))).alias("run")))
    vr = (fold_rows(feats, SPEC, 5, include_test=False, columns=narrow).where(F.col("role") == "val")
          .select(F.col("Index").alias("row_id"), "fold"))
    preds = pr.predictions(spark, sf_dir, runs=runs).where(F.col("family") == "a")
    return oof_assembly(preds, vr, lab, "row_id", keep=["y"], by=["run"])


@query("oof_r2", "M2 A27", _preds_sql(OOF_SQL.lstrip(",")) + f"""
, per_fold AS (
  SELECT CAST(fold AS BIGINT) AS fold, count(*) AS n, sum((y - pred) * (y - pred)) AS sse,
         sum((y - (SELECT avg(y) FROM oof o2 WHERE o2.fold = oof.fold)) ^ 2) AS sst
  FROM oof WHERE pred IS NOT NULL GROUP BY fold
  UNION ALL
  SELECT CAST(-1 AS BIGINT), count(*), sum((y - pred) * (y - pred)),
         sum((y - (SELECT avg(y) FROM oof WHERE pred IS NOT NULL)) ^ 2)
  FROM oof WHERE pred IS NOT NULL
)
SELECT fold, {rsql('1 - sse / sst')} AS r2, CAST(n AS BIGINT) AS n FROM per_fold""")
def q_oof_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold predictions assembled from validation folds; R² per fold and overall (fold -1)."""
    o = _oof(spark, sf_dir).withColumnRenamed("oof", "pred")
    per = r2(o, "y", "pred", by=["fold"])
    allr = r2(o, "y", "pred").withColumn("fold", F.lit(-1))
    return rounded(per.unionByName(allr).select(F.col("fold").cast("bigint"), "r2", "n"), ["r2"])


@query("oof_coverage", "A28 A29", _preds_sql(OOF_SQL.lstrip(",")) + f"""
SELECT {rsql('avg(CASE WHEN pred IS NOT NULL THEN 1.0 ELSE 0.0 END)')} AS coverage,
       CAST(count(*) AS BIGINT) AS rows, {rsql('avg(pred)')} AS mean, {rsql('min(pred)')} AS min,
       {rsql('max(pred)')} AS max FROM oof""")
def q_oof_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of labelled rows with an OOF prediction, and the OOF prediction summary."""
    o = _oof(spark, sf_dir)
    c = coverage(o, "oof")
    s = summary(o, "oof").drop("n")
    return rounded(combine_rows(c, s),
                   ["coverage", "mean", "min", "max"])


@query("short_lag_inflation", "A31 M4", _preds_sql(OOF_SQL.lstrip(","), runs=("full", "ablation")) + f"""
, rr AS (SELECT run, 1 - sum((y - pred) ^ 2) / (count(*) * var_pop(y)) AS r2 FROM oof WHERE pred IS NOT NULL GROUP BY run)
SELECT {rsql("max(CASE WHEN run = 'full' THEN r2 END) - max(CASE WHEN run = 'ablation' THEN r2 END)")} AS inflation
FROM rr""")
def q_short_lag_inflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R²(full run) - R²(ablation run) over the OOF rows."""
    o = _oof(spark, sf_dir, runs=("full", "ablation"))
    return rounded(inflation(r2(o, "y", "oof", by=["run"])), ["inflation"])


@query("error_correlation", "A32", _preds_sql(f"""
fa AS (SELECT row_id, family, avg(pred) AS pred FROM preds GROUP BY ALL),
w AS (SELECT row_id, max(CASE WHEN family = 'a' THEN pred END) AS pa, max(CASE WHEN family = 'b' THEN pred END) AS pb
      FROM fa GROUP BY row_id)
SELECT {rsql('corr(p.demand - w.pa, p.demand - w.pb)')} AS err_corr
FROM w JOIN panel p ON p."Index" = w.row_id"""))
def q_error_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation between the residuals of families a and b (fold-averaged)."""
    panel = fx.cell_panel(spark, sf_dir)
    fa = fold_average(pr.prediction_table(panel), clip01=False)
    w = fa.groupBy("row_id").agg(F.max(F.when(F.col("family") == "a", F.col("pred"))).alias("pa"),
                                 F.max(F.when(F.col("family") == "b", F.col("pred"))).alias("pb"))
    j = w.join(panel.select(F.col("Index").alias("row_id"), "demand"), "row_id")
    return j.agg(rnd(F.corr(F.col("demand") - F.col("pa"), F.col("demand") - F.col("pb"))).alias("err_corr"))


IMP_FEATURES = ("hour", "time_of_day", "day_mod7", "tod_bucket", "NumberofLanes", "Temperature",
                "RoadType_le", "Weather_le", "geohash_le", "prefix5_le", "lat", "lon")


@query("importance_share", "A30 T3", _panel_sql(FEAT_SQL.replace(
    "e.prefix5,", "e.prefix5, coalesce(e.Temperature, (SELECT median(Temperature) FROM panel WHERE split = 'train')) AS Temperature,"),
    FOLDS_SQL.lstrip(",\n")).replace("feat0 AS (", "feat0 AS (").replace("FROM enc e, med", "FROM enc e, med") + """,
impt AS (""" + "\nUNION ALL\n".join(
    f"SELECT fold, '{c}' AS feature, abs(corr({c}, demand)) * 100 AS gain FROM fr WHERE role = 'train' GROUP BY fold"
    for c in ("hour", "time_of_day", "tod_bucket", "NumberofLanes", "Temperature")) + """),
m AS (SELECT feature, avg(gain) AS gain FROM impt GROUP BY feature)
SELECT feature, """ + rsql("gain") + " AS gain, " + rsql("gain / (SELECT sum(gain) FROM m) * 100") + """ AS pct
FROM m ORDER BY gain DESC, feature LIMIT 3""")
def q_importance_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-fold |corr(feature, target)| x 100 as gain; mean over folds, % of total, top 3."""
    feats = materialized_features(spark, sf_dir, SPEC)
    rows = fold_rows(feats, SPEC, 5, include_test=False).where(F.col("role") == "train")
    cols = ("hour", "time_of_day", "tod_bucket", "NumberofLanes", "Temperature")
    long = rows.groupBy("fold").agg(*[(F.abs(F.corr(c, "demand")) * 100).alias(c) for c in cols])
    imp = long.select("fold", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("gain"))
                                                   for c in cols])).alias("_f")).select("fold", "_f.*")
    top = importance_share(imp, top=3)
    return rounded(top, ["gain", "pct"])


SWEEP_SQL = OOF_SQL + """,
ft AS (SELECT fold, count(*) AS n_val FROM vr GROUP BY fold),
tr AS (SELECT range AS trial FROM range(40)),
tp AS (
  SELECT tr.trial, v.fold, l.demand AS y,
         least(greatest(l.demand * 0.8 + ((l."Index" * (v.fold + 3)) % 97) / 970.0 - 0.02 + tr.trial * 0.001, 0.0), 1.0) AS p
  FROM vr v JOIN feat l ON l."Index" = v.row_id, tr
),
fr2 AS (SELECT trial, fold, 1 - sum((y - p) ^ 2) / (count(*) * var_pop(y)) AS r2 FROM tp GROUP BY ALL),
sw AS (SELECT f.trial, f.fold, f.r2, (f.trial * 53 + f.fold * 17 + ft.n_val) % 8200 AS iters FROM fr2 f JOIN ft USING (fold)),
sc AS (SELECT trial, CASE WHEN max(iters) >= 7900 OR max(CASE WHEN fold = 4 THEN iters END) < 150 THEN 0.0
                          ELSE avg(r2) END AS score FROM sw GROUP BY trial)"""


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = materialized_features(spark, sf_dir, SPEC)
    vr = fold_rows(feats, SPEC, 5, include_test=False).where(F.col("role") == "val")
    from panelcast.plans.training import sweep_scores
    from panelcast.sources.predictions import sweep_table
    # every validation row once per trial: an explode, not a cross join
    tp = vr.select("fold", "Index", F.col("demand").alias("y"),
                   F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(39).cast("bigint"))).alias("trial"))
    tp = tp.withColumn("p", clip(F.col("y") * 0.8 + ((F.col("Index") * (F.col("fold") + 3)) % 97) / 970.0
                                 - 0.02 + F.col("trial") * 0.001, 0.0, 1.0))
    per = r2(tp, "y", "p", by=["trial", "fold"])
    nval = vr.groupBy("fold").agg(F.count(F.lit(1)).alias("n_val"))
    sw = sweep_table(per, nval)
    return sweep_scores(sw)


@query("sweep_scores", "M7", _preds_sql(SWEEP_SQL.lstrip(",")) + f"""
SELECT CAST(trial AS BIGINT) AS trial, {rsql('score')} AS score FROM sc""")
def q_sweep_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 trials x 5 folds: score = mean fold R², 0 if a fold hits the round ceiling or fold 4 stops early."""
    return rounded(_sweep(spark, sf_dir), ["score"])


@query("sweep_top5", "T4 M7", _preds_sql(SWEEP_SQL.lstrip(",")) + f"""
SELECT CAST(trial AS BIGINT) AS trial, {rsql('score')} AS score FROM sc ORDER BY score DESC, trial LIMIT 5""")
def q_sweep_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best trials of the sweep (ties by trial number)."""
    s = _sweep(spark, sf_dir)
    return rounded(s.orderBy(F.desc("score"), "trial").limit(5), ["score"])


@query("duplicate_keys", "Q5", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(count(*) AS BIGINT) AS n
FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def q_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_linenumber) pairs that are not unique in lineitem — the fail-fast check input."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("l_linenumber", F.col("l_linenumber").cast("bigint"))
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


# --- seasonal baselines on the dense panel (F2) -------------------------------
DENSE_LAG_SQL = fx.with_sql(fx.DENSE_PANEL_SQL, "dd AS (SELECT * FROM dense)") + ", dl AS (" + _lag_sql(
    "dd", "entity", "p.entity, p.slot, p.day, p.y, p.split", "y", 15).replace(
    "SELECT p.entity", "SELECT p.entity", 1) + ")\n"


def _dense_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = fx.dense_panel(spark, sf_dir)
    return lag_block(p, "entity", "t", "y", 15)


@query("seasonal_fit", "A33 M10", DENSE_LAG_SQL + f"""
, fit AS (SELECT regr_slope(y, lag_96) AS slope, regr_intercept(y, lag_96) AS intercept, regr_r2(y, lag_96) AS r2,
                 regr_count(y, lag_96) AS n FROM dl WHERE split = 'train' AND day >= 12)
SELECT {rsql('slope', 5)} AS slope, {rsql('intercept', 5)} AS intercept, {rsql('r2', 5)} AS r2, CAST(n AS BIGINT) AS n,
       (SELECT {rsql('avg(lag_96 * fit.slope + fit.intercept)', 5)} FROM dl WHERE split = 'test') AS mean_pred
FROM fit""")
def q_seasonal_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Linear fit of y on lag_96 over target-period labelled rows, applied to unlabelled rows."""
    d = _dense_lags(spark, sf_dir)
    fit = seasonal_fit(d.where((F.col("split") == "train") & (F.col("day") >= 12)), "y", "lag_96")
    row = fit.first()
    pred = seasonal_baseline(d.where(F.col("split") == "test"), "lag_96", row["slope"], row["intercept"])
    mp = pred.agg(rnd(F.avg("pred_seasonal"), 5).alias("mean_pred"))
    out = combine_rows(fit, mp)
    return out.select(rnd("slope", 5).alias("slope"), rnd("intercept", 5).alias("intercept"), rnd("r2", 5).alias("r2"),
                      "n", "mean_pred")


@query("median_ratio_baseline", "A34", DENSE_LAG_SQL + f"""
, mr AS (SELECT entity, median(y / lag_96) AS median_ratio FROM dl
         WHERE split = 'train' AND day >= 12 AND lag_96 > 0 AND y IS NOT NULL GROUP BY entity)
SELECT d.entity, d.slot, {rsql('d.lag_96 * mr.median_ratio')} AS pred_ratio
FROM dl d LEFT JOIN mr USING (entity) WHERE d.split = 'test'""")
def q_median_ratio_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-entity median of y / lag_96 (target period) times lag_96 on unlabelled rows."""
    d = _dense_lags(spark, sf_dir)
    fit = d.where((F.col("split") == "train") & (F.col("day") >= 12) & F.col("y").isNotNull())
    out = median_ratio_baseline(fit, d.where(F.col("split") == "test"), "entity", "y", "lag_96")
    return rounded(out.select("entity", "slot", "pred_ratio"), ["pred_ratio"])


@query("stack_ols", "M11", DENSE_LAG_SQL + """
, s AS (SELECT * FROM dl WHERE y IS NOT NULL AND roll_mean_4 IS NOT NULL AND lag_96 IS NOT NULL),
m AS (SELECT var_samp(roll_mean_4) AS s11, var_samp(lag_96) AS s22, covar_samp(roll_mean_4, lag_96) AS s12,
             covar_samp(roll_mean_4, y) AS s1y, covar_samp(lag_96, y) AS s2y, avg(y) AS my, avg(roll_mean_4) AS m1,
             avg(lag_96) AS m2, count(*) AS n FROM s),
b AS (SELECT (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b_pred,
             (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b_lag, my, m1, m2, n FROM m)
SELECT """ + rsql("b_pred", 4) + " AS b_pred, " + rsql("b_lag", 4) + " AS b_lag, " + rsql(
    "my - b_pred * m1 - b_lag * m2", 4) + " AS intercept, CAST(n AS BIGINT) AS n FROM b")
def q_stack_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OLS of y on (roll_mean_4 as the model prediction, lag_96) in closed form."""
    d = _dense_lags(spark, sf_dir).where(F.col("roll_mean_4").isNotNull())
    st = stack_ols(d, "y", "roll_mean_4", "lag_96")
    # two-regressor fits are ill-conditioned on small panels: compare 4 decimals
    return st.select(rnd("b_pred", 4).alias("b_pred"), rnd("b_lag", 4).alias("b_lag"),
                     rnd("intercept", 4).alias("intercept"), "n")


@query("lag_signal", "A36", DENSE_LAG_SQL + "SELECT " + ", ".join(
    f"{rsql(f'corr({c}, y)')} AS {c}_corr, {rsql(f'avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END)')} AS {c}_share"
    for c in ("lag_1", "lag_2", "lag_4", "lag_96", "lag_192")) + " FROM dl WHERE split = 'train'")
def q_lag_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of every lag with the target and the share of labelled rows where it exists."""
    d = _dense_lags(spark, sf_dir).where(F.col("split") == "train")
    lags = ("lag_1", "lag_2", "lag_4", "lag_96", "lag_192")
    out = lag_signal(d, "y", lags)
    return rounded(out, out.columns)
