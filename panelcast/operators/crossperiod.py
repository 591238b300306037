"""Cross-period calibration and seasonal baselines.

The reference period and the target period are column predicates, the slot column is a
parameter: on the demand data they are ``day == 48``, ``day == 49`` and ``time_of_day``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.operators.orderstats import exact_median
from panelcast.operators.rows import combine_rows, scalar
from panelcast.schema import CALIBRATION_ALPHA, SCALE_CLIP, SCALE_DENOM_FLOOR


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL."""
    out = c
    if lo is not None:
        out = F.when(out.isNotNull(), F.greatest(out, F.lit(float(lo))))
    if hi is not None:
        out = F.when(out.isNotNull(), F.least(out, F.lit(float(hi))))
    return out


def period_scale(rows: DataFrame, entity: str, slot: str, y: str, ref: Column, target: Column,
                 clip_to: tuple[float, float] = SCALE_CLIP, floor: float = SCALE_DENOM_FLOOR) -> DataFrame:
    """Per entity, mean over slots of clip(target-period mean / max(ref-period mean, floor)).

    One grouped pass computes both period means per (entity, slot) with conditional
    averages (no self-join); only slots present in both periods count."""
    yy = F.col(y)
    per = (rows.where(yy.isNotNull()).groupBy(entity, slot)
           .agg(F.avg(F.when(target, yy)).alias("_tgt"), F.avg(F.when(ref, yy)).alias("_ref"))
           .where(F.col("_tgt").isNotNull() & F.col("_ref").isNotNull()))
    ratio = clip(F.col("_tgt") / F.greatest(F.col("_ref"), F.lit(floor)), *clip_to)
    return per.groupBy(entity).agg(F.avg(ratio).alias("scale"))


def scale_summary(scale: DataFrame) -> DataFrame:
    """Number of entities, unweighted mean and exact median of the scale."""
    mean = scale.agg(F.count(F.lit(1)).cast("bigint").alias("cells"), F.avg("scale").alias("mean_scale"))
    med = exact_median(scale, [], "scale", "median_scale")
    return combine_rows(mean, med)


def _mean_scale(scale: DataFrame):
    """The unweighted mean scale over entities (a one-row statistic)."""
    return F.lit(scalar(scale.agg(F.avg("scale").alias("_gscale")), "_gscale")).cast("double")


def scale_feature(rows: DataFrame, scale: DataFrame | None, entity: str, day: str, target_day: int,
                  out: str = "gh_day49_scale") -> DataFrame:
    """P17 + J7: 1.0 before the target period; else the entity's scale, else the mean scale."""
    if scale is None:
        return rows.withColumn(out, F.lit(1.0))
    g = _mean_scale(scale)
    j = rows.join(scale.select(entity, F.col("scale").alias("_sc")), entity, "left")
    return (j.withColumn(out, F.when(F.col(day) < target_day, F.lit(1.0))
                         .otherwise(F.coalesce(F.col("_sc"), g)))
            .drop("_sc"))


def calibrate(preds: DataFrame, scale: DataFrame, entity: str, pred: str,
              alpha: float = CALIBRATION_ALPHA, out: str | None = None) -> DataFrame:
    """M9: pred * (alpha*scale + 1 - alpha), scale from the entity lookup with the mean as
    fallback, clipped to [0, 1]."""
    g = _mean_scale(scale)
    j = preds.join(scale.select(entity, F.col("scale").alias("_sc")), entity, "left")
    mult = F.lit(alpha) * F.coalesce(F.col("_sc"), g) + F.lit(1.0 - alpha)
    return (j.withColumn(out or pred, clip(F.col(pred) * mult, 0.0, 1.0))
            .withColumn("multiplier", mult).drop("_sc"))


def lag_deviation(rows: DataFrame, lag: str = "lag_96", ref: str = "te_gh_tod_mean",
                  out: str = "lag96_dev") -> DataFrame:
    """Lag minus its encoded expectation; NULL if either side is NULL."""
    return rows.withColumn(out, F.col(lag) - F.col(ref))


def seasonal_fit(rows: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, intercept and R² of y on x (rows with both present)."""
    return rows.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                    F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).cast("bigint").alias("n"))


def seasonal_baseline(rows: DataFrame, x: str, slope: float | Column, intercept: float | Column,
                      out: str = "pred_seasonal") -> DataFrame:
    """pred = x*slope + intercept."""
    s = slope if isinstance(slope, Column) else F.lit(float(slope))
    i = intercept if isinstance(intercept, Column) else F.lit(float(intercept))
    return rows.withColumn(out, F.col(x) * s + i)


def median_ratio_baseline(fit_rows: DataFrame, apply_rows: DataFrame, entity: str, y: str, x: str,
                          out: str = "pred_ratio") -> DataFrame:
    """Per-entity exact median of y/x (x > 0) -> x * ratio."""
    r = fit_rows.where(F.col(x) > 0).withColumn("_ratio", F.col(y) / F.col(x))
    med = exact_median(r, [entity], "_ratio", "median_ratio")
    return apply_rows.join(med, entity, "left").withColumn(out, F.col(x) * F.col("median_ratio"))


def stack_ols(rows: DataFrame, y: str, x1: str, x2: str) -> DataFrame:
    """OLS of y on (x1, x2) in closed form from sample (co)variances."""
    s11, s22, s12 = F.var_samp(x1), F.var_samp(x2), F.covar_samp(x1, x2)
    s1y, s2y = F.covar_samp(x1, y), F.covar_samp(x2, y)
    det = s11 * s22 - s12 * s12
    b1 = F.try_divide(s22 * s1y - s12 * s2y, det)        # collinear regressors: NULL, not an error
    b2 = F.try_divide(s11 * s2y - s12 * s1y, det)
    cols = rows.where(F.col(y).isNotNull() & F.col(x1).isNotNull() & F.col(x2).isNotNull())
    st = cols.agg(b1.alias("b_pred"), b2.alias("b_lag"), F.avg(y).alias("_my"), F.avg(x1).alias("_m1"),
                  F.avg(x2).alias("_m2"), F.count(F.lit(1)).cast("bigint").alias("n"))
    return st.select("b_pred", "b_lag", (F.col("_my") - F.col("b_pred") * F.col("_m1")
                                          - F.col("b_lag") * F.col("_m2")).alias("intercept"), "n")
