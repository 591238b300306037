"""R2: every fold-aware encoding on top of the base features, for all folds in one plan."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.crossperiod import lag_deviation, period_scale, scale_feature
from panelcast.operators.encode import MEMBERS, encode_rows, global_key_stats, global_loo_encode, merge_encodings, per_fold
from panelcast.operators.splits import (forward_chain_members, forward_chain_roles, full_fit_roles, sort_keyed, start_tests,
                                       temporal_positions, with_test_members, with_test_rows)
from panelcast.schema import (CROSSDAY_COLS, GLOBAL_RT_SPECS, LOO_TE_SPECS, SCALE_CLIP, SCALE_DENOM_FLOOR, SMOOTHED_TE_SPECS,
                              PanelSpec)


def cross_period_scale(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """A8 on ALL labelled rows (as the original pipeline does; see SURVEY D5)."""
    lab = features.where(F.col(spec.split) == spec.labelled)
    day = F.col(spec.day)
    return period_scale(lab, spec.entity, spec.scale_slot, spec.target, ref=day < spec.target_day,
                        target=day >= spec.target_day)


def keyed(specs, spec: PanelSpec) -> list[tuple]:
    """Group specs with the column names of ``spec`` in place of the default cell and road columns."""
    names = {"geohash": spec.entity, "RoadType": spec.road}
    return [(tuple(names.get(k, k) for k in keys), prefix) for keys, prefix in specs]


def encoding_inputs(spec: PanelSpec) -> list[str]:
    """The columns the fold encodings read (everything else can join back once, by row id)."""
    keys = {k for ks, _ in keyed(LOO_TE_SPECS + SMOOTHED_TE_SPECS + GLOBAL_RT_SPECS, spec) for k in ks}
    cols = [spec.row_id, spec.split, spec.target, spec.entity, spec.day, spec.clock, "hour", "lag_96",
            *sorted(keys)]
    return list(dict.fromkeys(cols))


def fold_scale(rows: DataFrame, spec: PanelSpec) -> DataFrame:
    """D5 option ``fit_on="fold"``: the cross-period scale from each fold's TRAINING rows only,
    so validation labels never enter it.  Result: (fold, entity, scale)."""
    fit = rows.where(F.col("role") == "train")
    day, y, e, slot = F.col(spec.day), F.col(spec.target), spec.entity, spec.scale_slot
    per = (fit.where(y.isNotNull()).groupBy("fold", e, slot)
           .agg(F.avg(F.when(day >= spec.target_day, y)).alias("_tgt"),
                F.avg(F.when(day < spec.target_day, y)).alias("_ref"))
           .where(F.col("_tgt").isNotNull() & F.col("_ref").isNotNull()))
    ratio = F.least(F.greatest(F.col("_tgt") / F.greatest(F.col("_ref"), F.lit(SCALE_DENOM_FLOOR)),
                               F.lit(SCALE_CLIP[0])), F.lit(SCALE_CLIP[1]))
    return per.groupBy("fold", e).agg(F.avg(ratio).alias("scale"))


def fold_scale_feature(rows: DataFrame, scale: DataFrame, spec: PanelSpec, out: str = "gh_day49_scale"):
    """P17 with a per-fold scale: 1.0 before the target period, else the fold's cell scale,
    else the fold's mean scale (a per-fold CASE, no join on the fold alone)."""
    mean = per_fold(scale.groupBy("fold").agg(F.avg("scale").alias("_m")), "_m")
    j = rows.join(scale.withColumnRenamed("scale", "_sc"), ["fold", spec.entity], "left")
    return (j.withColumn(out, F.when(F.col(spec.day) < spec.target_day, F.lit(1.0))
                         .otherwise(F.coalesce(F.col("_sc"), mean))).drop("_sc"))


def fold_rows(features: DataFrame, spec: PanelSpec, k: int = 5, include_test: bool = True,
              columns: list[str] | None = None, explode: bool = True) -> DataFrame:
    """T1 + V1: labelled rows exploded into (fold, train|val), unlabelled rows into (fold, test);
    with ``explode=False`` one row each, with the array ``members`` of its (fold, role) pairs.

    With ``columns`` only those columns are exploded (up to k+1 copies per row), so the wide
    feature table is not multiplied; ``attach_features`` joins it back once."""
    if columns is not None:
        features = features.select(*[c for c in columns if c in features.columns])
    lab = features.where(F.col(spec.split) == spec.labelled)
    order = ["sort_key", spec.row_id]
    # a row's folds depend on the rows that the folds start at, so only its place in the order goes through the sort
    positioned = temporal_positions(lab if explode else sort_keyed(lab, spec).select(*order), spec)
    n = positioned.count()
    starts = None if explode else start_tests(positioned, order, n, k)
    if starts is None:
        rows = (forward_chain_roles if explode else forward_chain_members)(positioned if explode else temporal_positions(lab, spec), n, k)
    else:
        block = sum((start.cast("int") for start in starts), F.lit(0))
        first, s = n - k * (n // (k + 1)), n // (k + 1)
        rows = forward_chain_members(sort_keyed(lab, spec).withColumn("pos", F.when(block > 0, first + (block - 1) * s).otherwise(0).cast("bigint")), n, k).drop("pos")
    if include_test:
        rows = (with_test_rows if explode else with_test_members)(rows, features.where(F.col(spec.split) == spec.unlabelled), k)
    return rows


def attach_features(encoded: DataFrame, features: DataFrame, spec: PanelSpec) -> DataFrame:
    """Join the wide feature columns back to narrow encoded fold rows (one join by row id)."""
    extra = [c for c in features.columns if c not in encoded.columns or c == spec.row_id]
    return encoded.join(features.select(*extra), spec.row_id)


def full_rows(features: DataFrame, spec: PanelSpec) -> DataFrame:
    """M6 mode: encode unlabelled rows from ALL labelled rows (fold = -1)."""
    return full_fit_roles(features.where(F.col(spec.split) == spec.labelled),
                          features.where(F.col(spec.split) == spec.unlabelled))


def add_all_encodings(rows: DataFrame, spec: PanelSpec = PanelSpec(), scale: DataFrame | None = None,
                      global_rt: bool = False, labelled: DataFrame | None = None,
                      fit_on: str = "all", folds: Sequence[int] | None = None, values: Sequence[str] = (),
                      keep: Sequence[str] = (), roles: Sequence[str] | None = None,
                      prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Smoothed RoadType TE, 8 LOO specs (mean + median), gh_count, gh_hr_std, lag96_dev,
    gh_day49_scale — and optionally the 2 global RoadType x time encodings (W8).  ``rows`` come
    exploded by fold or, cheaper, with ``members``; the result has one row per (row, fold).

    Of rows with ``members`` the features ``values`` can be had as one array of numbers that ``assemble`` reads (all but those
    of ``CROSSDAY_COLS``, which stay columns), with the target, the day, the row id and the columns ``keep`` beside it; and
    only the rows with one of ``roles``; ``prepare`` is applied to the rows before they are encoded."""
    y, rid, nested = spec.target, spec.row_id, MEMBERS in rows.columns
    cell_scale = nested and fit_on != "fold"

    def with_scale(d: DataFrame) -> DataFrame:
        return scale_feature(d, scale, spec.entity, spec.day, spec.target_day)

    options = {"cells": spec.entity, "lookup": with_scale if cell_scale else None, "roles": roles, "prepare": prepare} if nested else {}
    if values:
        kept = [rid, y, spec.day, "lag_96", *([CROSSDAY_COLS[1]] if cell_scale else [spec.entity]), *keep]
        options |= {"values": [c for c in values if c not in CROSSDAY_COLS], "names": ["te_gh_tod_mean"], "keep": list(dict.fromkeys(kept))}
    out = encode_rows(rows, y, loo_specs=keyed(LOO_TE_SPECS, spec), smoothed_specs=keyed(SMOOTHED_TE_SPECS, spec),
                      count_specs=[((spec.entity,), "gh_count")], std_specs=[((spec.entity, "hour"), "gh_hr_std")], folds=folds, **options)
    if global_rt:
        if labelled is None:
            raise ValueError("global_rt needs the labelled rows")
        parts = [global_loo_encode(out, global_key_stats(labelled, list(keys), y), list(keys), f"{prefix}_mean",
                                   y, rid) for keys, prefix in keyed(GLOBAL_RT_SPECS, spec)]
        out = merge_encodings(out, parts, rid)
    out = lag_deviation(out)
    if fit_on == "fold":                       # D5 option: scale from each fold's training rows
        return fold_scale_feature(out, fold_scale(rows.select("*", F.inline(MEMBERS)) if nested else rows, spec), spec)
    return out if cell_scale else with_scale(out)
