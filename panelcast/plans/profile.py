"""The whole dataset profile as a dict of DataFrames (one per report table)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.timefeat import add_time_features
from panelcast.operators import profile as pf
from panelcast.schema import PanelSpec


def profile_report(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> dict[str, DataFrame]:
    """Shape, dtypes, nulls, target summary / deciles / histograms, cell-id profile, overlap,
    categories, dates, hours, duplicates and the temporal overlap class."""
    p = add_time_features(panel, spec)
    s, e, y = spec.split, spec.entity, spec.target
    lab = p.where(F.col(s) == spec.labelled)
    cols = [c for c in panel.columns if c != s]
    cats = [c for c in pf.PROFILE_CATEGORICALS if c in panel.columns]
    return {
        "shape": pf.shape_by_split(panel, s, {spec.unlabelled: [y]}),
        "dtypes": pf.dtypes_table(panel.drop(s)),
        "column_sets": pf.column_sets(panel.sparkSession, cols, [c for c in cols if c != y]),
        "nulls": pf.null_counts(panel, s, cols),
        "target": pf.target_summary(lab, y),
        "deciles": pf.deciles(lab, y),
        "histogram": pf.histogram(lab, y),
        "histogram_log1p": pf.histogram(lab, y, log1p=True),
        "cell_lengths": pf.length_counts(panel, s, e),
        "cells": pf.distinct_by_split(panel, s, e),
        "prefixes": pf.prefix_cardinality(lab, e),
        "cell_overlap": pf.set_overlap(panel, s, e, spec.labelled, spec.unlabelled),
        "value_counts": pf.value_counts(panel, s, cats, spec.labelled, spec.unlabelled),
        "unseen": pf.unseen_categories(panel, s, cats, spec.labelled, spec.unlabelled),
        "days": pf.day_sets(panel, s, spec.day, spec.labelled, spec.unlabelled),
        "hours": pf.hour_distribution(p, s, "hour", spec.labelled, spec.unlabelled),
        "duplicates": pf.duplicate_share(lab, [e, spec.day, spec.clock]),
        "overlap": pf.temporal_overlap(p, s, "t", spec.labelled, spec.unlabelled),
    }
