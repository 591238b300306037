"""The base feature job — one lazy plan over both splits of the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.timefeat import add_time_features
from panelcast.operators.impute import collect_medians, fill_medians, numeric_medians, unambiguous_map
from panelcast.operators.indexer import apply_codes, cell_table, codes_from_pairs, interaction_codes, value_pairs
from panelcast.operators.lags import lag_block
from panelcast.schema import MISSING_ROAD, PanelSpec
from panelcast.session import cut_lineage
from panelcast.sources import fixtures as fx


def build_base_features(panel: DataFrame, spec: PanelSpec = PanelSpec(), with_lags: bool = True) -> DataFrame:
    """Time, spatial, imputation, label codes, interactions and the lag block.

    ``panel`` holds BOTH splits (``spec.split`` tells them apart) and the target is NULL on
    unlabelled rows, so every fit below (RoadType map, medians) sees labelled rows only and
    the lag block cannot read an unlabelled target.
    """
    p = add_time_features(panel, spec)
    e, road = spec.entity, spec.road
    has_road = road in p.columns
    labelled = p.where(F.col(spec.split) == spec.labelled)
    # Everything that depends only on the cell lives in ONE per-cell table (centre, prefixes,
    # cell/prefix codes, unambiguous RoadType), joined to the rows once.
    cells = cell_table(p, e)
    if has_road:
        rmap = unambiguous_map(labelled, e, road).withColumnRenamed(road, "_mapped_road")
        cells = cells.join(rmap, e, "left")
    cell_cols = [c for c in (e, "prefix5", "prefix4") if c in spec.le_cols]
    row_cols = [c for c in spec.le_cols if c in p.columns and c not in cell_cols]
    # One label-code fit for every column.  The imputed RoadType values come from the small
    # distinct (cell, RoadType) table, so the fit never needs the joined rows.
    pairs = value_pairs(cells, cell_cols)
    plain = [c for c in row_cols if c != road]
    if plain:
        pairs = pairs.unionByName(value_pairs(p, plain))
    if has_road and road in row_cols:
        imputed = (p.select(e, road).distinct().join(rmap, e, "left")
                   .select(F.coalesce(F.col(road), F.col("_mapped_road"), F.lit(MISSING_ROAD)).alias(road)))
        pairs = pairs.unionByName(value_pairs(imputed, [road]))
    codes = codes_from_pairs(pairs)
    medians = collect_medians(numeric_medians(labelled, spec.numeric)) if spec.numeric else {}
    lag_cols: list[str] = []
    if with_lags:
        # the panel's own columns go through the range exchange and the window, all others are added behind it
        own = list(dict.fromkeys([*panel.columns, "t"]))
        lagged = lag_block(p.select(*own), e, "t", spec.target, spec.step_minutes)
        lag_cols = [c for c in lagged.columns if c not in own]
        known = F.col(spec.row_id).isNotNull() & F.col(e).isNotNull() & F.col("t").isNotNull()      # a row without a key has no lags
        p = add_time_features(lagged.withColumns({c: F.when(known, F.col(c)) for c in lag_cols}), spec)
    p = p.join(apply_codes(cells, codes, cell_cols), e, "left")
    if has_road:
        p = (p.withColumn("roadtype_was_missing", F.col(road).isNull().cast("bigint"))
             .withColumn(road, F.coalesce(F.col(road), F.col("_mapped_road"), F.lit(MISSING_ROAD)))
             .drop("_mapped_road"))
    if spec.numeric:
        p = fill_medians(p, medians)
    # row-level categoricals have a handful of values each: tiny lookups (broadcast by AQE)
    if row_cols:
        p = apply_codes(p, codes, row_cols)
    if "RoadType_le" in p.columns and "Weather_le" in p.columns:
        p = interaction_codes(p)
    return p.select(*[c for c in p.columns if c not in lag_cols], *lag_cols)


def materialized_features(spark, sf_dir: str, spec: PanelSpec = fx.EVENTS_SPEC) -> DataFrame:
    """R1 on the events panel, written once and read back by every fold / encoding plan that the
    caller builds on the returned table (the lineage is cut at R1)."""
    panel = cut_lineage(fx.cell_panel(spark, sf_dir))      # the input table, stored once
    return cut_lineage(build_base_features(panel, spec))
