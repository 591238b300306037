"""Recursive lag filling — predictions for a slot become the lags of later slots.

The reference tried (and rejected) feeding its own predictions back as lags.  The dependency is
sequential in time by construction, but not one job per slot: the loop runs over DAYS.  For every
entity a day is an array of its slots; together with the last ``max(lags)`` values before the day it is
folded once with ``aggregate``, in which every unlabelled slot reads its lags from the values so far.
The state that goes on to the next day is that bounded array, one row per entity, checkpointed.
Every row of a day is read once; rows of an entity within one day are bounded by the slot grid.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import cut_lineage

#: lag columns by name (``lag_k``) -> prediction
Predictor = Callable[[Mapping[str, Column]], Column]


def linear_predictor(slope: float, intercept: float, x: str = "lag_1", fallback: str = "lag_96") -> Predictor:
    """pred = slope * x + intercept (x falls back to ``fallback``), floored at 0; NULL without either."""
    def predict(lag: Mapping[str, Column]) -> Column:
        line = F.lit(slope) * F.coalesce(lag[x], lag[fallback]) + F.lit(intercept)
        return F.when(line.isNotNull(), F.greatest(line, F.lit(0.0)))
    return predict


def recursive_fill(panel: DataFrame, entity: str, t: str, y: str, step: int, predict: Predictor,
                   lags: Sequence[int] = (1, 2, 4, 96), day_minutes: int = 1440) -> DataFrame:
    """Fill every unlabelled slot in time order; returns (entity, t, pred, step), ``step`` being the
    rank of the slot among the unlabelled ones.  (entity, t) must be unique on a grid of ``step``."""
    per_day, most = day_minutes // step, max(lags)
    rows = panel.select(entity, t, F.col(y).cast("double").alias("_y"), F.floor(F.col(t) / day_minutes).alias("_day"),
                        (F.pmod(F.col(t), F.lit(day_minutes)) / step).cast("int").alias("_q"))
    todo = rows.where(F.col("_y").isNull())
    span = todo.agg(F.min("_day").alias("lo"), F.max("_day").alias("hi")).first()
    if span["lo"] is None:                       # nothing to fill
        return todo.select(entity, t, F.col("_y").alias("pred"), F.lit(0).alias("step"))
    # values before the first day to fill: the last ``most`` slots of every entity
    start = span["lo"] * day_minutes
    at = ((F.col(t) - F.lit(start)) / step + most).cast("int")
    seen = (rows.where((F.col(t) < start) & (F.col(t) >= start - most * step))
            .groupBy(entity).agg(F.map_from_entries(F.collect_list(F.struct(at.alias("k"), F.col("_y").alias("v")))).alias("_m")))
    everyone = todo.select(entity).distinct()
    blank = F.create_map().cast("map<int,double>")
    known = F.coalesce("_m", blank)
    state = cut_lineage(everyone.join(seen, entity, "left").select(
        entity, F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: known[k]).alias("_past")))
    outs: list[DataFrame] = []
    for day in range(int(span["lo"]), int(span["hi"]) + 1):
        # slot -> (has a row, its label), one row per entity and day
        today = (rows.where(F.col("_day") == day).groupBy(entity)
                 .agg(F.map_from_entries(F.collect_list(F.struct("_q", F.struct(F.lit(True).alias("row"), F.col("_y").alias("y"))))).alias("_slots")))

        def fold(acc: Column, q: Column) -> Column:
            slot = F.col("_slots")[q]
            lag = {f"lag_{k}": F.element_at(acc, -k) for k in lags}
            value = F.when(slot["y"].isNotNull(), slot["y"]).when(slot["row"], predict(lag))
            return F.concat(acc, F.array(value.cast("double")))

        grid = F.sequence(F.lit(0), F.lit(per_day - 1))
        done = cut_lineage(state.join(today, entity, "left")
                           .withColumn("_all", F.aggregate(grid, F.col("_past"), fold)))
        state = done.select(entity, F.slice("_all", per_day + 1, most).alias("_past"))
        filled = done.select(entity, F.explode(F.filter(F.transform(grid, lambda q: F.struct(
            q.alias("q"), F.col("_slots")[q].alias("slot"), F.get("_all", q + most).alias("pred"))),
            lambda e: e["slot"]["row"] & e["slot"]["y"].isNull())).alias("_e"))
        outs.append(filled.select(entity, (F.lit(day * day_minutes) + F.col("_e.q") * step).cast(panel.schema[t].dataType).alias(t),
                                  F.col("_e.pred").alias("pred")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    # the time grid is small: its slots are numbered in one task
    ranks = todo.select(t).distinct().withColumn("step", (F.row_number().over(Window.orderBy(t)) - 1).cast("int"))
    return out.join(ranks, t).select(entity, t, "pred", "step")
