"""Calendar / clock features as pure column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.schema import TOD_BUCKET_EDGES, PanelSpec

TWO_PI = 2 * math.pi


def clock_parts(clock: str | Column) -> tuple[Column, Column]:
    """``"H:M"`` -> (hour, minute) as BIGINT."""
    c = F.col(clock) if isinstance(clock, str) else clock
    parts = F.split(c, ":")
    return parts.getItem(0).cast("bigint"), parts.getItem(1).cast("bigint")


def abs_minute(day: Column, hour: Column, minute: Column) -> Column:
    """Absolute minute ``day*1440 + h*60 + m``."""
    return (day.cast("bigint") * 1440 + hour * 60 + minute).cast("bigint")


def sort_key(day: Column, hour: Column, minute: Column) -> Column:
    """Temporal sort key ``day*10000 + h*100 + m``."""
    return (day.cast("bigint") * 10000 + hour * 100 + minute).cast("bigint")


def tod_bucket(hour: Column, edges=TOD_BUCKET_EDGES) -> Column:
    """Number of edges <= hour (left-closed bins), 0..len(edges)."""
    out = F.lit(0)
    for e in edges:
        out = out + F.when(hour >= e, 1).otherwise(0)
    return out.cast("bigint")


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """P5: (sin, cos) of ``2*pi*value/period``."""
    angle = F.lit(TWO_PI) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def add_time_features(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """P1-P8 on a panel: hour, minute, time_of_day, day_mod7, is_weekend, cyclic pairs,
    tod_bucket and the absolute minute ``t``."""
    hour, minute = clock_parts(spec.clock)
    df = df.withColumns({"hour": hour, "minute": minute})
    h, m, d = F.col("hour"), F.col("minute"), F.col(spec.day)
    df = df.withColumns({
        "time_of_day": (h * 60 + m).cast("bigint"),
        "day_mod7": F.pmod(d.cast("bigint"), F.lit(7)).cast("bigint"),
        "t": abs_minute(d, h, m),
    })
    sh, ch = cyclic(h, 24)
    st, ct = cyclic(F.col("time_of_day"), 1440)
    sd, cd = cyclic(F.col("day_mod7"), 7)
    return df.withColumns({
        "is_weekend": F.col("day_mod7").isin(5, 6).cast("bigint"),
        "sin_hour": sh, "cos_hour": ch, "sin_tod": st, "cos_tod": ct, "sin_dow": sd, "cos_dow": cd,
        "tod_bucket": tod_bucket(h),
    })


def slot_datetime(day: Column, hour: Column, minute: Column, anchor: str = "2024-01-01 00:00:00") -> Column:
    """A real datetime for (day, H:M): ``anchor + day days + h hours + m minutes``.

    Built from the day count rather than by parsing ``"day H:M"`` text, which would read
    the day number as a year (see SURVEY D7)."""
    return F.lit(anchor).cast("timestamp_ntz") + F.make_dt_interval(day.cast("int"), hour.cast("int"),
                                                                     minute.cast("int"))


def log1p_target(col: str | Column) -> Column:
    """``log1p`` view of the target."""
    return F.log1p(F.col(col) if isinstance(col, str) else col)
