"""Panel description, input schemas and the feature-name registry."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class PanelSpec:
    """Names and parameters of a panel: one row per (entity, time slot).

    Every operator takes a spec instead of hard-coding column names, so the same
    code runs on the demand panel, the events fixture or the supplier fixture.
    """

    entity: str = "geohash"
    day: str = "day"
    clock: str = "timestamp"          # "H:M" text; parsed into hour / minute
    target: str = "demand"
    row_id: str = "Index"
    split: str = "split"
    labelled: str = "train"
    unlabelled: str = "test"
    step_minutes: int = 15
    categorical: tuple[str, ...] = ("RoadType", "Weather", "LargeVehicles", "Landmarks")
    numeric: tuple[str, ...] = ("NumberofLanes", "Temperature")
    road: str = "RoadType"
    # cross-period calibration: reference period = day < target_day, target period = day >= target_day
    target_day: int = 49
    scale_slot: str = "time_of_day"

    @property
    def le_cols(self) -> tuple[str, ...]:
        return self.categorical + (self.entity, "prefix5", "prefix4")


# Spark schema of the original labelled / unlabelled CSV files (demand absent in the unlabelled file).
PANEL_SCHEMA = T.StructType([
    T.StructField("Index", T.LongType(), False),
    T.StructField("geohash", T.StringType(), False),
    T.StructField("day", T.LongType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("demand", T.DoubleType(), True),
    T.StructField("RoadType", T.StringType(), True),
    T.StructField("NumberofLanes", T.DoubleType(), True),
    T.StructField("LargeVehicles", T.StringType(), True),
    T.StructField("Landmarks", T.StringType(), True),
    T.StructField("Temperature", T.DoubleType(), True),
    T.StructField("Weather", T.StringType(), True),
])

UNLABELLED_SCHEMA = T.StructType([f for f in PANEL_SCHEMA.fields if f.name != "demand"])

SUBMISSION_SCHEMA = T.StructType([
    T.StructField("Index", T.LongType(), False),
    T.StructField("demand", T.DoubleType(), True),
])


# ---------------------------------------------------------------------------
# Feature names, group specs and parameters that must equal the
# original pipeline so that a user's downstream code keeps working.
# ---------------------------------------------------------------------------
LAG_STEPS = (1, 2, 4, 96, 192)
ROLL_WINDOWS = (4, 96)
SHORT_LAG_COLS = ("lag_1", "lag_2", "lag_4")
TOD_BUCKET_EDGES = (5, 9, 12, 15)
TE_ALPHA = 10.0
LOO_EXACT_MAX = 20
SCALE_CLIP = (0.2, 5.0)
SCALE_DENOM_FLOOR = 1e-6
CALIBRATION_ALPHA = 0.2
NULL_CATEGORY = "nan"
MISSING_ROAD = "Missing"

LOO_TE_SPECS = (
    (("geohash",), "te_gh"),
    (("geohash", "hour"), "te_gh_hr"),
    (("geohash", "time_of_day"), "te_gh_tod"),
    (("geohash", "is_weekend"), "te_gh_we"),
    (("prefix5", "hour"), "te_p5_hr"),
    (("prefix5", "tod_bucket"), "te_p5_todb"),
    (("NumberofLanes", "hour"), "te_nl_hr"),
    (("LargeVehicles", "hour"), "te_lv_hr"),
)
SMOOTHED_TE_SPECS = ((("RoadType",), "te_roadtype"),)
GLOBAL_RT_SPECS = (
    (("RoadType", "hour"), "te_rt_hr_g"),
    (("RoadType", "time_of_day"), "te_rt_tod_g"),
)

BASE_COLS = (
    "day", "hour", "minute", "time_of_day", "day_mod7", "is_weekend", "tod_bucket",
    "sin_hour", "cos_hour", "sin_tod", "cos_tod", "sin_dow", "cos_dow",
    "lat", "lon",
    "NumberofLanes", "Temperature",
    "RoadType_le", "Weather_le", "LargeVehicles_le", "Landmarks_le",
    "geohash_le", "prefix5_le", "prefix4_le",
    "roadtype_hour_le", "weather_hour_le",
    "roadtype_was_missing",
)
LAG_COLS = tuple(f"lag_{k}" for k in LAG_STEPS) + tuple(f"roll_mean_{w}" for w in ROLL_WINDOWS) \
    + tuple(f"roll_std_{w}" for w in ROLL_WINDOWS)
LOO_TE_COLS = tuple(f"{p}_mean" for _, p in LOO_TE_SPECS) + tuple(f"{p}_med" for _, p in LOO_TE_SPECS)
SMOOTHED_TE_COLS = tuple(c for _, c in SMOOTHED_TE_SPECS)
STAT_COLS = ("gh_count", "gh_hr_std")
CROSSDAY_COLS = ("lag96_dev", "gh_day49_scale")
GLOBAL_RT_COLS = tuple(f"{p}_mean" for _, p in GLOBAL_RT_SPECS)
TE_COLS = LOO_TE_COLS + SMOOTHED_TE_COLS + STAT_COLS
NON_TE_COLS = BASE_COLS + LAG_COLS
ALL_COLS = BASE_COLS + LAG_COLS + TE_COLS
ALL_COLS_V2 = ALL_COLS + CROSSDAY_COLS
ABLATION_COLS = tuple(c for c in ALL_COLS_V2 if c not in SHORT_LAG_COLS)
CAT_FEATURE_NAMES = (
    "RoadType_le", "Weather_le", "LargeVehicles_le", "Landmarks_le",
    "geohash_le", "prefix5_le", "prefix4_le", "day_mod7", "is_weekend", "tod_bucket",
    "roadtype_hour_le", "weather_hour_le",
)

FEATURE_SETS = {
    "base": BASE_COLS,
    "non_te": NON_TE_COLS,
    "all": ALL_COLS,
    "all_v2": ALL_COLS_V2,
    "ablation": ABLATION_COLS,
}


def feature_set(name: str) -> list[str]:
    """Column list of a named feature set."""
    return list(FEATURE_SETS[name])
