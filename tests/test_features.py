"""Imputation, geohash, codes, time features."""

import pytest
from pyspark.sql import functions as F

from panelcast.functions.geohash import decode_center
from panelcast.functions.timefeat import add_time_features, tod_bucket
from panelcast.operators.impute import group_mode, impute_from_map, unambiguous_map
from panelcast.operators.indexer import apply_codes, code_tables


def test_ambiguous_road(spark):
    rows = [("a", "Highway", "train"), ("a", None, "train"), ("b", "Local", "train"), ("b", "Arterial", "train"),
            ("b", None, "test"), ("c", None, "train"), ("d", None, "test")]
    df = spark.createDataFrame(rows, "geohash string, RoadType string, split string")
    m = unambiguous_map(df.where(F.col("split") == "train"), "geohash", "RoadType")
    out = impute_from_map(df, m, "geohash", "RoadType").collect()
    got = [(r["geohash"], r["RoadType"], r["roadtype_was_missing"]) for r in out]
    assert ("a", "Highway", 1) in got            # unambiguous cell fills
    assert ("b", "Missing", 1) in got            # two RoadTypes -> Missing
    assert ("c", "Missing", 1) in got            # only NULL known
    assert ("d", "Missing", 1) in got            # unseen in train


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "y"), ("a", "x"), ("a", None), ("a", None), ("a", None)],
                               "g string, v string")
    assert group_mode(df, ["g"], "v").first()["v"] == "x"


def test_geohash_decode(spark):
    df = spark.createDataFrame([("ezs42",), ("a",), ("i",), ("",), ("EZS42",), ("u4pruydqqvj",)], "g string")
    lat, lon = decode_center("g")
    out = {r["g"]: (r["lat"], r["lon"]) for r in df.select("g", lat.alias("lat"), lon.alias("lon")).collect()}
    assert out["ezs42"][0] == pytest.approx(42.605, abs=0.03) and out["ezs42"][1] == pytest.approx(-5.603, abs=0.03)
    assert out["u4pruydqqvj"][0] == pytest.approx(57.64911, abs=1e-4)
    assert out["u4pruydqqvj"][1] == pytest.approx(10.40744, abs=1e-4)
    for bad in ("a", "i", "", "EZS42"):
        assert out[bad] == (None, None)


def test_codes_ascending_with_null_text(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    out = apply_codes(df, code_tables(df, ["c"]), ["c"]).collect()
    codes = {r["c"]: r["c_le"] for r in out}
    assert codes == {"a": 0, "b": 1, None: 2}       # 'nan' sorts after 'a', 'b'


def test_time_features(spark):
    df = spark.createDataFrame([(5, "0:0"), (6, "23:45"), (12, "9:15")], "day long, timestamp string")
    r = {x["day"]: x for x in add_time_features(df).collect()}
    assert r[6]["time_of_day"] == 1425 and r[6]["is_weekend"] == 1 and r[5]["is_weekend"] == 1
    assert r[12]["tod_bucket"] == 2 and r[12]["t"] == 12 * 1440 + 555
    hours = spark.createDataFrame([(h,) for h in (0, 4, 5, 8, 9, 11, 12, 14, 15, 23)], "h long")
    assert [x["b"] for x in hours.select(tod_bucket(F.col("h")).alias("b")).collect()] == [0, 0, 1, 1, 2, 2, 3, 3, 4, 4]
