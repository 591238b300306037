"""Fold-aware encodings: LOO semantics, fallbacks, leakage invariants."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators.crossperiod import period_scale
from panelcast.operators.encode import encode_all


def _rows(spark, data):
    return spark.createDataFrame(data, "row_id long, fold long, role string, k string, y double")


def _enc(rows, **kw):
    out = encode_all(rows, "y", "row_id", loo_specs=[(("k",), "te")], smoothed_specs=[(("k",), "sm")],
                     count_specs=[(("k",), "cnt")], std_specs=[(("k",), "sd")], **kw)
    return {(r["row_id"], r["fold"]): r.asDict() for r in out.collect()}


def test_loo_values_and_fallbacks(spark):
    data = [(1, 0, "train", "a", 1.0), (2, 0, "train", "a", 3.0), (3, 0, "train", "a", 8.0),
            (4, 0, "train", "b", 5.0),                      # n = 1 -> global fallback
            (5, 0, "val", "a", 100.0), (6, 0, "test", "z", None), (7, 0, "train", None, 2.0)]
    r = _enc(_rows(spark, data))
    ys = [1.0, 3.0, 8.0, 5.0, 2.0]
    gm, gmed = float(np.mean(ys)), float(np.median(ys))
    assert r[(1, 0)]["te_mean"] == pytest.approx((3 + 8) / 2) and r[(1, 0)]["te_med"] == pytest.approx(5.5)
    assert r[(2, 0)]["te_med"] == pytest.approx(4.5)
    assert r[(4, 0)]["te_mean"] == pytest.approx(gm) and r[(4, 0)]["te_med"] == pytest.approx(gmed)
    assert r[(5, 0)]["te_mean"] == pytest.approx(4.0) and r[(5, 0)]["te_med"] == pytest.approx(3.0)   # val: map
    assert r[(6, 0)]["te_mean"] == pytest.approx(gm)                  # unseen key
    assert r[(7, 0)]["te_mean"] == pytest.approx(gm)                  # NULL key never matches (D13)
    assert r[(5, 0)]["sm"] == pytest.approx((12 + 10 * gm) / (3 + 10))
    assert r[(5, 0)]["cnt"] == 3.0 and r[(6, 0)]["cnt"] == pytest.approx((3 + 1) / 2)
    assert r[(5, 0)]["sd"] == pytest.approx(float(np.std([1, 3, 8], ddof=1)))
    assert r[(4, 0)]["sd"] == pytest.approx(float(np.std(ys, ddof=1)))   # n = 1 -> global std


def test_own_label_and_val_labels_do_not_leak(spark):
    rng = np.random.default_rng(5)
    base = [(i, 0, "train", f"k{i % 4}", float(rng.random())) for i in range(40)]
    base += [(100 + i, 0, "val", f"k{i % 4}", float(rng.random())) for i in range(8)]
    r1 = _enc(_rows(spark, base))
    own = [(i, f, ro, k, (y + 50.0 if i == 3 else y)) for i, f, ro, k, y in base]
    r2 = _enc(_rows(spark, own))
    assert r1[(3, 0)]["te_mean"] == pytest.approx(r2[(3, 0)]["te_mean"])   # own y excluded (n >= 2)
    assert r1[(3, 0)]["te_med"] == pytest.approx(r2[(3, 0)]["te_med"])    # n = 10 <= 20: exact LOO
    hidden = [(i, f, ro, k, (y + 50.0 if ro == "val" else y)) for i, f, ro, k, y in base]
    r3 = _enc(_rows(spark, hidden))
    for key, row in r1.items():                                          # validation labels never used
        for c in ("te_mean", "te_med", "sm", "cnt", "sd"):
            assert row[c] == pytest.approx(r3[key][c]), (key, c)


def test_folds_are_independent(spark):
    data = [(1, 0, "train", "a", 1.0), (2, 0, "train", "a", 2.0), (1, 1, "train", "a", 1.0),
            (2, 1, "val", "a", 2.0), (3, 1, "train", "a", 9.0)]
    r = _enc(_rows(spark, data))
    assert r[(1, 0)]["te_mean"] == 2.0 and r[(1, 1)]["te_mean"] == 9.0 and r[(2, 1)]["te_mean"] == 5.0


def test_ratio_clip(spark):
    """ratio_clip fixture: reference mean 0 uses the 1e-6 floor; ratios clipped to [0.2, 5]."""
    data = [("a", 1, 0, 0.0), ("a", 1, 1, 0.5),            # ref 0 -> 0.5/1e-6 -> 5
            ("b", 1, 0, 1.0), ("b", 1, 1, 0.01),           # 0.01 -> 0.2
            ("c", 1, 0, 0.01), ("c", 1, 1, 1.0),           # 100 -> 5
            ("c", 2, 0, 0.5), ("c", 2, 1, 0.5)]            # 1
    df = spark.createDataFrame(data, "e string, slot long, day long, y double")
    out = {r["e"]: r["scale"] for r in
           period_scale(df, "e", "slot", "y", ref=F.col("day") == 0, target=F.col("day") == 1).collect()}
    assert out == {"a": 5.0, "b": 0.2, "c": pytest.approx(3.0)}


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the rows: the result is the brute-force answer."""
    rng = np.random.default_rng(9)
    data = [(i, 0, "train", "hot" if i % 3 == 0 else f"k{i % 7}", float(np.round(rng.random(), 3)))
            for i in range(300)]
    data += [(1000, 0, "test", "hot", None)]
    r = _enc(_rows(spark, data))
    hot = [y for _, _, ro, k, y in data if k == "hot" and ro == "train"]
    assert r[(1000, 0)]["te_med"] == pytest.approx(float(np.median(hot)))
    assert r[(1000, 0)]["te_mean"] == pytest.approx(float(np.mean(hot)))
    own = next(x for x in data if x[3] == "hot")
    assert r[(own[0], 0)]["te_med"] == pytest.approx(float(np.median(hot)))   # n > 20: group median


def test_fold_scale_uses_only_fold_training_rows(spark):
    from panelcast.plans.encodings import fold_scale
    from panelcast.schema import PanelSpec
    spec = PanelSpec(entity="e", target="y", day="day", scale_slot="slot", target_day=1)
    data = [(0, "train", "a", 0, 1, 1.0), (0, "train", "a", 1, 1, 2.0), (0, "val", "a", 1, 1, 50.0),
            (1, "train", "a", 0, 1, 1.0), (1, "train", "a", 1, 1, 4.0)]
    rows = spark.createDataFrame(data, "fold long, role string, e string, day long, slot long, y double")
    got = {r["fold"]: r["scale"] for r in fold_scale(rows, spec).collect()}
    assert got == {0: 2.0, 1: 4.0}                     # the val label 50 never counts


def test_duplicate_cell_time_fails_fast(spark):
    from panelcast.plans.jobs import validate_panel
    from panelcast.sources import fixtures as fx
    p = spark.createDataFrame([("qp00", 1, "0:0", 0.1, "train"), ("qp00", 1, "0:0", 0.2, "train")],
                              "geohash string, day long, timestamp string, demand double, split string")
    with pytest.raises(ValueError):
        validate_panel(p, fx.EVENTS_SPEC)
