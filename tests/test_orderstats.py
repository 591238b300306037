"""Exact order statistics and the closed-form LOO median against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators.encode import group_median, loo_median
from panelcast.operators.orderstats import exact_median, exact_quantiles, median_ranks, order_stats, rank_table


def _frame(spark, groups):
    rows = [(g, float(v), i) for i, (g, v) in enumerate((g, v) for g, vals in groups.items() for v in vals)]
    return spark.createDataFrame(rows, "g string, y double, rid long")


@pytest.fixture(params=[1, 8, 64])
def parts(request, spark):
    """Range partitions: one, some, and more than there are values in most groups."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_median_matches_numpy(spark, parts):
    rng = np.random.default_rng(7)
    groups = {f"g{i}": list(np.round(rng.integers(0, 6, size=n) / 4, 2)) for i, n in enumerate([1, 2, 5, 20, 21, 64])}
    df = _frame(spark, groups)
    got = {r["g"]: r["m"] for r in exact_median(df, ["g"], "y", "m").collect()}
    for g, vals in groups.items():
        assert got[g] == pytest.approx(float(np.median(vals)))


def test_global_quantiles(spark, parts):
    rng = np.random.default_rng(3)
    vals = list(rng.normal(size=301))
    df = spark.createDataFrame([(float(v),) for v in vals], "y double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, [], "y", probs, [f"q{i}" for i in range(5)]).first()
    for i, p in enumerate(probs):
        assert got[f"q{i}"] == pytest.approx(float(np.quantile(vals, p)))


def test_loo_median_closed_form_groups_1_2_20_21(spark):
    """groups_1_2_20_21 fixture: ties included; brute force = median without the own row."""
    groups = {"n1": [0.5], "n2": [0.1, 0.1], "n20": [0.1, 0.2, 0.2, 0.3] * 5, "n21": [0.3, 0.1, 0.1] * 7}
    df = _frame(spark, groups)
    st = order_stats(df, ["g"], "y", median_ranks(), with_sum=True)
    j = df.join(st, "g")
    got = j.select("g", "rid", "y", loo_median(F.col("y"), F.col("_n"), F.col("_lo"), F.col("_mid"), F.col("_hi"))
                   .alias("loo"), group_median(F.col("_n"), F.col("_lo"), F.col("_mid")).alias("gm")).collect()
    for r in got:
        vals = groups[r["g"]]
        if len(vals) >= 2:
            rest = list(vals)
            rest.remove(r["y"])
            assert r["loo"] == pytest.approx(float(np.median(rest)))
        assert r["gm"] == pytest.approx(float(np.median(vals)))


def test_quantiles_with_ties(spark, parts):
    """One value holds three sevenths of the rows."""
    rng = np.random.default_rng(21)
    vals = list(np.round(rng.normal(size=400), 4)) + [0.5] * 300
    df = spark.createDataFrame([(float(v),) for v in vals], "y double")
    probs = [0.0, 0.25, 0.5, 0.73, 1.0]
    got = exact_quantiles(df, [], "y", probs, [f"q{i}" for i in range(5)]).first()
    for i, p in enumerate(probs):
        assert got[f"q{i}"] == pytest.approx(float(np.quantile(vals, p)))


def test_ties_at_the_minimum(spark, parts):
    """99.9 % of the rows hold the least value; the others are all different."""
    vals = [0.0] * 99_900 + [1 + i / 7 for i in range(100)]
    df = spark.range(len(vals)).select(F.when(F.col("id") < 99_900, 0.0).otherwise(1 + (F.col("id") - 99_900) / 7).alias("y"))
    probs = [0.0, 0.5, 0.9989, 0.9995, 1.0]
    got = exact_quantiles(df, [], "y", probs, [f"q{i}" for i in range(5)]).first()
    for i, p in enumerate(probs):
        assert got[f"q{i}"] == pytest.approx(float(np.quantile(vals, p)))


def test_cohorts_nulls_and_no_rows(spark, parts):
    """Every cohort has its own count, moments and ranks; a NULL key is a group; no rows give one empty global row."""
    rng = np.random.default_rng(5)
    data = [(None if i % 5 == 0 else f"g{i % 3}", None if i % 11 == 0 else float(rng.integers(0, 9)), i % 4) for i in range(400)]
    df = spark.createDataFrame(data, "g string, y double, block int")
    got = {r["g"]: r["_st"] for r in rank_table(df, ["g"], "y", median_ranks(), [F.col("block") <= b for b in (-1, 0, 2)]).collect()}
    assert set(got) == {None, "g0", "g1", "g2"}
    for g, st_ in got.items():
        assert st_[0]["_n"] == 0 and st_[0]["_sum"] is None and st_[0]["_mid"] is None
        for b, one in zip((0, 2), st_[1:]):
            vals = sorted(y for k, y, block in data if k == g and y is not None and block <= b)
            m = len(vals) // 2
            assert (one["_n"], one["_mid"], one["_lo"], one["_hi"]) == (len(vals), vals[m], vals[m - 1], vals[m + 1])
            assert one["_sum"] == pytest.approx(sum(vals)) and one["_m2"] == pytest.approx(float(np.var(vals) * len(vals)))
    empty = order_stats(df.where("false"), [], "y", median_ranks(), with_sum=True).collect()
    assert [tuple(r) for r in empty] == [(0, None, None, None, None)]
    assert not order_stats(df.where("false"), ["g"], "y", median_ranks()).collect()


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=4, deadline=None)
@given(seed=st.integers(0, 10_000))
def test_loo_median_property(spark, seed):
    """Random group sizes 1..30 with heavy ties: closed form == median without the own row."""
    rng = np.random.default_rng(seed)
    groups = {f"g{i}": list(rng.integers(0, 4, size=int(rng.integers(1, 31))) / 4.0) for i in range(6)}
    df = _frame(spark, groups)
    st_ = order_stats(df, ["g"], "y", median_ranks(), with_sum=True)
    rows = df.join(st_, "g").select(
        "g", "y", "_n", "_sum", loo_median(F.col("y"), F.col("_n"), F.col("_lo"), F.col("_mid"), F.col("_hi")).alias("loo"),
        group_median(F.col("_n"), F.col("_lo"), F.col("_mid")).alias("gm")).collect()
    for r in rows:
        vals = groups[r["g"]]
        assert r["_n"] == len(vals) and r["_sum"] == pytest.approx(sum(vals))
        assert r["gm"] == pytest.approx(float(np.median(vals)))
        if len(vals) >= 2:
            rest = list(vals)
            rest.remove(r["y"])
            assert r["loo"] == pytest.approx(float(np.median(rest)))
