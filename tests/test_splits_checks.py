"""Temporal ordinal, forward folds, output checks."""

import pytest
from pyspark.sql import functions as F

from panelcast.operators.checks import duplicate_keys, id_report, range_report
from panelcast.operators.ordinal import global_ordinal
from panelcast.operators.splits import fold_bounds, forward_chain_roles


def test_fold_ties(spark):
    """13 rows, 5 folds, equal time keys across a fold border: positions follow (key, id)."""
    keys = [0, 0, 1, 1, 1, 2, 2, 3, 3, 3, 3, 4, 4]
    df = spark.createDataFrame([(100 - i, k) for i, k in enumerate(keys)], "rid long, sort_key long")
    pos = global_ordinal(df, ["sort_key", "rid"], partitions=4)
    ordered = [r["rid"] for r in pos.orderBy("pos").collect()]
    assert ordered == [r for _, r in sorted(zip(keys, [100 - i for i in range(13)]))]
    n = 13
    folds = forward_chain_roles(pos, n, 5).collect()
    s = n // 6
    bounds = fold_bounds(n, 5)
    assert bounds[0] == (n - 5 * s, n - 5 * s, n - 4 * s)
    posmap = {r["rid"]: r["pos"] for r in pos.collect()}
    for r in folds:
        train_end, vs, ve = bounds[r["fold"]]
        p = posmap[r["rid"]]
        assert (p < train_end) if r["role"] == "train" else (vs <= p < ve)
    assert sum(1 for r in folds if r["role"] == "val") == 5 * s


def test_bad_output(spark):
    src = spark.createDataFrame([(i,) for i in range(5)], "Index long")
    out = spark.createDataFrame([(0, 0.5), (1, None), (1, 0.2), (2, 1.2), (9, 0.1)], "Index long, demand double")
    ids = id_report(out, src, "Index").first()
    assert (ids["missing_ids"], ids["extra_ids"], ids["duplicate_ids"]) == (2, 1, 1)
    rng = range_report(out, "demand").first()
    assert rng["in_range"] is False and rng["violations"] == 2


def test_dup_key(spark):
    df = spark.createDataFrame([("c", 0), ("c", 0), ("c", 15)], "e string, t long")
    assert duplicate_keys(df, ["e", "t"]).count() == 1


def test_zero_denominators_give_null(spark):
    """ANSI mode raises on x/0; undefined statistics must come back NULL instead."""
    from panelcast.operators.crossperiod import stack_ols
    from panelcast.operators.metrics import r2
    from panelcast.operators.profile import target_summary
    const = spark.createDataFrame([(1.0, 0.5, 2.0), (1.0, 0.7, 4.0)], "y double, p double, x double")
    assert r2(const, "y", "p").first()["r2"] is None
    assert target_summary(const, "x").first()["skew"] is None          # n = 2
    collinear = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 4.0), (3.0, 3.0, 6.0)], "y double, a double, b double")
    assert stack_ols(collinear, "y", "a", "b").first()["b_pred"] is None


def test_hash_group_folds_keep_cells_together(spark):
    from panelcast.operators.splits import hash_group_folds
    df = spark.createDataFrame([(f"c{i % 17}", i) for i in range(200)], "cell string, rid long")
    per_cell = hash_group_folds(df, "cell", 5).groupBy("cell").agg(F.countDistinct("fold").alias("k")).collect()
    assert all(r["k"] == 1 for r in per_cell)


def test_target_share_moves_rows_into_training(spark):
    from panelcast.operators.splits import forward_chain_roles, with_target_share
    n = 60
    df = spark.createDataFrame([(i, i, 0 if i < 30 else 1) for i in range(n)], "rid long, pos long, day long")
    rows = forward_chain_roles(df, n, 5)
    v4 = with_target_share(rows, "day", 1, "rid", 4, 5).collect()
    picked = {i for i in range(30, n) if i % 4 == 0}
    for r in v4:
        if r["rid"] in picked:
            assert r["role"] == "train"
    moved_val = {r["rid"] for r in rows.collect() if r["role"] == "val" and r["rid"] in picked}
    for rid in moved_val:                                  # trains in every fold now
        assert sorted(r["fold"] for r in v4 if r["rid"] == rid) == [0, 1, 2, 3, 4]
