"""Streaming calibration, categorical metadata, recursive filling."""

import pytest
from pyspark.sql import functions as F

from panelcast.operators.crossperiod import calibrate
from panelcast.operators.recursive import linear_predictor, recursive_fill
from panelcast.sources.io import scratch_dir
from panelcast.streaming.calibrate import run_calibration


def test_stream_equals_batch(spark):
    preds = spark.createDataFrame([(1, "a", 0.5), (2, "b", 0.9), (3, "z", 0.2)], "row_id long, geohash string, pred double")
    scale = spark.createDataFrame([("a", 2.0), ("b", 5.0)], "geohash string, scale double")
    src, sink = scratch_dir(spark, "t-in"), scratch_dir(spark, "t-out")
    preds.write.parquet(src)
    ckpt = scratch_dir(spark, "t-ckpt")
    run_calibration(spark, src, scale, sink, ckpt)
    got = {r["row_id"]: r["pred"] for r in spark.read.parquet(sink).collect()}
    want = {r["row_id"]: r["pred"] for r in calibrate(preds, scale, "geohash", "pred").collect()}
    assert got == pytest.approx(want)
    assert want[2] == 1.0                                 # clipped
    assert want[3] == pytest.approx(0.2 * (0.2 * 3.5 + 0.8))   # unseen cell -> mean scale


def test_stream_goes_on_with_new_rows(spark):
    scale = spark.createDataFrame([("a", 2.0)], "geohash string, scale double")
    src, sink, ckpt = (scratch_dir(spark, f"t-{k}") for k in ("in", "out", "ckpt"))
    seen = []
    for ids in ([1, 2], [3, 4], []):
        spark.createDataFrame([(i, "a", 0.1) for i in ids], "row_id long, geohash string, pred double").write.mode("append").parquet(src)
        run_calibration(spark, src, scale, sink, ckpt)
        seen += ids
        assert sorted(r["row_id"] for r in spark.read.parquet(sink).collect()) == seen


def test_recursive_fill_uses_own_predictions(spark):
    rows = [("e", s * 15, float(s) if s < 3 else None) for s in range(6)]
    df = spark.createDataFrame(rows, "entity string, t long, y double")
    out = {r["t"]: r["pred"] for r in recursive_fill(df, "entity", "t", "y", 15, linear_predictor(1.0, 1.0)).collect()}
    assert out == {45: 3.0, 60: 4.0, 75: 5.0}             # each step's lag_1 is the previous prediction


def test_recursive_fill_covers_every_slot_over_days(spark):
    import random
    rng = random.Random(4)
    rows = {}
    for e in "ab":
        for q in range(330):
            if rng.random() < 0.8:
                rows[e, q * 15] = float(q % 7) if q < 150 or rng.random() < 0.2 else None
    df = spark.createDataFrame([(e, t, v) for (e, t), v in rows.items()], "entity string, t long, y double")
    value, want = {k: v for k, v in rows.items() if v is not None}, {}
    for e, t in sorted((k for k in rows if rows[k] is None), key=lambda k: k[1]):
        base = value.get((e, t - 15))
        base = value.get((e, t - 1440)) if base is None else base
        want[e, t] = None if base is None else max(0.5 * base + 1, 0.0)
        if base is not None:
            value[e, t] = want[e, t]
    out = recursive_fill(df, "entity", "t", "y", 15, linear_predictor(0.5, 1.0)).collect()
    assert len(out) == len(want)
    for r in out:
        assert r["pred"] == pytest.approx(want[r["entity"], r["t"]]) if want[r["entity"], r["t"]] is not None else r["pred"] is None
    slots = sorted({t for _, t in want})
    assert all(slots[r["step"]] == r["t"] for r in out)
    assert recursive_fill(df.where("y is not null"), "entity", "t", "y", 15, linear_predictor(1.0, 0.0)).count() == 0


def test_cell_ids_of_many_users_stay_distinct(spark):
    from panelcast.sources import fixtures as fx
    u = F.col("id")
    users = spark.createDataFrame([(i,) for i in (0, 32768, 65536, 150000, 150000 - 32768, 33554431)], "id long")
    assert users.select(fx.cell_id(u).alias("g")).distinct().count() == 6
    import duckdb
    sql = duckdb.sql(f"SELECT u, {fx.CELL_ID_SQL} AS g FROM (SELECT unnest([0, 32768, 150000]) AS u)").fetchall()
    assert dict(sql) == {r["id"]: r["g"] for r in users.select("id", fx.cell_id(u).alias("g")).where("id in (0, 32768, 150000)").collect()}


def test_categorical_metadata(spark):
    from panelcast.plans.training import assemble
    df = spark.createDataFrame([(0.0, 1.5), (2.0, None)], "c double, x double")
    v = assemble(df, ["c", "x"], categorical=["c"])
    meta = v.schema["features"].metadata["ml_attr"]
    assert meta["attrs"]["nominal"][0]["num_vals"] == 3 and meta["num_attrs"] == 2


def test_mean_ordered_codes(spark):
    """Few codes keep a bin each in the order of their means; many share bins without breaking that order; other
    folds, NULL and unseen codes are apart."""
    from panelcast.plans.training import mean_ordered_codes, with_bins
    rows = [(0, "train", float(c), float(n), (c * 7 % 5) + (i - 1) * 0.1, (n * 37) % 500) for n in range(500) for c, i in [(n % 5, n % 3)]]
    rows = [(f, r, c, n, float(m)) for f, r, c, n, _, m in rows]
    rows += [(1, "train", 0.0, 1.0, 1.0), (0, "val", 99.0, None, 1e9), (0, "val", 3.0, 7.0, 1e9), (1, "val", 3.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "fold int, role string, c double, n double, y double")
    codes = mean_ordered_codes(df, ["c", "n"], "y", 16)
    got = {(r["fold"], r["feature"], r["code"]): r["bin"] for r in codes.collect()}
    means = {}
    for f, r, c, n, y in rows:
        if r == "train":
            means.setdefault((f, "c", c), []).append(y)
            means.setdefault((f, "n", n), []).append(y)
    means = {k: sum(v) / len(v) for k, v in means.items()}
    assert set(got) == set(means) and min(got.values()) == 1 and max(got.values()) <= 15
    for name in "cn":
        mine = sorted((means[k], got[k]) for k in got if k[:2] == (0, name))
        assert [b for _, b in mine] == sorted(b for _, b in mine)
        assert len({b for _, b in mine}) == (5 if name == "c" else 15)
    back = {(r["fold"], r["y"], r["c"], r["n"]) for r in with_bins(df.where("role = 'val'"), ["c", "n"], codes).collect()}
    assert back == {(0, 1e9, 0.0, 0.0), (0, 1e9, got[0, "c", 3], got[0, "n", 7]), (1, 0.0, 0.0, 1.0)}


def test_nominal_features_beat_numeric_codes(spark):
    """A target that jumps from code to code: 300 codes as one nominal feature against the same codes as numbers."""
    import random
    from panelcast.plans.training import GBTParams, run_cv, score
    rng = random.Random(5)
    level = [rng.random() for _ in range(300)]
    rows = [(i, 0, "train" if i % 4 else "val", float(c), level[c]) for i in range(6000) for c in [rng.randrange(300)]]
    df = spark.createDataFrame(rows, "Index long, fold int, role string, c double, y double")
    params = GBTParams(max_iter=6, patience=6, step_size=0.3, max_depth=3, max_bins=32, min_instances_per_node=1, subsampling_rate=1.0, feature_subset="all")
    res = {cats: run_cv(df, ["c"], "y", "Index", params, categorical=cats) for cats in ((), ("c",))}
    r2 = {cats: r.fold_r2.first()["r2"] for cats, r in res.items()}
    assert r2["c",] > 0.9 and r2["c",] > r2[()] + 0.3
    told = res["c",]
    again = score(told.models, df.where("role = 'val'").drop("fold"), ["c"], "Index", codes=told.codes, categorical=["c"])
    assert {r["Index"]: r["pred"] for r in again.collect()} == {r["Index"]: r["pred"] for r in told.predictions.collect()}


def test_sweep_draws_and_shares_vectors(spark):
    import random
    from panelcast.plans.training import GBTParams, run_cv, run_sweep, sample_trials, sweep_scores
    trials = sample_trials(40)
    assert trials == sample_trials(40) and len({tuple(t.items()) for t in trials}) == 40 and trials != sample_trials(40, seed=1)
    assert len(sample_trials(40, {"max_depth": (1, 2), "step_size": (0.1,)})) == 2
    rng = random.Random(8)
    rows = [(i, f, "train" if i % 3 else "val", x, x * x + f) for i in range(600) for x in [float(rng.randrange(40))] for f in (0, 1)]
    df = spark.createDataFrame(rows, "Index long, fold int, role string, x double, y double")
    base = GBTParams(max_iter=4, patience=2, min_instances_per_node=5, feature_subset="all", subsampling_rate=1.0)
    grid = [{"max_depth": 1}, {"max_depth": 3, "step_size": 0.3}]
    got = run_sweep(df, ["x"], "y", grid, base, folds=[0, 1])
    table = {(r["trial"], r["fold"]): (r["r2"], r["iters"]) for r in got.collect()}
    own = run_cv(df, ["x"], "y", "Index", GBTParams(**{**base.__dict__, **grid[1]})).fold_r2.collect()
    assert {(1, r["fold"]): (pytest.approx(r["r2"]), r["trees"]) for r in own} == {k: v for k, v in table.items() if k[0] == 1}
    scores = {r["trial"]: r["score"] for r in sweep_scores(got, 10, 1, margin=0, min_last=1).collect()}
    assert scores[1] == pytest.approx((table[1, 0][0] + table[1, 1][0]) / 2) and scores[0] != scores[1]
    assert {r["score"] for r in sweep_scores(got, 4, 1, margin=0, min_last=1).collect()} <= {0.0}


def test_best_round_by_patience():
    from panelcast.plans.training import best_round
    assert best_round([5, 4, 3, 3, 3], 2) == (3, True)
    assert best_round([5, 4, 3, 3, 2], 3) == (5, False)
    assert best_round([5, 4, 6, 6, 1], 2) == (2, True)            # the late low is never seen
    assert best_round([1.0], 5) == (1, False)


def test_patience_cuts_an_overfitted_ensemble(spark):
    """Noise can't be learnt: the search ends early, the kept ensemble is the best prefix of the whole one."""
    import random
    from panelcast.plans.training import GBTParams, assemble, best_round, fit_with_patience
    rng = random.Random(1)
    rows = [(i % 2, float(rng.random()), float(rng.random())) for i in range(600)]
    df = assemble(spark.createDataFrame([(v, x, (x > 0.5) + 2 * (e - 0.5)) for v, x, e in rows], "val int, x double, label double"), ["x"])
    train, val = df.where("val = 0").cache(), df.where("val = 1").cache()
    params = GBTParams(max_iter=40, patience=5, step_size=0.3, max_depth=5, min_instances_per_node=1, feature_subset="all", subsampling_rate=1.0)
    model, losses = fit_with_patience(train, val, params)
    best, ended = best_round(losses, 5)
    assert ended and model.getNumTrees == best < 40
    whole = params.estimator(rounds=best + 5).fit(train)
    assert losses == pytest.approx(whole.evaluateEachIteration(val, "squared")[:len(losses)])
    mse = model.transform(val).select(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert mse == pytest.approx(losses[best - 1]) and mse == pytest.approx(min(losses))


def test_training_learns_a_real_signal(spark):
    """With a target driven by hour and weather, the per-fold GBT must explain most variance."""
    from conftest import SF
    from panelcast.plans.jobs import train_job
    from panelcast.plans.training import GBTParams
    from panelcast.sources import fixtures as fx
    p = fx.cell_panel(spark, SF)
    hour = F.split("timestamp", ":").getItem(0).cast("double")
    signal = hour / 30.0 + F.when(F.col("Weather") == "Rain", 0.2).otherwise(0.0)
    p = p.withColumn("demand", F.when(F.col("split") == "train", signal))
    out = train_job(p, fx.EVENTS_SPEC, GBTParams(max_iter=15, step_size=0.1, max_depth=4, min_instances_per_node=5,
                                                 feature_subset="all", subsampling_rate=1.0), ablation=False)
    r2s = [r["r2"] for r in out.full.fold_r2.collect()]
    assert len(r2s) == 5 and min(r2s) > 0.5, r2s
