"""Lag block: exact-time lags, previous-row rolling stats, chunking invariance."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelcast.operators.lags import lag_block


def _rows(df, key="t"):
    return {r[key]: r for r in df.collect()}


def test_gap_panel(spark):
    """One cell, slots 0,1,3,4,99: lag_1 is NULL after a gap; rolling counts rows, not slots."""
    slots = [0, 1, 3, 4, 99]
    df = spark.createDataFrame([("c", s * 15, float(s + 1)) for s in slots], "e string, t long, y double")
    out = _rows(lag_block(df, "e", "t", "y", 15, lags=(1, 2, 96), windows=(2,)))
    assert out[45]["lag_1"] is None and out[45]["lag_2"] == 2.0          # slot 3: slot 2 absent, slot 1 present
    assert out[60]["lag_1"] == 4.0
    assert out[99 * 15]["lag_96"] == 4.0                                # slot 99 - 96 = slot 3
    assert out[99 * 15]["roll_mean_2"] == pytest.approx((4.0 + 5.0) / 2)  # previous 2 ROWS (slots 3, 4)
    assert out[0]["roll_mean_2"] is None


def test_null_in_frame(spark):
    """y = 1, NULL, 4, NULL: NULLs skipped; std of one value is NULL."""
    ys = [1.0, None, 4.0, None, 2.0]
    df = spark.createDataFrame([("c", i * 15, y) for i, y in enumerate(ys)], "e string, t long, y double")
    out = _rows(lag_block(df, "e", "t", "y", 15, lags=(1,), windows=(4,)))
    assert out[15]["roll_mean_4"] == 1.0 and out[15]["roll_std_4"] is None
    assert out[30]["roll_mean_4"] == 1.0
    assert out[45]["roll_mean_4"] == pytest.approx(2.5)
    assert out[45]["roll_std_4"] == pytest.approx(float(np.std([1.0, 4.0], ddof=1)))
    assert out[30]["lag_1"] is None


def test_chunking_matches_plain_window(spark):
    """Tiny chunks + halo give exactly the single-partition window result."""
    rng = np.random.default_rng(11)
    data = []
    for e in range(3):
        slots = sorted(rng.choice(400, size=120, replace=False))
        data += [(f"e{e}", int(s) * 15, None if rng.random() < 0.1 else float(rng.random())) for s in slots]
    df = spark.createDataFrame(data, "e string, t long, y double")
    chunked = lag_block(df, "e", "t", "y", 15, chunk_rows=7, partitions=5)
    w = Window.partitionBy("e").orderBy("t")
    plain = df.select("e", "t", *[F.first("y").over(w.rangeBetween(-15 * k, -15 * k)).alias(f"lag_{k}")
                                  for k in (1, 2, 4, 96, 192)],
                      *[F.avg("y").over(w.rowsBetween(-n, -1)).alias(f"roll_mean_{n}") for n in (4, 96)],
                      *[F.stddev_samp("y").over(w.rowsBetween(-n, -1)).alias(f"roll_std_{n}") for n in (4, 96)])
    a = {(r["e"], r["t"]): r.asDict() for r in chunked.collect()}
    b = {(r["e"], r["t"]): r.asDict() for r in plain.collect()}
    assert a.keys() == b.keys()
    for k, rb in b.items():
        for c, v in rb.items():
            if c in ("e", "t"):
                continue
            assert (a[k][c] is None and v is None) or a[k][c] == pytest.approx(v), (k, c)


def test_no_unpartitioned_window(spark):
    df = spark.createDataFrame([("c", 0, 1.0)], "e string, t long, y double")
    plan = lag_block(df, "e", "t", "y", 15)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_one_entity_over_many_partitions(spark):
    """Empty partitions, chunks smaller than the halo and an empty table."""
    df = spark.createDataFrame([("c", s * 15, float(s)) for s in range(500)], "e string, t long, y double")
    out = _rows(lag_block(df, "e", "t", "y", 15, lags=(1, 96), windows=(4,), chunk_rows=1, partitions=40))
    assert len(out) == 500 and all(r["lag_1"] == (r["y"] - 1 if r["y"] else None) for r in out.values())
    assert all(r["lag_96"] == (r["y"] - 96 if r["y"] >= 96 else None) for r in out.values())
    assert out[499 * 15]["roll_mean_4"] == pytest.approx(496.5)
    assert lag_block(df.limit(0), "e", "t", "y", 15).count() == 0
