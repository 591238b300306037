"""Property: lag / rolling features at time t never depend on targets at times >= t."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from panelcast.operators.lags import lag_block


@settings(max_examples=4, deadline=None)
@given(seed=st.integers(0, 10_000), cut=st.integers(20, 180))
def test_future_labels_do_not_leak(spark, seed, cut):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(3):
        slots = sorted(rng.choice(200, size=80, replace=False))
        rows += [(f"e{e}", int(s) * 15, float(rng.random())) for s in slots]
    perturbed = [(e, t, (y + 10.0 if t >= cut * 15 else y)) for e, t, y in rows]

    def feats(data):
        df = spark.createDataFrame(data, "e string, t long, y double")
        out = lag_block(df, "e", "t", "y", 15, lags=(1, 2, 4, 96), windows=(4, 96), chunk_rows=16, partitions=8)
        return {(r["e"], r["t"]): r.asDict() for r in out.collect()}

    a, b = feats(rows), feats(perturbed)
    for key, ra in a.items():
        if key[1] <= cut * 15:
            for c, v in ra.items():
                if c not in ("e", "t", "y"):
                    assert (v is None and b[key][c] is None) or v == pytest.approx(b[key][c]), (key, c)
