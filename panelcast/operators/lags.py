"""Leak-free exact-time lags and rolling statistics.

Semantics (per entity, rows ordered by absolute time ``t``):

* ``lag_k``       = target at exactly ``t - k*step`` of the same entity, NULL when that slot is
  absent (an equi-lookup at a time offset, not an as-of join);
* ``roll_mean_w`` = mean of the non-NULL targets of the previous ``w`` ROWS (current row excluded);
* ``roll_std_w``  = sample standard deviation over the same frame, NULL below two values.

Unlabelled rows carry a NULL target, so nothing computed for time ``t`` can see a label at or
after ``t``.

Physical plan.  A plain ``Window.partitionBy(entity)`` puts an entire entity into one task;
with one entity holding a third of the data that task never finishes.  Instead:

1. the rows are dealt by range of (entity, t) and written sorted: a hot entity spreads over
   partitions, many small ones share one.  The partitions' row counts give every row its
   position in the whole order.
2. rows are cut into chunks of ``chunk_rows`` positions; the last ``H`` rows of each chunk
   (``H`` = largest lag / window) are copied into the next chunk as a read-only halo.
3. ONE window partitioned by (entity, chunk) and ordered by ``t`` evaluates every lag (RANGE
   frame at an exact offset) and every rolling statistic (ROWS frame) in a single sort.

That is one range exchange, one hash exchange and no join.  Because (entity, t) is unique on
the step grid, the row at ``t - k*step`` is never more than ``k`` positions back, so it is
inside the chunk or its halo: results equal the unchunked window exactly.  Run
``checks.assert_unique_grid`` first on untrusted input.  All columns of ``df`` travel; pass
narrow rows and join the result where rows are wide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.operators.ordinal import literal_positions
from panelcast.schema import LAG_STEPS, ROLL_WINDOWS

CHUNK_ROWS = 1 << 20


def lag_block(df: DataFrame, entity: str, t: str, target: str, step: int,
              lags: Sequence[int] = LAG_STEPS, windows: Sequence[int] = ROLL_WINDOWS,
              chunk_rows: int = CHUNK_ROWS, partitions: int | None = None) -> DataFrame:
    """Add ``lag_k``, ``roll_mean_w`` and ``roll_std_w`` columns."""
    halo = max(list(lags) + list(windows) + [1])
    chunk = max(chunk_rows, halo)
    pos = literal_positions(df, [entity, t], "_pos", partitions)
    own = F.floor(F.col("_pos") / chunk).cast("bigint")
    in_halo = (F.col("_pos") % chunk) >= chunk - halo
    rows = (pos.withColumn("_own", own)
            .withColumn("_chunk", F.explode(F.when(in_halo, F.array(own, own + 1)).otherwise(F.array(own)))))
    w = Window.partitionBy(entity, "_chunk").orderBy(F.col(t))
    y = F.col(target)
    feats = {}
    for k in lags:
        off = k * step
        feats[f"lag_{k}"] = F.first(y).over(w.rangeBetween(-off, -off))
    for win in windows:
        frame = w.rowsBetween(-win, -1)
        feats[f"roll_mean_{win}"] = F.avg(y).over(frame)
        feats[f"roll_std_{win}"] = F.stddev_samp(y).over(frame)
    return (rows.withColumns(feats)
            .where(F.col("_chunk") == F.col("_own"))
            .drop("_pos", "_own", "_chunk"))
