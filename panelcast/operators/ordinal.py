"""Global ordinals without a single-task window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into one task.  Instead the
rows are range-partitioned and sorted (balanced by sampling, so a hot sort key is split
across tasks by the tie-break column), every partition counts its rows, a running sum over
the tiny per-partition count table gives offsets, and each row adds its offset to its
position inside its partition.  The sorted table is checkpointed first so that both passes
see exactly the same partitioning (and the job survives executor loss).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import cut_lineage

_LOW33 = (1 << 33) - 1


def global_ordinal(df: DataFrame, order: Sequence[str | Column], name: str = "pos",
                   partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row in the total order ``order``.

    ``order`` must be a total order (end it with a unique column) for a deterministic result.
    """
    ranged = sorted_table(df, order, partitions)
    counts = ranged.groupBy("_pc_pid").agg(F.count(F.lit(1)).alias("_pc_n"))
    # The count table has one row per partition: a window without partition keys is bounded here.
    offsets = counts.select(
        "_pc_pid",
        F.coalesce(F.sum("_pc_n").over(Window.orderBy("_pc_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_pc_off"))
    out = ranged.join(F.broadcast(offsets), "_pc_pid")
    return (out.withColumn(name, (F.col("_pc_off") + F.col("_pc_mid").bitwiseAND(F.lit(_LOW33))).cast("bigint"))
            .drop("_pc_pid", "_pc_mid", "_pc_off"))


def sorted_table(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written once, with each row's partition
    (``_pc_pid``) and an id that grows inside it (``_pc_mid``)."""
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return cut_lineage(df.repartitionByRange(n_parts, *cols).sortWithinPartitions(*cols)
                       .withColumn("_pc_pid", F.spark_partition_id())
                       .withColumn("_pc_mid", F.monotonically_increasing_id()))


def literal_positions(df: DataFrame, order: Sequence[str | Column], name: str = "pos",
                      partitions: int | None = None) -> DataFrame:
    """``global_ordinal`` for plans that go on: the partitions' first positions (one number per
    partition, counted from the written table) are a literal array, so nothing is joined."""
    ranged = sorted_table(df, order, partitions)
    sizes = {r["_pc_pid"]: r["count"] for r in ranged.groupBy("_pc_pid").count().collect()}
    starts = [0]
    for pid in range(max(sizes, default=0)):
        starts.append(starts[-1] + sizes.get(pid, 0))
    first = F.element_at(F.expr(f"array({', '.join(f'{s}L' for s in starts)})"), F.col("_pc_pid") + 1)
    return (ranged.withColumn(name, first + F.col("_pc_mid").bitwiseAND(F.lit(_LOW33)))
            .drop("_pc_pid", "_pc_mid"))


def dense_codes(values: DataFrame, value_col: str, name: str) -> DataFrame:
    """(value, code) with codes 0.. in ascending order of the distinct values (label encoding)."""
    distinct = values.select(value_col).distinct()
    return global_ordinal(distinct, [value_col], name=name)
