"""Exact order statistics (medians, quantiles, LOO-median sketches) from one rank table.

Spark's ``percentile``/``median`` keep one value->count map per group and merge it in a
single task, so one huge group (a hot key, or the global median over all rows) ends up
in one task's memory.  Here every group, small or huge, takes the same path:

1. ``D`` = distinct (group, value) with their counts — a partial aggregation, so a value that
   repeats a billion times collapses map-side.
2. ``D`` is dealt by RANGE of (group, value) and written.  Its rows are distinct, so the
   partitions are balanced whatever the ties: a hot group spreads over many partitions,
   many small groups share one.
3. Per (group, partition) totals — about one row per group — and their running sums give
   the ranks that each partition of a group starts at.
4. The start joins its partition's rows as one more row in front of them; a running count over
   (group, partition), ordered by value, finds the value at every requested rank.

There is no recursion and no threshold, every window is bounded by one range partition, and
the sampling behind the range only decides where to cut.

``cohorts`` are conditions on the rows (folds, say): each counts its own rows in the same
table, so the medians of all folds come from one grouping of unexploded rows.  Moments come
with it: the mean is known when the rows are passed, so squares are taken about it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.session import cut_lineage

RankFn = Callable[[Column], Column]


def rank_table(df: DataFrame, keys: Sequence[str], value: str | Column, ranks: Mapping[str, RankFn],
               cohorts: Sequence[Column]) -> DataFrame:
    """Per group of ``keys``: ``_st``, an array with one struct per cohort: ``_n`` (non-null count),
    ``_sum``, ``_m2`` (squares about the mean) and, for every ``name -> fn`` in ``ranks``, the exact
    value at 0-based rank ``fn(_n)`` (NULL when the rank is outside ``[0, _n)``).  ``keys`` may be
    empty (one global group).  NULL keys make a group of their own."""
    keys, some = list(keys), range(len(cohorts))
    vcol = F.col(value) if isinstance(value, str) else value
    v = df.select(*keys, vcol.cast("double").alias("_v"), *[c.alias(f"_in{i}") for i, c in enumerate(cohorts)])
    d = (v.where(F.col("_v").isNotNull()).groupBy(*keys, "_v")
         .agg(*[F.count(F.when(F.col(f"_in{i}"), 1)).alias(f"_c{i}") for i in some]))
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = cut_lineage(d.repartitionByRange(parts, *keys, "_v").withColumn("_part", F.spark_partition_id()), "ranks")

    whole = Window.partitionBy(*keys)
    ahead = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*keys, "_part").agg(*[F.sum(f"_c{i}").alias(f"_t{i}") for i in some],
                                               *[F.sum(F.col("_v") * F.col(f"_c{i}")).alias(f"_q{i}") for i in some])
    starts = starts.select(*keys, "_part", F.lit(None).cast("double").alias("_v"),
                           *[F.coalesce(F.sum(f"_t{i}").over(ahead), F.lit(0)).alias(f"_c{i}") for i in some],
                           F.array(*[F.sum(f"_{x}{i}").over(whole).cast("double") for x in "tq" for i in some]).alias("_whole"))
    seen = (Window.partitionBy(*keys, "_part").orderBy(F.asc_nulls_first("_v"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = starts.unionByName(dealt, allowMissingColumns=True).select(
        *keys, "_v", *[F.col(f"_c{i}") for i in some], *[F.sum(f"_c{i}").over(seen).alias(f"_u{i}") for i in some],
        F.first("_whole").over(seen).alias("_whole"))        # the start comes first: counts and sums of its group
    run = run.select("*", *[F.get("_whole", F.lit(k)).alias(f"_{x}{i}") for k, (x, i) in enumerate((x, i) for x in "ns" for i in some)])
    # the row that holds a group's start is not one of its values
    real = F.col("_v").isNotNull()
    aggs = []
    for i in some:
        c, u, n, s = (F.col(f"_{x}{i}") for x in "cuns")
        aggs += [F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias(f"_n{i}"), F.max(s).alias(f"_s{i}"),
                 F.sum(F.when(real & (c > 0), c * (F.col("_v") - s / n) * (F.col("_v") - s / n))).alias(f"_m{i}")]
        for k, fn in enumerate(ranks.values()):
            r = fn(n).cast("bigint")
            aggs.append(F.max(F.when(real & (r >= u - c) & (r < u), F.col("_v"))).alias(f"_r{i}_{k}"))
    found = run.groupBy(*keys).agg(*aggs)
    one = [F.struct(F.col(f"_n{i}").alias("_n"), F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}")).alias("_sum"), F.col(f"_m{i}").alias("_m2"),
                    *[F.col(f"_r{i}_{k}").alias(name) for k, name in enumerate(ranks)]) for i in some]
    return found.select(*keys, F.array(*one).alias("_st"))


def order_stats(df: DataFrame, keys: Sequence[str], value: str | Column,
                ranks: Mapping[str, RankFn], with_sum: bool = False) -> DataFrame:
    """Per group of ``keys``: ``_n`` (non-null count), optional ``_sum``, and for every
    ``name -> fn`` in ``ranks`` the exact value at 0-based rank ``fn(_n)`` (NULL when the
    rank is outside ``[0, _n)``).  ``keys`` may be empty (one global group)."""
    st = rank_table(df, keys, value, ranks, [F.lit(True)])
    return st.select(*keys, *[F.col("_st")[0][c].alias(c) for c in ("_n", *(["_sum"] if with_sum else []), *ranks)])


# --- rank helpers -----------------------------------------------------------

def median_ranks() -> dict[str, RankFn]:
    """The three order statistics around the middle: lo = a[m-1], mid = a[m], hi = a[m+1], m = n div 2."""
    return {
        "_lo": lambda n: F.floor(n / 2) - 1,
        "_mid": lambda n: F.floor(n / 2),
        "_hi": lambda n: F.floor(n / 2) + 1,
    }


def median_from_sketch(n: Column, lo: Column, mid: Column) -> Column:
    """Median of a group from its sketch (linear interpolation for even n)."""
    return F.when(n % 2 == 1, mid).otherwise((lo + mid) / 2)


def exact_median(df: DataFrame, keys: Sequence[str], value: str | Column, alias: str) -> DataFrame:
    """Exact median per group (NULLs skipped) — same values as ``F.median``, skew-safe."""
    st = order_stats(df, keys, value, {"_lo": lambda n: F.floor(n / 2) - 1, "_mid": lambda n: F.floor(n / 2)})
    return st.select(*keys, median_from_sketch(F.col("_n"), F.col("_lo"), F.col("_mid")).alias(alias))


def quantile_ranks(probs: Sequence[float]) -> dict[str, RankFn]:
    ranks: dict[str, RankFn] = {}
    for i, p in enumerate(probs):
        ranks[f"_q{i}_a"] = lambda n, p=p: F.floor((n - 1) * F.lit(p))
        ranks[f"_q{i}_b"] = lambda n, p=p: F.ceil((n - 1) * F.lit(p))
    return ranks


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str | Column,
                    probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Linear-interpolation quantiles (pandas ``quantile`` / DuckDB ``quantile_cont``)."""
    st = order_stats(df, keys, value, quantile_ranks(probs))
    cols = []
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (F.col("_n") - 1) * F.lit(p)
        a, b = F.col(f"_q{i}_a"), F.col(f"_q{i}_b")
        cols.append((a + (h - F.floor(h)) * (b - a)).alias(name))
    return st.select(*keys, "_n", *cols)
