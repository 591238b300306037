"""Dataset profile (R3): every table of the profiling report as a DataFrame.

``split`` tells the labelled and unlabelled parts apart.  Each function is one grouped
aggregation (or a set operation) — nothing is collected except schema metadata.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.orderstats import exact_median, exact_quantiles
from panelcast.operators.rows import combine_rows

DECILES = tuple(i / 10 for i in range(11))
HIST_BINS = 80
PREFIX_LENGTHS = (3, 4, 5, 6)
PROFILE_CATEGORICALS = ("RoadType", "Weather", "LargeVehicles", "Landmarks", "NumberofLanes")


def shape_by_split(df: DataFrame, split: str, dropped: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Rows and column count per split (``dropped`` lists columns a split's file lacks)."""
    n_cols = len(df.columns) - 1
    dropped = dropped or {}
    out = df.groupBy(split).agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    expr = F.lit(n_cols)
    for s, cols in dropped.items():
        expr = F.when(F.col(split) == s, F.lit(n_cols - len(cols))).otherwise(expr)
    return out.withColumn("columns", expr.cast("bigint"))


def shape_of_files(files: dict[str, DataFrame], split: str = "split") -> DataFrame:
    """Rows and columns of every input file, read from the file itself."""
    out = None
    for name, df in files.items():
        one = df.agg(F.lit(name).alias(split), F.count(F.lit(1)).cast("bigint").alias("rows"),
                     F.lit(len(df.columns)).cast("bigint").alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


def dtypes_of_files(files: dict[str, DataFrame]) -> DataFrame:
    """A35 + U4: every column of any file with its type class and, per file, whether the file has it (``in_<name>``)."""
    out = None
    for name, df in files.items():
        one = dtypes_table(df).select("column", "type_class", F.lit(name).alias("_file"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("column", "type_class").agg(*[F.bool_or(F.col("_file") == name).alias(f"in_{name}") for name in files])


TYPE_CLASSES = {"string": "string", "bigint": "integer", "int": "integer", "smallint": "integer",
                "tinyint": "integer", "double": "double", "float": "double", "boolean": "boolean"}


def dtypes_table(df: DataFrame) -> DataFrame:
    """(column, type, type_class) from the schema (metadata, built on the driver by nature)."""
    rows = [(c, t, TYPE_CLASSES.get(t, t)) for c, t in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "column string, type string, type_class string")


def column_sets(spark, train_cols: Sequence[str], test_cols: Sequence[str]) -> DataFrame:
    """U4: columns present in one split's file and not the other (schema metadata)."""
    rows = [(c, c in train_cols, c in test_cols) for c in sorted(set(train_cols) | set(test_cols))]
    return spark.createDataFrame(rows, "column string, in_train boolean, in_test boolean") \
        .where(~(F.col("in_train") & F.col("in_test")))


def null_counts(df: DataFrame, split: str, cols: Sequence[str]) -> DataFrame:
    """Per split and column, the NULL count — only columns with NULLs."""
    agg = df.groupBy(split).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.select(split, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("nulls"))
                                                  for c in cols])).alias("_c")).select(split, "_c.*")
    return long.where(F.col("nulls") > 0)


def null_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of NULLs per column (one row, one column per feature)."""
    return df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in cols])


def target_summary(df: DataFrame, y: str) -> DataFrame:
    """A15 + A16 + P24: min, max, mean, median, std, zero share, skew (bias-corrected),
    distinct values, integer-valued flag."""
    d = df.where(F.col(y).isNotNull())
    n = F.count(F.lit(1))
    trunc = F.when(F.col(y) >= 0, F.floor(y)).otherwise(F.ceil(y))
    base = d.agg(F.min(y).alias("min"), F.max(y).alias("max"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
                 F.avg((F.col(y) == 0).cast("double")).alias("zero_share"),
                 F.try_divide(F.skewness(y) * F.sqrt(n * (n - 1)), n - 2).alias("skew"),
                 F.count_distinct(y).cast("bigint").alias("distinct"),
                 F.bool_and(F.abs(F.col(y) - trunc) <= 1e-8 + 1e-5 * F.abs(trunc)).alias("integer_valued"),
                 n.cast("bigint").alias("n"))
    med = exact_median(d, [], y, "median")
    return combine_rows(base, med)


def deciles(df: DataFrame, y: str, probs: Sequence[float] = DECILES) -> DataFrame:
    """Linear-interpolation quantiles as (q, value) rows."""
    names = [f"q{i}" for i in range(len(probs))]
    wide = exact_quantiles(df, [], y, probs, names)
    return wide.select(F.explode(F.array(*[F.struct(F.lit(float(p)).alias("q"), F.col(nm).alias("value"))
                                           for p, nm in zip(probs, names)])).alias("_q")).select("_q.*")


def histogram(df: DataFrame, y: str, bins: int = HIST_BINS, log1p: bool = False) -> DataFrame:
    """Equal-width bins over [min, max] (the max falls in the last bin): (bin, lo, hi, count)."""
    x = F.log1p(y) if log1p else F.col(y)
    d = df.where(F.col(y).isNotNull()).select(x.alias("_x"))
    mm = d.agg(F.min("_x").alias("_mn"), F.max("_x").alias("_mx")).first()      # one row
    j = d.withColumn("_mn", F.lit(mm["_mn"])).withColumn("_mx", F.lit(mm["_mx"]))
    width = F.col("_mx") - F.col("_mn")
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("_x") - F.col("_mn")) / width * bins),
                                                        F.lit(bins - 1))).cast("bigint")
    return (j.withColumn("bin", b).groupBy("bin", "_mn", "_mx").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
            .select("bin", (F.col("_mn") + (F.col("_mx") - F.col("_mn")) * F.col("bin") / bins).alias("lo"),
                    (F.col("_mn") + (F.col("_mx") - F.col("_mn")) * (F.col("bin") + 1) / bins).alias("hi"), "count"))


def length_counts(df: DataFrame, split: str, col: str) -> DataFrame:
    """Value-length counts per split."""
    return df.groupBy(split, F.length(col).cast("bigint").alias("length")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"))


def distinct_by_split(df: DataFrame, split: str, col: str, approximate: bool = False) -> DataFrame:
    """Distinct values per split (``approx_count_distinct`` when ``approximate``)."""
    agg = F.approx_count_distinct(col) if approximate else F.count_distinct(col)
    return df.groupBy(split).agg(agg.cast("bigint").alias("distinct"))


def prefix_cardinality(df: DataFrame, col: str, lengths: Sequence[int] = PREFIX_LENGTHS) -> DataFrame:
    """Distinct prefixes per prefix length."""
    agg = df.agg(*[F.count_distinct(F.substring(col, 1, k)).cast("bigint").alias(f"p{k}") for k in lengths])
    return agg.select(F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("length"),
                                                   F.col(f"p{k}").alias("distinct")) for k in lengths])).alias("_p")) \
        .select("_p.*")


def _by_value(df: DataFrame, split: str, cols: Sequence[str], a: str, b: str) -> DataFrame:
    """Rows per value in split a (``_a``) and split b (``_b``): one grouped pass."""
    return df.groupBy(*cols).agg(F.count_if(F.col(split) == a).alias("_a"), F.count_if(F.col(split) == b).alias("_b"))


def set_overlap(df: DataFrame, split: str, col: str, a: str = "train", b: str = "test") -> DataFrame:
    """U3 + J8: values in both splits / only in a / only in b, share of b's distinct values
    seen in a, and share of b's ROWS whose value was seen in a.  One scan, one shuffle by value:
    every number is a sum over the per-value counts."""
    in_a, in_b = F.col("_a") > 0, F.col("_b") > 0
    seen_rows = F.coalesce(F.sum(F.when(in_a & F.col(col).isNotNull(), F.col("_b"))), F.lit(0))
    return _by_value(df, split, [col], a, b).agg(
        F.count_if(in_a & in_b).cast("bigint").alias("both"),
        F.count_if(in_a & ~in_b).cast("bigint").alias(f"only_{a}"),
        F.count_if(in_b & ~in_a).cast("bigint").alias(f"only_{b}"),
        F.try_divide(F.count_if(in_a & in_b), F.count_if(in_b)).alias(f"share_{b}_distinct_in_{a}"),
        F.try_divide(seen_rows, F.sum("_b")).alias(f"share_{b}_rows_in_{a}"))


def value_counts(df: DataFrame, split: str, cols: Sequence[str] = PROFILE_CATEGORICALS,
                 a: str = "train", b: str = "test") -> DataFrame:
    """A22 + J9: value counts INCLUDING NULL per split, aligned (missing -> 0) with % of rows.

    One pass: unpivot (column, value) and count conditionally per split — the alignment
    that a full outer join would do falls out of the grouped counts."""
    long = df.select(split, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("_v")
    ).select(split, "_v.*")
    sizes = df.agg(F.count_if(F.col(split) == a).alias("_na"), F.count_if(F.col(split) == b).alias("_nb")).first()
    cnt = long.groupBy("column", "value").agg(F.count_if(F.col(split) == a).cast("bigint").alias(f"{a}_count"),
                                              F.count_if(F.col(split) == b).cast("bigint").alias(f"{b}_count"))
    return cnt.select("column", "value", f"{a}_count", f"{b}_count",
                      (F.try_divide(F.col(f"{a}_count"), F.lit(sizes["_na"])) * 100).alias(f"{a}_pct"),
                      (F.try_divide(F.col(f"{b}_count"), F.lit(sizes["_nb"])) * 100).alias(f"{b}_pct"))


def unseen_categories(df: DataFrame, split: str, cols: Sequence[str] = PROFILE_CATEGORICALS,
                      a: str = "train", b: str = "test") -> DataFrame:
    """Non-NULL values present in split b but never in split a, per column (one grouped pass)."""
    long = df.select(split, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("_v")
    ).select(split, "_v.*").where(F.col("value").isNotNull())
    return _by_value(long, split, ["column", "value"], a, b).where("_a = 0 AND _b > 0").select("column", "value")


def day_sets(df: DataFrame, split: str, day: str, a: str = "train", b: str = "test") -> DataFrame:
    """Distinct days per split and days shared by both (one grouped pass)."""
    in_a, in_b = F.col("_a") > 0, F.col("_b") > 0
    return _by_value(df, split, [day], a, b).agg(
        F.count_if(in_a).cast("bigint").alias(f"{a}_days"), F.count_if(in_b).cast("bigint").alias(f"{b}_days"),
        F.count_if(in_a & in_b).cast("bigint").alias("shared_days"))


def hour_distribution(df: DataFrame, split: str, hour: str, a: str = "train", b: str = "test") -> DataFrame:
    """A24 + J9: rows per hour for both splits, aligned with 0 where a split has none."""
    return df.groupBy(hour).agg(F.count_if(F.col(split) == a).cast("bigint").alias(f"{a}_count"),
                                F.count_if(F.col(split) == b).cast("bigint").alias(f"{b}_count"))


def duplicate_share(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(rows - distinct keys) / rows."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.try_divide(F.sum("_n") - F.count(F.lit(1)), F.sum("_n")).alias("duplicate_share"))


def temporal_overlap(df: DataFrame, split: str, t: str, a: str = "train", b: str = "test") -> DataFrame:
    """min/max time per split and the overlap class FUTURE / PAST / OVERLAPPING."""
    mm = df.agg(F.min(F.when(F.col(split) == a, F.col(t))).alias(f"{a}_min"),
                F.max(F.when(F.col(split) == a, F.col(t))).alias(f"{a}_max"),
                F.min(F.when(F.col(split) == b, F.col(t))).alias(f"{b}_min"),
                F.max(F.when(F.col(split) == b, F.col(t))).alias(f"{b}_max"))
    cls = (F.when(F.col(f"{b}_min") > F.col(f"{a}_max"), F.lit("FUTURE"))
           .when(F.col(f"{b}_max") < F.col(f"{a}_min"), F.lit("PAST")).otherwise(F.lit("OVERLAPPING")))
    return mm.withColumn("overlap", cls)
