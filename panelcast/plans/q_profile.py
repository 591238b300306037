"""Profile queries (R3 tables) on the cell panel: labelled rows = 'train', unlabelled = 'test'."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.timefeat import add_time_features
from panelcast.operators import profile as pf
from panelcast.operators.lags import lag_block
from panelcast.plans.catalog import query, rounded, rsql
from panelcast.plans.queries import _lag_sql, _panel_sql
from panelcast.schema import LAG_COLS
from panelcast.sources import fixtures as fx
from panelcast.sources.io import scratch_dir, write_panel

PANEL_COLS = ("Index", "geohash", "day", "timestamp", "demand", "RoadType", "NumberofLanes", "LargeVehicles",
              "Landmarks", "Temperature", "Weather")


def _panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_time_features(fx.cell_panel(spark, sf_dir))


def _files(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The panel written as a labelled and an unlabelled file and opened again, schemas from the files."""
    paths = write_panel(fx.cell_panel(spark, sf_dir), scratch_dir(spark, "profile"), fmt="parquet")
    return dict(zip(("train", "test"), map(spark.read.parquet, paths)))


@query("profile_shape", "A35", _panel_sql() + """
SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(CASE WHEN split = 'test' THEN 10 ELSE 11 END AS BIGINT) AS columns
FROM panel GROUP BY split""")
def q_profile_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of both files of the panel, read from the files."""
    return pf.shape_of_files(_files(spark, sf_dir))


@query("profile_dtypes", "A35 U4", fx.with_sql(fx.CELL_PANEL_SQL) + """
SELECT column_name AS "column",
       CASE WHEN column_type = 'VARCHAR' THEN 'string' WHEN column_type IN ('BIGINT', 'INTEGER') THEN 'integer'
            WHEN column_type IN ('DOUBLE', 'FLOAT') THEN 'double' ELSE lower(column_type) END AS type_class,
       TRUE AS in_train, column_name <> 'demand' AS in_test
FROM (DESCRIBE (SELECT * EXCLUDE (split) FROM panel))""")
def q_profile_dtypes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column type classes of both files of the panel and which file has a column, read from the files."""
    return pf.dtypes_of_files(_files(spark, sf_dir))


@query("null_counts", "A14", _panel_sql() + "\nSELECT * FROM (" + "\nUNION ALL\n".join(
    f"SELECT split, '{c}' AS \"column\", CAST(count(*) FILTER (WHERE \"{c}\" IS NULL) AS BIGINT) AS nulls "
    f"FROM panel GROUP BY split" for c in PANEL_COLS) + ") WHERE nulls > 0 AND NOT (split = 'test' AND \"column\" = 'demand')")
def q_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL count per split and column, only columns that have NULLs (target ignored where absent)."""
    p = fx.cell_panel(spark, sf_dir)
    out = pf.null_counts(p, "split", PANEL_COLS)
    return out.where(~((F.col("split") == "test") & (F.col("column") == "demand")))


@query("lag_null_share", "A13", _panel_sql() + ", lg AS (" + _lag_sql(
    "ptt", "geohash", 'p."Index", p.split', "demand", 15) + ")\nSELECT " + ", ".join(
    f"{rsql(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)')} AS {c}" for c in LAG_COLS)
    + " FROM lg WHERE split = 'train'")
def q_lag_null_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of NULLs in every lag / rolling column over labelled rows."""
    p = _panel(spark, sf_dir)
    lg = lag_block(p.select("Index", "geohash", "t", "demand", "split"), "geohash", "t", "demand", 15)
    return rounded(pf.null_share(lg.where(F.col("split") == "train"), LAG_COLS), LAG_COLS)


_SUMMARY_COLS = ("min", "max", "mean", "std", "zero_share", "skew", "median")


def _summary_sql(table: str, y: str, where: str) -> str:
    return f"""SELECT {rsql(f'min({y})')} AS min, {rsql(f'max({y})')} AS max, {rsql(f'avg({y})')} AS mean,
       {rsql(f'stddev_samp({y})')} AS std, {rsql(f'avg(CASE WHEN {y} = 0 THEN 1.0 ELSE 0.0 END)')} AS zero_share,
       {rsql(f'skewness({y})')} AS skew, CAST(count(DISTINCT {y}) AS BIGINT) AS distinct,
       bool_and(abs({y} - trunc({y})) <= 1e-8 + 1e-5 * abs(trunc({y}))) AS integer_valued,
       CAST(count(*) AS BIGINT) AS n, {rsql(f'median({y})')} AS median
FROM {table} WHERE {where} AND {y} IS NOT NULL"""


@query("target_summary", "A15 A16 P24", _panel_sql() + _summary_sql("panel", "demand", "split = 'train'"))
def q_target_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target min/max/mean/median/std, zero share, bias-corrected skew, distinct count, integer flag."""
    p = fx.cell_panel(spark, sf_dir).where(F.col("split") == "train")
    return rounded(pf.target_summary(p, "demand"), _SUMMARY_COLS)


@query("quantity_summary", "A15 A16 P24", _summary_sql("lineitem", "l_quantity", "TRUE"))
def q_quantity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same summary on an integer-valued measure (lineitem quantity)."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return rounded(pf.target_summary(li, "l_quantity"), _SUMMARY_COLS)


@query("target_deciles", "A17", _panel_sql() + "\n" + "\nUNION ALL\n".join(
    f"SELECT CAST({i / 10!r} AS DOUBLE) AS q, {rsql(f'quantile_cont(demand, {i / 10!r})')} AS value "
    f"FROM panel WHERE split = 'train'" for i in range(11)))
def q_target_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciles of the target with linear interpolation (exact, skew-safe)."""
    p = fx.cell_panel(spark, sf_dir).where(F.col("split") == "train")
    return rounded(pf.deciles(p, "demand"), ["value"])


def _hist_sql(x: str, kind: str) -> str:
    return f"""SELECT '{kind}' AS kind, CAST(bin AS BIGINT) AS bin, {rsql('mn + (mx - mn) * bin / 80')} AS lo,
       {rsql('mn + (mx - mn) * (bin + 1) / 80')} AS hi, CAST(count(*) AS BIGINT) AS count
FROM (SELECT CASE WHEN mx = mn THEN 0 ELSE least(floor((x - mn) / (mx - mn) * 80), 79) END AS bin, mn, mx
      FROM (SELECT {x} AS x FROM panel WHERE split = 'train' AND demand IS NOT NULL) d,
           (SELECT min({x}) AS mn, max({x}) AS mx FROM panel WHERE split = 'train' AND demand IS NOT NULL) m)
GROUP BY bin, mn, mx"""


@query("target_histogram", "A18 P19", _panel_sql() + _hist_sql("demand", "raw") + "\nUNION ALL\n"
       + _hist_sql("ln(1 + demand)", "log1p"))
def q_target_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """80-bin equal-width histograms of the target and of log1p(target)."""
    p = fx.cell_panel(spark, sf_dir).where(F.col("split") == "train")
    raw = pf.histogram(p, "demand").withColumn("kind", F.lit("raw"))
    log = pf.histogram(p, "demand", log1p=True).withColumn("kind", F.lit("log1p"))
    return rounded(raw.unionByName(log).select("kind", "bin", "lo", "hi", "count"), ["lo", "hi"])


@query("cell_id_profile", "A19 A20 A21", _panel_sql() + """
SELECT 'length' AS measure, split AS scope, CAST(length(geohash) AS BIGINT) AS k, CAST(count(*) AS BIGINT) AS value
FROM panel GROUP BY ALL
UNION ALL SELECT 'distinct', split, CAST(0 AS BIGINT), CAST(count(DISTINCT geohash) AS BIGINT) FROM panel GROUP BY split
UNION ALL """ + "\nUNION ALL ".join(
    f"SELECT 'prefix', 'train', CAST({k} AS BIGINT), CAST(count(DISTINCT substr(geohash, 1, {k})) AS BIGINT) "
    f"FROM panel WHERE split = 'train'" for k in (3, 4, 5, 6)))
def q_cell_id_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell-id length counts and distinct cells per split; distinct prefixes of length 3-6 (labelled rows)."""
    p = fx.cell_panel(spark, sf_dir)
    lengths = pf.length_counts(p, "split", "geohash").select(
        F.lit("length").alias("measure"), F.col("split").alias("scope"), F.col("length").alias("k"),
        F.col("count").alias("value"))
    distinct = pf.distinct_by_split(p, "split", "geohash").select(
        F.lit("distinct").alias("measure"), F.col("split").alias("scope"), F.lit(0).cast("bigint").alias("k"),
        F.col("distinct").alias("value"))
    prefixes = pf.prefix_cardinality(p.where(F.col("split") == "train"), "geohash").select(
        F.lit("prefix").alias("measure"), F.lit("train").alias("scope"), F.col("length").alias("k"),
        F.col("distinct").alias("value"))
    return lengths.unionByName(distinct).unionByName(prefixes)


@query("cell_overlap", "U3 J8", _panel_sql() + """,
a AS (SELECT DISTINCT geohash FROM panel WHERE split = 'train'),
b AS (SELECT DISTINCT geohash FROM panel WHERE split = 'test')
SELECT (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS both,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_train,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_test,
       """ + rsql("(SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) / (SELECT count(*) FROM b)")
       + """ AS share_test_distinct_in_train,
       """ + rsql("(SELECT count(*) FROM panel WHERE split = 'test' AND geohash IN (SELECT geohash FROM a)) "
                  "/ (SELECT count(*) FROM panel WHERE split = 'test')") + " AS share_test_rows_in_train")
def q_cell_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells in both splits / only one; share of unlabelled cells and rows seen in labelled data."""
    p = fx.cell_panel(spark, sf_dir)
    return rounded(pf.set_overlap(p, "split", "geohash"),
                   ["share_test_distinct_in_train", "share_test_rows_in_train"])


_VC = pf.PROFILE_CATEGORICALS


@query("value_counts", "A22 J9 R3", _panel_sql() + """,
n AS (SELECT count(*) FILTER (WHERE split = 'train') AS na, count(*) FILTER (WHERE split = 'test') AS nb FROM panel),
vc AS (""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, split FROM panel" for c in _VC) + """)
SELECT "column", value, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_count,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_count,
       """ + rsql("count(*) FILTER (WHERE split = 'train') / max(n.na) * 100") + """ AS train_pct,
       """ + rsql("count(*) FILTER (WHERE split = 'test') / max(n.nb) * 100") + """ AS test_pct
FROM vc, n GROUP BY "column", value""")
def q_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and % of every value (NULL included) of 5 categorical columns, aligned across splits."""
    p = fx.cell_panel(spark, sf_dir)
    return rounded(pf.value_counts(p, "split"), ["train_pct", "test_pct"])


@query("unseen_categories", "U5", _panel_sql() + "\n" + "\nUNION ALL\n".join(
    f"(SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM panel WHERE split = 'test' AND {c} IS NOT NULL "
    f"EXCEPT SELECT '{c}', CAST({c} AS VARCHAR) FROM panel WHERE split = 'train' AND {c} IS NOT NULL)"
    for c in _VC + ("geohash", "day")))
def q_unseen_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-NULL values (5 categoricals, cell id, day) that occur only in unlabelled rows."""
    p = fx.cell_panel(spark, sf_dir)
    return pf.unseen_categories(p, "split", _VC + ("geohash", "day"))


@query("day_sets", "A23", _panel_sql() + """,
a AS (SELECT DISTINCT day FROM panel WHERE split = 'train'), b AS (SELECT DISTINCT day FROM panel WHERE split = 'test')
SELECT (SELECT CAST(count(*) AS BIGINT) FROM a) AS train_days, (SELECT CAST(count(*) AS BIGINT) FROM b) AS test_days,
       (SELECT CAST(count(*) AS BIGINT) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS shared_days""")
def q_day_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct dates per split and dates shared by both."""
    return pf.day_sets(fx.cell_panel(spark, sf_dir), "split", "day")


@query("hour_distribution", "A24 J9", _panel_sql() + """
SELECT hour, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train_count,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test_count FROM ptt GROUP BY hour""")
def q_hour_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per hour for both splits (0 where a split has none)."""
    return pf.hour_distribution(_panel(spark, sf_dir), "split", "hour")


@query("duplicate_share", "A25 P22", _panel_sql() + """
SELECT 'cell_panel' AS source, """ + rsql("(count(*) - count(DISTINCT (geohash, day, \"timestamp\"))) / count(*)")
       + """ AS duplicate_share FROM panel WHERE split = 'train'
UNION ALL
SELECT 'lineitem', """ + rsql("(count(*) - count(DISTINCT (l_orderkey, l_linenumber))) / count(*)") + " FROM lineitem")
def q_duplicate_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of rows whose (cell, time) key repeats; the same on lineitem's (order, line) key."""
    p = fx.cell_panel(spark, sf_dir).where(F.col("split") == "train")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    a = pf.duplicate_share(p, ["geohash", "day", "timestamp"]).withColumn("source", F.lit("cell_panel"))
    b = pf.duplicate_share(li, ["l_orderkey", "l_linenumber"]).withColumn("source", F.lit("lineitem"))
    return rounded(a.unionByName(b).select("source", "duplicate_share"), ["duplicate_share"])


@query("temporal_overlap", "A26 P9", _panel_sql() + """
, mm AS (SELECT min(t) FILTER (WHERE split = 'train') AS train_min, max(t) FILTER (WHERE split = 'train') AS train_max,
                min(t) FILTER (WHERE split = 'test') AS test_min, max(t) FILTER (WHERE split = 'test') AS test_max FROM ptt)
SELECT CAST(train_min AS BIGINT) AS train_min, CAST(train_max AS BIGINT) AS train_max,
       CAST(test_min AS BIGINT) AS test_min, CAST(test_max AS BIGINT) AS test_max,
       CASE WHEN test_min > train_max THEN 'FUTURE' WHEN test_max < train_min THEN 'PAST' ELSE 'OVERLAPPING' END AS overlap
FROM mm""")
def q_temporal_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time range of both splits (absolute minutes) and whether the unlabelled part is in the future."""
    out = pf.temporal_overlap(_panel(spark, sf_dir), "split", "t")
    return out.select(*[F.col(c).cast("bigint") for c in ("train_min", "train_max", "test_min", "test_max")], "overlap")
