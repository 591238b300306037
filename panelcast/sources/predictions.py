"""long-form prediction tables derived from the cell panel (FIXTURES.md §F4).

``row_id, run, family, seed, fold, pred`` for labelled rows x families {a, b, c} x folds 0-4,
without (c, 4) so that family ``c`` is incomplete.  Unlabelled rows get the same formula
with the target term 0 (an extension used by the scoring path).  Other runs / seeds only
change the family offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.sources import fixtures as fx

# Fixed values of the fixture.
FAMILY_OFFSETS = {"a": 0.0, "b": 0.01, "c": -0.03}
BLEND_WEIGHTS = {"a": 0.7, "b": 0.3}
RUN_OFFSETS = {"full": 0.0, "ablation": -0.015}
SEED_STEP = 0.005
FOLDS = 5


def prediction_table(panel: DataFrame, runs=("full",), seeds=(42,), labelled_only: bool = True) -> DataFrame:
    """Spark form of F4 over ``panel`` (the cell panel)."""
    rows = panel.where(F.col("split") == "train") if labelled_only else panel
    grid = [(r, f, s, fo) for r in runs for f in FAMILY_OFFSETS for s in seeds for fo in range(FOLDS)
            if not (f == "c" and fo == FOLDS - 1)]
    combos = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(f).alias("family"), F.lit(s).alias("seed"),
                                F.lit(fo).alias("fold"),
                                F.lit(FAMILY_OFFSETS[f] + RUN_OFFSETS[r] + (s - 42) * SEED_STEP).alias("off"))
                       for r, f, s, fo in grid])
    x = rows.select(F.col("Index").alias("row_id"), F.coalesce(F.col("demand"), F.lit(0.0)).alias("_d"),
                    F.explode(combos).alias("_c")).select("row_id", "_d", "_c.*")
    raw = (F.col("_d") * 0.8 + ((F.col("row_id") * (F.col("fold") + 3)) % 97) / 970.0 - 0.02 + F.col("off"))
    return x.select("row_id", "run", "family", F.col("seed").cast("int").alias("seed"),
                    F.col("fold").cast("int").alias("fold"),
                    F.least(F.greatest(raw, F.lit(0.0)), F.lit(1.0)).alias("pred"))


def predictions(spark: SparkSession, sf_dir: str, runs=("full",), seeds=(42,), labelled_only: bool = True):
    return prediction_table(fx.cell_panel(spark, sf_dir), runs, seeds, labelled_only)


def weights_table(spark: SparkSession, weights: dict[str, float] = BLEND_WEIGHTS) -> DataFrame:
    return spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "family string, weight double")


def predictions_sql(runs=("full",), seeds=(42,), labelled_only: bool = True, name: str = "preds") -> str:
    """DuckDB CTE of the same table (needs the cell ``panel`` CTE)."""
    vals = []
    for r in runs:
        for f, off in FAMILY_OFFSETS.items():
            for s in seeds:
                for fo in range(FOLDS):
                    if f == "c" and fo == FOLDS - 1:
                        continue
                    vals.append(f"('{r}', '{f}', {s}, {fo}, {off + RUN_OFFSETS[r] + (s - 42) * SEED_STEP!r})")
    where = "WHERE p.split = 'train'" if labelled_only else ""
    return f"""{name} AS (
  SELECT p."Index" AS row_id, c.run, c.family, CAST(c.seed AS INTEGER) AS seed, CAST(c.fold AS INTEGER) AS fold,
         least(greatest(coalesce(p.demand, 0.0) * 0.8 + ((p."Index" * (c.fold + 3)) % 97) / 970.0 - 0.02 + c.off,
                        0.0), 1.0) AS pred
  FROM panel p, (VALUES {", ".join(vals)}) c(run, family, seed, fold, off) {where}
)"""


WEIGHTS_SQL = "weights AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {v!r})" for k, v in BLEND_WEIGHTS.items()) + ") w(family, weight))"


def sweep_table(per_fold_r2: DataFrame, iters: DataFrame) -> DataFrame:
    """Sweep rows (trial, fold, r2, iters); ``iters`` gives the rounds each fit used.

    For the fixture sweep the rounds come from a rule over the validation-row count of the
    fold: ``(trial*53 + fold*17 + n_val) mod 8200``."""
    j = per_fold_r2.join(F.broadcast(iters), "fold")   # one row per fold
    return j.select("trial", "fold", "r2",
                    ((F.col("trial") * 53 + F.col("fold") * 17 + F.col("n_val")) % 8200).alias("iters"))
