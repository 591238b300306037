"""Command line: ``python -m panelcast train|score|calibrate|profile|folds``.

Every command reads the labelled and the unlabelled table (CSV with a header, or Parquet) and writes into an
output folder.  The Spark session is the one that ``spark-submit`` or the environment configures.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from panelcast.functions.timefeat import add_time_features
from panelcast.operators.crossperiod import calibrate
from panelcast.operators.splits import fold_report
from panelcast.plans.encodings import cross_period_scale, fold_rows
from panelcast.plans.jobs import score_job, train_job
from panelcast.plans.profile import profile_report
from panelcast.plans.training import GBTParams
from panelcast.schema import PanelSpec
from panelcast.sources import io


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="panelcast")
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("train", "score", "calibrate", "profile", "folds"):
        p = sub.add_parser(name)
        p.add_argument("labelled")
        p.add_argument("unlabelled")
        p.add_argument("out")
        p.add_argument("--format", default="csv", choices=("csv", "parquet"))
        p.add_argument("--target-day", type=int, default=PanelSpec().target_day)
        if name in ("train", "score", "folds"):
            p.add_argument("--folds", type=int, default=5)
        if name == "train":
            p.add_argument("--rounds", type=int)
            p.add_argument("--target-weight", type=float)
            p.add_argument("--no-ablation", action="store_true")
            p.add_argument("--full-data-model", action="store_true")
        if name == "score":
            p.add_argument("--family", action="append", required=True, metavar="NAME=FOLDER")
            p.add_argument("--weight", action="append", default=[], metavar="NAME=WEIGHT")
            p.add_argument("--template")
        if name == "calibrate":
            p.add_argument("predictions", help="CSV of row id and prediction")
        if name in ("score", "calibrate"):
            p.add_argument("--alpha", type=float, default=0.2)
    return top


def run(spark: SparkSession, argv: list[str]) -> DataFrame | None:
    a = parser().parse_args(argv)
    spec = PanelSpec(target_day=a.target_day)
    panel = io.read_panel(spark, a.labelled, a.unlabelled, a.format)
    if a.command == "train":
        params = GBTParams() if a.rounds is None else GBTParams(max_iter=a.rounds)
        out = train_job(panel, spec, params, a.folds, not a.no_ablation, a.full_data_model, out_dir=a.out, target_weight=a.target_weight)
        return out.oof_r2
    if a.command == "score":
        weights = [(n, float(w)) for n, w in (x.split("=", 1) for x in a.weight)]
        table = spark.createDataFrame(weights, "family string, weight double") if weights else None
        return score_job(panel, dict(x.split("=", 1) for x in a.family), spec, a.folds, a.alpha, table, a.out, template=a.template)
    if a.command == "calibrate":
        scale = cross_period_scale(add_time_features(panel, spec), spec)
        cells = panel.where(f"{spec.split} = '{spec.unlabelled}'").select(spec.row_id, spec.entity)
        preds = io.read_submission(spark, a.predictions).join(cells, spec.row_id)
        out = calibrate(preds, scale, spec.entity, spec.target, alpha=a.alpha).select(spec.row_id, spec.target)
        io.write_submission(out, a.out, spec.row_id, spec.target)
        return io.read_submission(spark, a.out)
    if a.command == "profile":
        for name, df in profile_report(panel, spec).items():
            df.write.mode("overwrite").parquet(f"{a.out}/{name}")
        return None
    rows = fold_report(fold_rows(add_time_features(panel, spec), spec, a.folds))
    rows.write.mode("overwrite").option("header", True).csv(a.out)
    return rows


def main() -> None:
    import sys

    spark = SparkSession.builder.appName("panelcast").getOrCreate()
    out = run(spark, sys.argv[1:])
    if out is not None:
        out.show(truncate=False)


if __name__ == "__main__":
    main()
