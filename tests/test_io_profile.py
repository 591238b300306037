"""Readers/writers, model persistence and the composite profile report."""

import pytest
from pyspark.sql import functions as F

from conftest import SF
from panelcast.plans.profile import profile_report
from panelcast.sources import fixtures as fx
from panelcast.sources import io


def test_submission_and_params_roundtrip(spark):
    sub = spark.createDataFrame([(1, 0.25), (2, 0.5)], "Index long, demand double")
    path = io.write_submission(sub, io.scratch_dir(spark, "t-sub"))
    back = io.read_submission(spark, path)
    assert sorted(map(tuple, back.collect())) == [(1, 0.25), (2, 0.5)]
    assert io.template_columns(spark, path) == ["Index", "demand"]
    p = io.write_params(spark, {"max_depth": 5, "step_size": 0.1}, io.scratch_dir(spark, "t-params"))
    assert io.read_params(spark, p) == {"max_depth": 5, "step_size": 0.1}


def test_model_save_load_and_missing_family(spark):
    from panelcast.plans.training import GBTParams, assemble, load_models, save_models
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(40)], "x double, label double")
    m = GBTParams(max_iter=2, max_depth=2, min_instances_per_node=1).estimator().fit(assemble(df, ["x"]))
    folder = io.scratch_dir(spark, "t-models")
    save_models([m, m], folder)
    assert len(load_models(folder, 2)) == 2
    assert load_models(folder, 3) is None                   # fold 2 missing -> family skipped


def test_profile_report_tables(spark):
    rep = profile_report(fx.cell_panel(spark, SF), fx.EVENTS_SPEC)
    assert rep["overlap"].first()["overlap"] == "FUTURE"
    assert rep["shape"].count() == 2 and rep["deciles"].count() == 11
    assert rep["duplicates"].first()["duplicate_share"] == 0.0
    assert rep["histogram"].agg(F.sum("count")).first()[0] == rep["target"].first()["n"]


def test_schemas_come_from_the_files(spark):
    from panelcast.operators import profile as pf
    folder = io.scratch_dir(spark, "t-files")
    spark.createDataFrame([(1, "a", 0.5), (2, None, 0.1)], "Index long, road string, demand double").write.parquet(f"{folder}/a")
    spark.createDataFrame([(3, 1, 2)], "Index long, road int, extra int").write.parquet(f"{folder}/b")
    files = {"a": spark.read.parquet(f"{folder}/a"), "b": spark.read.parquet(f"{folder}/b")}
    assert sorted(map(tuple, pf.shape_of_files(files).collect())) == [("a", 2, 3), ("b", 1, 3)]
    got = sorted(map(tuple, pf.dtypes_of_files(files).collect()))
    assert got == [("Index", "integer", True, True), ("demand", "double", True, False), ("extra", "integer", False, True),
                   ("road", "integer", False, True), ("road", "string", True, False)]


def test_saved_gains_equal_the_node_walk(spark):
    """Gains from the node tables, held against Spark ML's own importances (each tree's shares, then their mean)."""
    import random
    from panelcast.plans.training import GBTParams, assemble, save_models, saved_gains
    rng = random.Random(2)
    rows = [(rng.random(), rng.random(), 1.0) for _ in range(300)]
    df = spark.createDataFrame([(a, b, c, 3 * a + b * b) for a, b, c in rows], "a double, b double, c double, label double")
    m = GBTParams(max_iter=1, max_depth=3, min_instances_per_node=5, subsampling_rate=1.0, feature_subset="all").estimator().fit(assemble(df, ["a", "b", "c"]))
    folder = io.scratch_dir(spark, "t-gains")
    save_models([m, m], folder)
    got = saved_gains(spark, folder, 2, ["a", "b", "c"]).toPandas()
    assert len(got) == 6 and set(got[got.feature == "c"].gain) == {0.0}
    one = got[got.fold == 1].set_index("feature").gain
    want = list(m.featureImportances.toArray()) + [0.0] * 3
    assert [one[c] / one.sum() for c in "abc"] == pytest.approx(want[:3])


def test_intermediate_tables_can_be_dropped(spark):
    from panelcast.session import cut_lineage, drop_tables
    from pyspark.errors import AnalysisException
    df = cut_lineage(spark.range(3).toDF("x"))
    path = spark.sparkContext._panelcast_tables[-1]
    assert df.count() == 3 and spark.read.parquet(path).count() == 3
    kept, spark.sparkContext._panelcast_tables = spark.sparkContext._panelcast_tables[:-1], [path]
    assert drop_tables(spark) == 1 and drop_tables(spark) == 0
    spark.sparkContext._panelcast_tables = kept
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
