"""Findings of round 3: what must not grow with the rows in the driver, a task or on disk."""

from pyspark.sql import functions as F

from panelcast.operators.blend import oof_assembly


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_oof_assembly_never_broadcasts_rows(spark):
    """the tables of the assembly grow alike, none may be sent to the driver however small it looks."""
    preds = spark.createDataFrame([(r, f, run, r / 10 + f) for r in range(6) for f in range(2) for run in ("x", "y")], "row_id long, fold int, run string, pred double")
    val = spark.createDataFrame([(2, 0), (3, 0), (4, 1), (5, 1)], "row_id long, fold long")
    rows = spark.createDataFrame([(r, run, float(r)) for r in range(6) for run in ("x", "y")], "row_id long, run string, y double")
    out = oof_assembly(preds, val, rows, keep=["y"], by=["run"])
    assert "Broadcast" not in plan_of(out)
    got = {(r["row_id"], r["run"]): (r["y"], r["fold"], r["oof"]) for r in out.collect()}
    assert len(got) == 12 and got[0, "x"] == (0.0, None, None)
    assert got[3, "y"] == (3.0, 0, 0.3) and got[4, "x"] == (4.0, 1, 1.4)
    assert "Broadcast" not in plan_of(oof_assembly(preds.where("run = 'x'"), val, rows.where("run = 'x'")))


def test_calibration_multiplies_only_unlabelled_rows(spark):
    """Labelled rows are left out before the rows are multiplied by family and fold."""
    from panelcast.plans.q_models import blended_test
    from panelcast.sources import predictions as pr
    panel = spark.createDataFrame([(1, "train", "a", 0.5), (2, "test", "b", None), (None, "test", "c", None)], "Index long, split string, geohash string, demand double")
    out = blended_test(panel, pr.weights_table(spark))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2 and plan.index("Generate explode") < plan.index("(split")   # weights, ids; the filter lies below
    assert [(r["row_id"], r["geohash"]) for r in out.collect()] == [(2, "b")]


def test_encoder_runs_without_the_collector():
    """op3, op7: nothing that a call makes is cyclic; passes of the collector took a tenth of the time."""
    import gc

    from panelcast.llm import bpe_codec, bytebpe
    path, seen = bpe_codec.vocabulary_path(), []

    def value(words):
        seen.append(gc.isenabled())
        return [len(i) // 4 for i in bytebpe.merge_all(words, bytebpe.load(path))]

    enc = bytebpe.Encoder(path, value)
    texts = ["Ab cd's \n x", "", "theathéa éa a1 ...", "  two  spaces ", "Ab cd's"]
    got = [sum(p) for p in enc.pieces(texts, 0, lambda i: 1)]
    assert seen and not any(seen) and gc.isenabled() and enc.opaque
    assert got == [len(i) // 4 for i in bpe_codec.encode_texts(texts, path)]


def test_encoder_memory_holds_the_words_of_the_texts():
    """op3, op7: words are merged once while they fit ``limit``, which each call may set."""
    from panelcast.llm import bpe_codec, bytebpe
    path, merged = bpe_codec.vocabulary_path(), []

    def value(words):
        merged.extend(words)
        return [1] * len(words)

    bytebpe.encoder(path, "test", value, 8)
    for batch in (["x " + " ".join("abcdefghij")], ["x k l m"], ["x " + " ".join("abcdefghij")]):
        bytebpe.encoder(path, "test", value, 100).pieces(batch, 0, lambda i: 1)
    assert len(merged) == len(set(merged)) == 14
    bytebpe._ENCODERS.pop((path, "test"))


def test_parts_share_the_ids_of_their_letters():
    """op1: a part of letters and signs is two pre-tokens; each is put to the library once, whatever parts it stands in."""
    import pyarrow as pa

    from panelcast.llm import token_files

    enc = token_files.ChunkEncoder(token_files.vocabulary_path())
    words, signs = ["Über", "über", "the", "ÀÉ", "don", "naïve"], ["", ".", ",", "!!", "$%&", "-(", "'", "'s", "'S.", "1", ".a", "…", "́", "|>", "İ", "’"]
    odd = ["<|endoftext|>", "a<|endoftext|>", "é\x1c", "é.", "xͅ,", "..", "K", "a\x0b.", "l m", "ŉ.", "ß,", "a<|ENDOFTEXT|>"]
    texts = [w + s for w in words for s in signs] + odd + [" ".join(w + s for w in words for s in signs + odd)]
    put = []
    ask = enc.library
    enc.library = lambda tok, strings: put.extend(strings) or ask(tok, strings)
    for t, got in zip(texts, enc(pa.array(texts))):
        assert got.tolist() == enc.tok.encode(t, add_special_tokens=False).ids, t
    assert put.count("über") == put.count("the") == put.count("!!") == 1 and not {"the.", "the!!", "Über", "Über."} & set(put) and {"über", "the", ".", "!!"} <= set(put)
    small = token_files.ChunkEncoder(token_files.vocabulary_path(), limit=8)          # starts anew again and again
    for t in texts:
        assert small(pa.array([t, None, ""]))[0].tolist() == enc.tok.encode(t, add_special_tokens=False).ids


def test_rows_with_members_are_not_multiplied_with_their_sketches(spark):
    """F10 (F7-F9, F6): the statistics of unexploded rows equal those of exploded ones, and no sketch is copied to every fold."""
    import math

    from panelcast.operators.encode import encode_rows
    values = [0.5, 0.25, None, 1.0, 0.75, 0.125, math.nan, 0.5, 0.0, 2.0, 0.625, 0.5, None, 3.0]
    rows = [(i, f"k{i % 3}" if i % 5 else None, v, [(f, "train" if i < 5 + 3 * f else "val") for f in range(3) if i < 9 + 3 * f] if i else [(0, "test"), (7, "test")])
            for i, v in enumerate(values)] + [(98, "new", None, [(0, "test"), (2, "test")]), (99, "k1", 0.3, None)]
    nested = spark.createDataFrame(rows, "id long, k string, y double, members array<struct<fold:bigint,role:string>>")
    specs = dict(loo_specs=[(("k",), "a"), (("id",), "b")], smoothed_specs=[(("k",), "s")], count_specs=[(("k",), "c")], std_specs=[(("k",), "d")], folds=[0, 1, 2, 3])
    for exact_max in (1, 20):
        got = encode_rows(nested, "y", exact_max=exact_max, **specs)
        flat = encode_rows(nested.selectExpr("id", "k", "y", "inline(members)"), "y", exact_max=exact_max, **specs)
        assert "Generate" not in plan_of(got) and got.columns == flat.columns and dict(got.dtypes) == dict(flat.dtypes)
        key = lambda r: (r["id"], r["fold"])          # noqa: E731
        assert repr(sorted(got.collect(), key=key)) == repr(sorted(flat.collect(), key=key))
    assert encode_rows(nested.limit(0), "y", **specs).count() == 0


def test_runs_share_one_table_of_vectors(spark):
    """The vectors of fewer columns are cut from those of all, nominal features stay nominal."""
    from panelcast.plans.training import fold_vectors, sliced
    rows = spark.createDataFrame([(i, i % 2, "train", i / 2, float(i % 3), None if i == 4 else 2.0 * i, float(i)) for i in range(8)], "id long, fold long, role string, y double, a double, b double, c double")
    data, _ = fold_vectors(rows, ["a", "b", "c"], "y", "id", 8, categorical=["a"])
    cut = sliced(data, ["a", "b", "c"], ["a", "c"])
    alone, _ = fold_vectors(rows, ["a", "c"], "y", "id", 8, categorical=["a"])
    values = lambda d: [(r["id"], r["fold"], list(r["features"].toArray())) for r in d.orderBy("id").collect()]          # noqa: E731
    assert values(cut) == values(alone) and cut.columns == alone.columns
    attrs = cut.schema["features"].metadata["ml_attr"]["attrs"]
    assert attrs["nominal"][0]["num_vals"] == 8 and attrs["nominal"][0]["idx"] == 0 and attrs["numeric"][0]["idx"] == 1
    assert sliced(data, ["a", "b"], ["a", "b"]) is data


def test_last_fold_and_full_fold_are_encoded_together(spark):
    """rows of folds that nobody fits are not encoded, and one pass gives what the two passes gave."""
    from panelcast.operators.encode import encode_rows
    from panelcast.operators.splits import forward_chain_members, full_fit_roles, last_and_full_members
    rows = spark.createDataFrame([(i, "abc"[i % 3] if i % 7 else None, (i * 37 % 11) / 10 if i % 5 else None) for i in range(24)] + [(3, "a", 0.5)], "pos long, k string, y double")
    members = forward_chain_members(rows, 25, 5)
    specs = {"loo_specs": [(("k",), "te")], "smoothed_specs": [(("k",), "sm")], "count_specs": [(("k",), "n")], "std_specs": [(("k",), "sd")]}
    both = encode_rows(last_and_full_members(members, last=4), "y", folds=[4, -1], **specs)
    last = encode_rows(members, "y", folds=[4], **specs).where("fold = 4")
    full = encode_rows(full_fit_roles(rows), "y", folds=[-1], **specs)

    def plain(df, fold):
        cols = ["pos", "k", "y", "role", "te_mean", "te_med", "sm", "n", "sd"]
        return sorted([tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.where(F.col("fold") == fold).select(*cols).collect()], key=repr)

    assert plain(both, 4) == plain(last, 4) and len(plain(last, 4)) == 25
    assert plain(both, -1) == plain(full, -1) and len(plain(full, -1)) == 25
    assert both.count() == 50


def test_full_model_takes_vectors(spark):
    """the full-data model fits the vectors that the folds' fits read."""
    from panelcast.plans.training import GBTParams, assemble, fold_vectors, full_model
    rows = spark.createDataFrame([(i, -1, "train", float(i % 7), float(i % 3), 1.0) for i in range(60)], "id long, fold long, role string, a double, y double, w double")
    params = GBTParams(max_depth=2, min_instances_per_node=1, subsampling_rate=1.0, feature_subset="all")
    data, _ = fold_vectors(rows, ["a"], "y", "id", 8, "w")
    one, two = (full_model(r, ["a"], "y", params, 1, min_rounds=2) for r in (rows, data))
    got = [sorted((r["id"], round(r["prediction"], 9)) for r in m.transform(assemble(rows, ["a"])).collect()) for m in (one, two)]
    assert one.getNumTrees == two.getNumTrees == 2 and got[0] == got[1]


def test_sweep_keeps_one_fold_at_a_time(spark, monkeypatch):
    """all trials of a fold read rows that the executors keep; nothing stays kept afterwards."""
    from panelcast.plans import training
    rows = spark.createDataFrame([(i, f, "train" if i % 3 else "val", float(i % 7), float(i % 5)) for f in range(2) for i in range(90)], "Index long, fold long, role string, x double, y double")
    seen, fit = [], training.fit_with_patience

    def watched(train, val, params, weight=None):
        seen.append("InMemoryRelation" in train._jdf.queryExecution().withCachedData().toString() and "InMemoryRelation" in val._jdf.queryExecution().withCachedData().toString())
        return fit(train, val, params, weight)

    monkeypatch.setattr(training, "fit_with_patience", watched)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    base = training.GBTParams(max_iter=2, patience=1, max_depth=2, min_instances_per_node=1)
    got = training.run_sweep(rows, ["x"], "y", [{"max_depth": 2}, {"max_depth": 3}], base, folds=[0, 1])
    assert seen == [True] * 4
    assert [(r["trial"], r["fold"]) for r in got.collect()] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
