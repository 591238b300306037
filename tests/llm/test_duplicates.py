"""Operators 4, 6, 10, the components and the pipeline against brute force."""

import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import SF

import corpus_pipeline
from panelcast.llm import cgk, decontaminate, minhash_forest, repeats, suffix_dedup
from panelcast.llm.common import saved, table
from panelcast.llm.components import components
from panelcast.llm.shingles import shingle_set

SCHEMA = "doc_id long, text string, th string, spans int, component string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


# --- near duplicates ---------------------------------------------------------
def brute_components(rows, percent=85):
    sets = {i: frozenset(shingle_set(t).tolist()) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_a_dense_region_rules_pairs_out_inside():
    """Classes of one template, all below the threshold: none of their pairs leaves the region; true links do."""
    rng, base = random.Random(3), prose(random.Random(4), 400).split()
    texts = []
    for _ in range(60):
        w = list(base)
        for p in rng.sample(range(400), 7):
            w[p] = prose(rng, 1)
        texts.append(" ".join(w))
    texts += [t.replace(" ", "  ", 1) + " q" for t in texts[:5]]
    sets = [shingle_set(t) for t in texts]
    links = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if 100 * (n := len(np.intersect1d(sets[i], sets[j]))) >= 85 * (len(sets[i]) + len(sets[j]) - n)}
    share = [len(np.intersect1d(sets[0], s)) / len(np.union1d(sets[0], s)) for s in sets[1:60]]
    assert 0.6 < np.mean(share) < 0.78 and links == {(i, 60 + i) for i in range(5)}
    sign = minhash_forest.MinHash(minhash_forest.LONG, seed=2)
    sigs = np.array([sign(s) & np.uint32(255) for s in sets])
    ids = np.arange(len(sets))
    found = minhash_forest.forest_pairs(ids, sigs, ids, minhash_forest.bound(85, minhash_forest.LONG), np.array([len(s) for s in sets]))
    assert links <= set(found) and len(found) < 2 * len(sets)


def near_rows(seed=1, copies=60):
    rng, rows = random.Random(seed), []
    for g in range(12):
        base = prose(rng, rng.randint(3, 150)).split()
        for _ in range(copies if g == 0 else rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = prose(rng, 1)
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows + ["", " ", "one two", "One  TWO", "one two three"], 10))


@pytest.mark.parametrize("region", [256, 8])
def test_components_equal_brute_force(spark, monkeypatch, region):
    monkeypatch.setattr(minhash_forest, "REGION", region)
    rows = near_rows()
    want = brute_components(rows)
    out = minhash_forest.near_duplicates(frame(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want
    assert all(r["kept"] == (r["doc_id"] == want[r["doc_id"]]) for r in out)
    assert {r["doc_id"]: r["n_shingles"] for r in out} == {i: len(shingle_set(t)) for i, t in rows}


def test_dense_regions_keep_pairs_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(minhash_forest, "REGION", 4)
    rng, rows = random.Random(5), []
    template = prose(rng, 600).split()

    def edited(words, n):
        out = list(words)
        for i in rng.sample(range(len(out)), n):
            out[i] = prose(rng, 1) + "x"
        return out

    pages = [edited(template, 7) for _ in range(220)]
    rows = [" ".join(w) for w in pages] + [" ".join(edited(w, 8)) for w in pages[:30]]
    rows = list(enumerate(rows, 1))
    want = brute_components(rows)
    assert len({c for c in want.values()}) > 150 and sum(i != c for i, c in want.items()) >= 30
    out = minhash_forest.near_duplicates(frame(spark, rows)).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want


def test_near_duplicates_edge_cases(spark):
    rows = frame(spark, [(1, None), (2, ""), (None, "a b c"), (4, "a b c"), (5, "A b C"), (5, "A b C"), (5, "other text"), (7, "w " * 100_000)])
    out = minhash_forest.near_duplicates(rows).collect()
    assert Counter((r["doc_id"], r["component_id"], r["kept"]) for r in out) == Counter({(1, 1, True): 1, (2, 2, True): 1, (None, None, True): 1, (4, 4, True): 1, (5, 4, False): 2, (5, 5, True): 1, (7, 7, True): 1})
    left = minhash_forest.keep_one(rows.union(rows.where("doc_id = 7")))
    assert left.columns == rows.columns and Counter(r["doc_id"] for r in left.collect()) == Counter([1, 2, None, 4, 5, 7])
    assert minhash_forest.near_duplicates(rows.limit(0)).count() == 0


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated passages -------------------------------------------------------
def brute_cover(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + span] for r in raw for i in range(len(r) - span + 1))
    out = []
    for r in raw:
        cover = np.zeros(len(r), bool)
        for i in range(len(r) - span + 1):
            if seen[r[i:i + span]] > 1:
                cover[i:i + span] = True
        out.append(cover)
    return out


def repeat_texts(seed):
    rng = random.Random(seed)
    shared = [prose(rng, rng.randint(30, 160)) for _ in range(4)]
    texts = [prose(rng, rng.randint(0, 80)) + (" é日本 " if rng.random() < 0.3 else "") + (rng.choice(shared) if rng.random() < 0.7 else "") + prose(rng, rng.randint(0, 60)) for _ in range(40)]
    return texts + [texts[0], "ab" * 900, "x" * 1500, "x" * 399, "x" * 400, None, ""]


@pytest.mark.parametrize("heavy", [10_000, 0])
def test_spans_equal_brute_force(spark, heavy):
    texts = repeat_texts(3)
    want = brute_cover(texts, 400)
    out = suffix_dedup.with_spans(frame(spark, list(enumerate(texts))), heavy=heavy).collect()
    for r in out:
        got = np.zeros(len((texts[r["doc_id"]] or "").encode()), bool)
        for lo, hi in suffix_dedup.cover(r["spans"]):
            got[lo:hi] = True
        assert (got == want[r["doc_id"]]).all(), r["doc_id"]
    assert len(out) == len(texts) and sum(w.any() for w in want) > 15


def test_a_repeated_line_is_one_row_of_a_text(spark):
    line = prose(random.Random(8), 90) + "\n"
    rows = suffix_dedup.segments(suffix_dedup.named(frame(spark, [(1, line * 300), (2, line * 300)])), 400).collect()
    assert len(rows) < 40 and max(len(r["places"]) for r in rows) > 290
    assert len({(r["doc_id"], r["gram"], r["seg"]) for r in rows}) == len(rows) and all(r["places"] == sorted(r["places"]) for r in rows)


def test_cutting_keeps_whole_characters_and_columns(spark):
    text = "日本語テキスト" * 80
    rows = frame(spark, [(1, "é" + text), (2, "ñ" + text), (3, None), (None, "short"), (5, "é" + text), (5, "é" + text)])
    out = suffix_dedup.deduplicated(rows)
    assert out.columns == rows.columns
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert (3, None) in got and (None, "short") in got and (5, "") in got and all(len(t or "") < 10 for _, t in got)
    assert suffix_dedup.deduplicated(rows.limit(0)).count() == 0


def test_anchors_of_long_texts_are_cut_in_blocks(monkeypatch):
    raw = prose(random.Random(5), 900).encode()
    _, _, lo, hi = repeats.anchors(raw)
    monkeypatch.setattr(repeats, "_BLOCK", 700)
    _, a, lo2, hi2 = repeats.anchors(raw)
    for x, y in ((lo, hi), (lo2, hi2)):
        assert x[0] == 0 and y[-1] == len(raw) - repeats.SPAN and (x[1:] == y[:-1] + 1).all()
    assert (a >= lo2).all() and (a + repeats.gram_length(repeats.SPAN) <= lo2 + repeats.SPAN).all()


def test_interval_tree_of_a_suffix_array():
    text = b"mississippi"
    order = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [0] + [repeats.common(*(np.frombuffer(text[i:], np.uint8) for i in p)) for p in zip(order, order[1:])]
    found = {(n, tuple(sorted(order[lo:hi + 1]))) for n, lo, hi in repeats.interval_tree(lcp)}
    assert found == {(1, (1, 4, 7, 10)), (4, (1, 4)), (1, (8, 9)), (1, (2, 3, 5, 6)), (2, (3, 6)), (3, (2, 5))}


# --- decontamination ---------------------------------------------------------
def edited(rng, words, k):
    w = list(words)
    for _ in range(k):
        p, kind = rng.randrange(len(w)), rng.random()
        if kind < 0.34:
            w[p] = prose(rng, 1)
        elif kind < 0.67:
            del w[p]
        else:
            w.insert(p, prose(rng, 1))
    return w


def test_recall_at_the_largest_distance_and_no_false_hits():
    rng = random.Random(7)
    items = [(i, prose(rng, rng.randint(8, 60))) for i in range(40)]
    match = decontaminate.Matcher(items)
    texts = [" ".join([prose(rng, 50), *edited(rng, t.split(), int(0.2 * len(t.split()))), prose(rng, 50)]) for _, t in items for _ in range(5)]
    hits = {(d, i) for d, i, *_ in match(texts)}
    assert np.mean([(k, k // 5) in hits for k in range(len(texts))]) >= 0.95
    assert match([prose(rng, 300) for _ in range(50)]) == []
    exact = match(["x y " + t.upper() + " z" for _, t in items])
    assert {(d, i, n) for d, i, n, *_ in exact} >= {(k, k, 0) for k in range(40)}


def test_short_items_are_found_exactly():
    match = decontaminate.Matcher([(1, "Q"), (2, "r s"), (3, "r s"), (4, "t u v w"), (5, "one two three four five")])
    texts = ["a b", "q a q", "R  s x r s", "t u v", "z t u v w", None, "", "r", "one two x four five", "q"]
    assert sorted(match(texts)) == [(1, 1, 0, 1, 0, 1), (2, 2, 0, 2, 0, 2), (2, 3, 0, 2, 0, 2), (4, 4, 0, 4, 1, 4), (8, 5, 1, 5, 0, 5), (9, 1, 0, 1, 0, 1)]


def test_decontamination_against_all_windows():
    """Every window of every text against every item: nothing false, at least 0.95 found, distances near the least."""
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(2, 40))) for i in range(30)]
    items += [(100, items[3][1]), (101, " ".join(edited(rng, items[8][1].split(), 2)))]
    texts = []
    for k in range(120):
        w = items[rng.randrange(len(items))][1].split()
        texts.append(" ".join([prose(rng, rng.randint(0, 60)), *edited(rng, w, rng.randint(0, len(w) // 3)), prose(rng, rng.randint(0, 60))]))
    want = {}
    for d, text in enumerate(texts):
        words = np.array([hash(w) for w in text.split()], np.int64)
        for i, t in items:
            item = np.array([hash(w) for w in t.split()], np.int64)
            most = int(0.2 * len(item)) if len(item) >= 5 else 0
            least = min(cgk.edit_distance(item, words[at:], most)[0] for at in range(len(words)))
            if least <= most:
                want[d, i] = least
    got = {(d, i): k for d, i, k, *_ in decontaminate.Matcher(items)(texts)}
    assert set(got) <= set(want) and len(want) > 60
    assert len(got) >= 0.95 * len(want) and all(k >= want[x] for x, k in got.items())
    assert np.mean([k == want[x] for x, k in got.items()]) > 0.9


def test_edit_distance_against_the_table():
    rng = random.Random(1)
    for _ in range(100):
        a, b = ([rng.randint(1, 4) for _ in range(rng.randint(1, 9))] for _ in range(2))
        d = np.add.outer(np.arange(len(a) + 1), np.arange(len(b) + 1))
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        got, n = cgk.edit_distance(np.array(a, np.uint64), np.array(b, np.uint64), 20)
        assert got == d[-1].min() and d[-1, n] == got


def test_decontamination_edge_cases(spark):
    docs = frame(spark, [(1, None), (2, ""), (None, "q r s t u v w"), (4, "a " * 50_000 + "q r s t u v w"), (4, "a " * 50_000 + "q r s t u v w"), (5, "clean words only here")])
    bench = spark.createDataFrame([(1, "Q R s t u v w", 0), (2, None, 0), (3, "a b", 0), (None, "q r s t u v w", 0), (5, "", 0)], "item_id long, text string, doc_id int")
    got = Counter((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.contaminated(docs, bench, block_bytes=10).collect())
    assert got == Counter({(None, 1, 0): 1, (None, None, 0): 1, (4, 1, 0): 2, (4, None, 0): 2})
    left = decontaminate.clean(docs, bench, block_bytes=10)
    assert left.columns == docs.columns and [r["doc_id"] for r in left.sort("doc_id").collect()] == [1, 2, 5]
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0 and decontaminate.contaminated(docs.limit(0), bench).count() == 0


# --- pipeline ----------------------------------------------------------------
def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = saved(stage(spark, docs, SF), "test")
        seen[name] = (before.toPandas(), docs.toPandas())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == table(spark, SF, "documents").columns
    before, after = seen["quality classifier"]
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id").quality
    good = [i for i in before.doc_id if labels.get(i) == 1]
    assert np.mean([i in set(after.doc_id) for i in good]) > 0.97
    before, after = seen["MinHash near-dedup"]
    parts = brute_components(list(zip(before.doc_id, before.text)), corpus_pipeline.SIMILAR)
    assert sorted(after.doc_id) == sorted(i for i, c in parts.items() if i == c)
    before, after = seen["suffix-array dedup"]
    texts = dict(zip(after.doc_id, after.text))
    assert len(before) == len(after) and (after.n_chars == after.text.str.len()).all()
    for i, t, cover in zip(before.doc_id, before.text, brute_cover(list(before.text), corpus_pipeline.PASSAGE)):
        if not cover.any():
            assert texts[i] == t
        else:
            assert len(texts[i].encode()) >= (~cover).sum() and len(texts[i]) < len(t)
    before, after = seen["benchmark decontamination"]
    bench = [" ".join(t.lower().split()) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    dirty = {i for i, t in zip(before.doc_id, before.text) if any(b in " ".join(t.lower().split()) for b in bench)}
    assert not dirty & set(after.doc_id) and len(set(before.doc_id) - set(after.doc_id) - dirty) <= 1
    before, after = seen["BPE encoding and decoding"]
    assert len(before) == len(after) and (after.ids.str.len() == 4 * after.n_tokens).all()
