"""Operators 11 to 13 against brute force."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelcast.llm import conversation_repair, dual_tree, repair_grammar, topk_search, vector_codes
from panelcast.llm.repair_grammar import Grammar, meaning, symbol

SYMBOLS = [symbol(i, f) for i in "suao" for f in repair_grammar.FAULTS]


# --- conversation repair -------------------------------------------------------
def brute_repair(rows):
    """Cheapest (cost, audit, turns) of rows (role, text, fault) by trying every edit; short rows only."""
    steps = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @lru_cache(maxsize=None)
    def go(i, state, inserted):
        best = (0, "", ()) if i == len(rows) and state in ("", "a") else None
        tries = []
        if inserted < 3:
            tries += [(2, "I", (name, ""), i, steps[state][x], inserted + 1) for x, name in (("u", "user"), ("a", "assistant")) if x in steps[state]]
        if i < len(rows):
            role, text, fault = rows[i]
            tries.append((3, "D", None, i + 1, state, 0))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] in steps[state]:
                    tries.append((extra, "K", (role, text), i + 1, steps[state][role[:1]], 0))
                tries += [(2 + extra, "R", (name, text), i + 1, steps[state][x], 0) for x, name in (("u", "user"), ("a", "assistant")) if x in steps[state]]
        for cost, edit, line, j, after, ins in tries:
            rest = go(j, after, ins)
            if rest is not None:
                found = (cost + rest[0], edit + rest[1], ((line,) if line else ()) + rest[2])
                best = found if best is None or found[:2] < best[:2] else best
        return best

    return go(0, "", 0)


def brute_conversation(rows):
    """Result row of damaged rows (turn, role, text), as the operator's docstring defines it."""
    dig = lambda r: hashlib.sha256(f"{len(r[1])}\x00{r[1]}\x00{r[2]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], dig(r)))
    seen, marked = set(), []
    for turn, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    cost, audit, lines = brute_repair(tuple(marked))
    turns = [t for t, _, _ in rows if t is not None]
    count = lambda f: sum(m[2] == f for m in marked)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest())


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            text = "" if kind == 1 else text.translate(str.maketrans("", "", ".!?")) if kind == 2 else text
            kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(SYMBOLS), max_size=9), st.lists(st.tuples(st.sampled_from(SYMBOLS), st.sampled_from(SYMBOLS)), max_size=4, unique=True))
def test_matrices_against_every_edit(symbols, pairs):
    rules = ["".join(p) for p in pairs]
    rules += [chr(repair_grammar.RULE) + rules[0][0]] if rules else []
    want = brute_repair(tuple(({"s": "system", "u": "user", "a": "assistant", "o": "tool"}[i], "x", f) for i, f in map(meaning, symbols)))
    text = "".join(symbols)
    for pieces in ([text], list(text), [text[:4], text[4:]]):
        assert Grammar(rules).repair([p for p in pieces if p]) == want[:2]


def test_pairs_and_batches():
    counts = {}
    repair_grammar.pair_counts("AAAA", 2, counts)
    repair_grammar.pair_counts("ABAB", 1, counts)
    assert counts == {"AA": 4, "AB": 2, "BA": 1}
    assert repair_grammar.batch_of([("AB", 5), ("BA", 9), ("BC", 4), ("DD", 2)]) == ["BA", "BC", "DD"]
    g = Grammar(["AB", chr(repair_grammar.RULE) * 2])
    assert g.packed("ABABAB") == chr(repair_grammar.RULE + 1) + chr(repair_grammar.RULE)


def test_ropes_compare_without_flattening():
    shared = ("KD", ("R", "I"))
    assert repair_grammar.before((shared, "D"), (shared, "K")) and not repair_grammar.before((shared, "K"), (shared, "K"))
    assert repair_grammar.before("KDR", (shared, "")) and repair_grammar.flat((shared, "D")) == "KDRID"


def conversations():
    rng, rows = random.Random(5), []
    roles = ["system", "user", "assistant", "tool", "", "u2", None]
    texts = ["Yes.", "no", " \t\x0b", "", None, "Long! ", "why?\n", "x" * 50_000, "é…", "a:b\nc."]
    for conv in [*range(60), None]:
        for turn in range(rng.randint(0, 8)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 9, turn - 1, None]), rng.choice(roles[:3] if rng.random() < .7 else roles), rng.choice(texts)))
    rows += [(7, 3, "user", "Yes.")] * 3
    for conv in range(100, 130):                                   # each with a single row: some lose it
        rows.append((conv, 0, "user", "Hello."))
    return rows


CONV = "conv_id long, turn long, role string, text string"
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check_repair(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], CONV + ", audit string, digest string, lead int")     # clashing names
    got = {r["conv_id"]: tuple(r[n] for n in NAMES) for r in conversation_repair.repair(conversation_repair.damaged(df)).collect()}
    assert got == {c: brute_conversation(kept) for c, kept in brute_damage(rows).items()}


def test_repair_against_brute_force(spark):
    rows = conversations()
    random.Random(1).shuffle(rows)
    assert any(not kept for kept in brute_damage(rows).values())
    check_repair(spark, rows)


def test_one_conversation_over_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "PIECE", 4)
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), f"{rng.randrange(40)}{rng.choice('.x')}") for t in range(120)]
    rows += [(2, t // 50, "user", "Same.") for t in range(100)] + [(3, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(4)]
    check_repair(spark, rows)


def test_repair_of_nothing(spark):
    out = conversation_repair.repair(conversation_repair.damaged(spark.createDataFrame([], CONV)))
    assert out.columns == ["conv_id", *NAMES] and not out.collect()


# --- vector codes ----------------------------------------------------------------
def brute_codes(vectors, parts=16, entries=64, rounds=2):
    """vectors: (id, list) in the order of id; equal lengths, a multiple of ``parts``."""
    ints = np.floor(np.array([v for _, v in vectors], float) * 256).astype(int).reshape(len(vectors), parts, -1)
    books = ints[:entries].copy()
    near = lambda: ((ints[:, None] - books[None]) ** 2).sum(-1)
    for _ in range(rounds):
        code = near().argmin(1)
        for p in range(parts):
            for e in set(code[:, p]):
                rows = ints[code[:, p] == e, p]
                books[e, p] = rows.sum(0) // len(rows)
    d = near()
    code = d.argmin(1)
    digest = hashlib.sha256(",".join(str(x) for x in books.transpose(1, 0, 2).ravel()).encode()).hexdigest()
    return {i: (bytes(c.tolist()).hex(), int(d[r].min(0).sum()), digest) for r, ((i, _), c) in enumerate(zip(vectors, code))}


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(1, 70), st.integers(1, 5), st.sampled_from([1, 3, 300, 10**6]), st.integers(0, 99))
def test_dual_tree_against_all_distances(n, k, w, spread, seed):
    rng = np.random.default_rng(seed)
    middles = rng.integers(-spread, spread + 1, (3, 8, w))
    points = middles[:, rng.integers(0, 8, n)] + rng.integers(-2, 3, (3, n, w))
    entries = points[:, rng.integers(0, n, k)] + rng.integers(-1, 2, (3, k, w))         # many equal ones
    code, count, total, _ = dual_tree.nearest(points, entries, leaf=4)
    want = ((points[:, :, None] - entries[:, None]) ** 2).sum(-1).argmin(2)
    assert (code == want).all()
    for p in range(3):
        assert (np.bincount(want[p], minlength=k) == count[p]).all()
        for e in range(k):
            assert (total[p, e] == points[p, want[p] == e].sum(0)).all()


def test_most_points_are_assigned_by_whole_nodes():
    rng = np.random.default_rng(3)
    middles = rng.integers(-10**6, 10**6, (16, 64, 4))
    points = middles[:, rng.integers(0, 64, 4096)] + rng.integers(-50, 50, (16, 4096, 4))
    stats = dual_tree.nearest(points, middles)[3]
    assert stats["whole"] > stats["leaf"] and stats["pairs"] < 16 * 4096 * 64 // 10


def test_leaves_in_small_steps(monkeypatch):
    monkeypatch.setattr(dual_tree, "STEP", 50)
    rng = np.random.default_rng(4)
    points, entries = rng.integers(-5, 6, (2, 300, 3)), rng.integers(-5, 6, (2, 20, 3))
    assert (dual_tree.nearest(points, entries)[0] == ((points[:, :, None] - entries[:, None]) ** 2).sum(-1).argmin(2)).all()


VEC = "vec_id long, embedding array<float>, label int"


def vectors(n, width, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in np.float32(rng.normal(0, .2, width))]) for i in range(n)]


def test_codes_against_brute_force(spark):
    good = vectors(300, 32)
    bad = [(1000, None, 1), (1001, [float("nan")] * 32, 1), (1002, [float("inf")] + [0.0] * 31, None), (1003, [None] * 32, 2)]
    rows = [(i, v, None if i % 5 == 0 else i % 3) for i, v in good] + bad
    df = spark.createDataFrame([(*r, "z", 5) for r in rows], VEC + ", code string, error int")
    got = vector_codes.compress(df.repartition(5)).collect()
    want = brute_codes(good)
    assert {r["vec_id"]: (r["code"], r["error"], r["codebooks_sha256"]) for r in got} == want
    labels = {i: lab for i, _, lab in rows}
    for r in got:
        assert r["label_error"] == sum(want[i][1] for i in want if labels[i] == labels[r["vec_id"]])


def test_codes_of_few_rows_ties_and_other_lengths(spark):
    few = vectors(5, 16, 1) + [(5, [0.1] * 16), (6, [0.1] * 16)]
    got = vector_codes.compress(spark.createDataFrame([(i, v, 0) for i, v in few], VEC)).collect()
    assert {r["vec_id"]: (r["code"], r["error"], r["codebooks_sha256"]) for r in got} == brute_codes(few)
    odd = [(0, [0.5] * 20, 0), (0, [0.5] * 20, 0), (None, [], None), (3, [0.25], 1)]
    padded = [(k, v + [0.0] * (32 - len(v))) for k, v in enumerate(([0.5] * 20, [0.5] * 20, [0.25], []))]
    got = vector_codes.compress(spark.createDataFrame(odd, VEC)).collect()
    assert sorted((r["code"], r["error"], r["codebooks_sha256"]) for r in got) == sorted(brute_codes(padded).values())


def test_codes_of_huge_numbers_and_of_nothing(spark):
    df = spark.createDataFrame([(i, [float(10 ** (9 + i))] * 16, 0) for i in range(6)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in vector_codes.compress(df).collect()}
    assert [got[i]["code"] for i in range(6)] == [f"{i:02x}" * 16 for i in range(6)] and got[0]["error"] == 0
    assert not vector_codes.compress(spark.createDataFrame([(1, None, 2)], VEC)).collect()
    assert not vector_codes.compress(spark.createDataFrame([], VEC)).collect()


# --- top-k search ------------------------------------------------------------------
def brute_top(rows, every, k=5):
    ok = [(i, [int(np.floor(float(x) * 256)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(ok):
        if i is not None and i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(v, u)), j is None, j or 0) for b, (j, u) in enumerate(ok) if a != b)[:k]
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(scored)]
    return sorted(out, key=str)


def check_top(spark, rows, every=5, kind="float", **more):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, rank int, score string")
    got = topk_search.top_k(df.repartition(4), lambda i: i % every == 0, **more).collect()
    assert sorted(map(tuple, got), key=str) == brute_top(rows, every)


def test_search_against_brute_force(spark):
    rows = vectors(400, 12)
    rows += [(400 + i, v) for i, v in rows[:40]]                                      # equal scores
    rows += [(7, rows[7][1]), (10, rows[10][1]), (None, rows[3][1]), (901, None), (905, [float("nan")] * 12), (906, [None] * 12), (910, []), (915, [1.0, 2.0])]
    check_top(spark, rows)
    check_top(spark, rows, group_rows=20, parts=3)


def test_search_of_few_huge_and_no_rows(spark):
    check_top(spark, vectors(4, 3))
    check_top(spark, [(0, [1.0])])
    check_top(spark, [])
    check_top(spark, [(i, [0.0, 0.0]) for i in range(30)])                            # all tie
    check_top(spark, [(i, [float(i) * 2**17 + .3, -(2.0**18) * i, 1.0]) for i in range(20)], kind="double")
    huge = spark.createDataFrame([(0, [1e300]), (1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in topk_search.top_k(huge, lambda i: i == 0).collect()] == [(0, 1, 1, 2**63 - 1), (0, 2, 2, 1 - 2**63)]


def test_threshold_leaves_rows_out():
    rng = np.random.default_rng(0)
    rows, q = rng.integers(-60, 60, (5000, 64)), rng.integers(-60, 60, (1, 64))
    parts = [s[0] for s in topk_search.part_scores(q, rows, 4)]
    total = rows @ q[0]
    cut = int(np.sort(total)[-5])
    seats, found = topk_search.collect(parts, -1, cut)
    assert sorted(seats) == sorted(np.flatnonzero(total >= cut)) and [int(x) for x in found] == [int(total[s]) for s in seats]
    seats, found = topk_search.gather(parts, -1, 5)
    assert len(seats) <= 4 * 6 and sorted(found)[-5] <= cut
