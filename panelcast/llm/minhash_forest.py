"""Operator 10: near duplicates with an LSH forest of MinHash signatures.

1. Each text becomes its set of distinct 5-word shingles.  Equal sets are one class, named by its
   smallest doc_id; only classes go on, so groups of copies cost one row.
2. A signature of ``TREES * FIRST`` minima is read in ``TREES`` cyclic orders, each beginning at another
   place.  In an order, classes whose signatures share a prefix lie next to each other when sorted.  A
   region is the set of classes with a common prefix; the prefix starts at ``FIRST`` minima and is
   extended where more than ``REGION`` classes share it, so the depth follows the density.
3. Inside a region signatures are compared; pairs above a bound four standard errors below the
   threshold are candidates.  A region first emits a spanning forest of its candidates, strongest
   pairs first (longest common prefixes and best agreement), never all its pairs.
4. Candidates are confirmed on the full shingle sets: 100 * intersection >= 85 * union.
5. Confirmed links give components.  Then regions that touch several components look at every pair
   between different ones: set sizes and a longer sketch of ``LONG`` minima, bound as in 3, rule pairs
   out inside the region; the others are confirmed too, and components are final.

A deeper prefix alone loses pairs that met at ``FIRST`` minima and part further down.  So the classes of
regions that are too large at ``FIRST`` (dense classes) also meet by an exact filter in step 5: sets at the
threshold share one of the first n - ceil(85 % of n) + 1 shingles in any common order.  The order is rarest
first, by counts among the dense classes, so shingles of a template come last.  A shingle whose classes are
all of one component adds nothing; one with more than ``REGION`` classes is spread over blocks in which every
pair of different components still meets.  Before that, random pieces of the large regions connect groups
of near copies.

Regions that stay too large at full depth hold classes with equal signatures; they are cut into hash pieces
that share the smallest class, so they stay connected.

Nulls and edge cases: null and empty texts have an empty set, link with nothing and are kept; rows
without doc_id link with nothing, have a null component_id and are kept; repeated rows (same doc_id and
text) are copies of one another with one id; rows of one doc_id with different texts are compared
text by text and may get different components.  An empty table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import map_arrow, saved, table
from panelcast.llm.components import components
from panelcast.llm.shingles import MinHash, mixed, shingle_set

PERCENT, TREES, FIRST, REGION, GROWTH = 85, 24, 5, 256, 1.6
SIZE = TREES * FIRST
#: One-byte minima that decide, within a region, which pairs of different components are worth a look at the full sets.
LONG = 1024
#: Counters of the approximate shingle counts that order the shingles of dense classes; every third order's pieces are enough to connect copies.
SLOTS, EVERY = 1 << 20, 3


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, two 64-bit sums that name the set, and the signature (SIZE minima)."""
    def run(batch: pa.RecordBatch) -> dict:
        sets = [shingle_set(t) for t in batch.column(1).to_pylist()]
        sign = MinHash(SIZE)
        return {
            "doc_id": batch.column(0), "th": batch.column(2), "n_shingles": [len(s) for s in sets],
            "h1": [int(s.sum().view(np.int64)) if len(s) else 0 for s in sets],
            "h2": [int(mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum().view(np.int64)) if len(s) else 0 for s in sets],
            "sig": [sign(s).astype(">u4").tobytes() if len(s) else None for s in sets],
        }

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th")), run, "doc_id long, th long, n_shingles long, h1 long, h2 long, sig binary")


def prefix_keys(sig: bytes, tree: int, depth: int) -> bytes:
    """The first ``depth`` minima of a signature in the order of ``tree``."""
    at = 4 * FIRST * tree
    return (sig[at:] + sig[:at])[:4 * depth]


def region_rows(classes: DataFrame, depth: int) -> DataFrame:
    """(key, tree, cid): the region of every class in every order at ``depth``."""
    return _keyed(classes.select("cid", "sig"), depth, None)


def _keyed(rows: DataFrame, depth: int, tree: str | None) -> DataFrame:
    import xxhash

    def run(batch: pa.RecordBatch) -> dict:
        cids, sigs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        trees = [range(TREES)] * len(cids) if tree is None else [[t] for t in batch.column(2).to_pylist()]
        flat = [(t, c, xxhash.xxh3_64_intdigest(prefix_keys(s, t, depth), seed=t)) for c, s, ts in zip(cids, sigs, trees) for t in ts]
        keys = np.array([f[2] for f in flat], np.uint64).view(np.int64)
        return {"key": keys, "tree": [f[0] for f in flat], "cid": [f[1] for f in flat]}

    return map_arrow(rows, run, "key long, tree int, cid long")


def regions(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(region, cid) of all regions with 2 to REGION classes, each as deep as it must be; and the rows
    (key, tree, cid, n) of the regions that are larger at depth FIRST, None without such."""
    depth, found, dense = FIRST, None, None
    rows = region_rows(classes, depth)
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        held = saved(rows.join(sizes, "key"), "regions")
        done = held.where(F.col("n") <= REGION).select(F.xxhash64("key", F.lit(depth)).alias("region"), "cid")
        found = done if found is None else found.union(done)
        over = held.where(F.col("n") > REGION)
        if over.isEmpty():
            return found, dense
        dense = over if dense is None else dense
        if depth == SIZE:
            return found.union(cut(over)), dense
        depth = min(SIZE, int(depth * GROWTH) + 1)
        rows = _keyed(over.select("cid", "tree").join(classes.select("cid", "sig"), "cid").select("cid", "sig", "tree"), depth, "tree")


def cut(over: DataFrame) -> DataFrame:
    """Too large regions in hash pieces of bounded expected size, each with the smallest class of the
    region, which connects them if the signatures are equal."""
    lead = over.groupBy("key").agg(F.min("cid").alias("lead"))
    piece = F.xxhash64("key", F.pmod(F.xxhash64("cid"), F.ceil(F.col("n") / (REGION // 4))))
    pieces = over.join(lead, "key").withColumn("region", piece)
    return pieces.select("region", "cid").union(pieces.select("region", F.col("lead").alias("cid"))).distinct()


def rare_first(cids: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, cid): the shingles of every class in ``cids`` of which two sets at the threshold share one."""
    own = sets.join(cids, "cid").select("cid", "shingles")

    def slots(shingles: np.ndarray) -> np.ndarray:
        return (mixed(shingles) & np.uint64(SLOTS - 1)).astype(np.int64)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                np.add.at(counts, slots(np.frombuffer(x.as_buffer(), np.uint64)), 1)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["slot", "n"])

    total = own.select("shingles").mapInArrow(tally, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n > 1").toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[total.column("slot").to_numpy()] = total.column("n").to_numpy()
    shared = own.sparkSession.sparkContext.broadcast(counts)

    def first(batch: pa.RecordBatch) -> dict:
        keys, names = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for cid, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            s = np.frombuffer(x.as_buffer(), np.uint64)
            n = len(s) - -(-percent * len(s) // 100) + 1
            keys.append(s[np.lexsort((s, shared.value[slots(s)]))[:n]])
            names.append(np.full(n, cid))
        return {"key": np.concatenate(keys).view(np.int64), "cid": np.concatenate(names)}

    return map_arrow(own, first, "key long, cid long", slice_rows=50)


def dense_regions(cids: DataFrame, sets: DataFrame, comps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(region, cid) in which all pairs of dense classes meet that may reach the threshold and lie in different components."""
    rows = rare_first(cids, sets, percent).join(comps, F.col("cid") == F.col("node"), "left").select("key", "cid", F.coalesce("component", "cid").alias("component"))
    rows = saved(rows, "rare")
    parts = rows.groupBy("key", "component").agg(F.count("*").alias("c"))
    mixed_keys = parts.groupBy("key").agg(F.sum("c").alias("n"), F.count("*").alias("comps"), F.max_by("component", F.struct("c", "component")).alias("main"), F.max("c").alias("top")).where("comps > 1")
    held = saved(rows.join(mixed_keys, "key"), "rare")
    small = held.where(F.col("n") <= REGION).select(F.xxhash64("key").alias("region"), "cid")
    # the largest component's classes need only meet the others: both sides go in blocks, each block of
    # the others meets every block
    half = REGION // 2
    main, others = F.ceil(F.col("top") / half), F.ceil((F.col("n") - F.col("top")) / half)
    big = held.where(F.col("n") > REGION).withColumn("k", main).withColumn("j", others).withColumn("is_main", F.col("component") == F.col("main"))
    big = big.withColumn("own", F.pmod(F.xxhash64("cid", "key"), F.when(F.col("is_main"), F.col("k")).otherwise(F.col("j"))))
    to_others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("j") - 1), lambda q: F.xxhash64("key", F.when(F.col("is_main"), F.lit("m")).otherwise(F.lit("o")), F.when(F.col("is_main"), F.col("own")).otherwise(F.least("own", q)), F.when(F.col("is_main"), q).otherwise(F.greatest("own", q))))
    to_main = F.when(~F.col("is_main"), F.transform(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda p: F.xxhash64("key", F.lit("m"), p, F.col("own")))).otherwise(F.array().cast("array<bigint>"))
    return small.union(big.select(F.explode(F.concat(to_others, to_main)).alias("region"), "cid"))


def forest_pairs(cids: np.ndarray, sigs: np.ndarray, comps: np.ndarray | None, least: float, sizes: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Candidate pairs of one region.  Without components a maximum spanning forest of the agreement of
    the signatures; with components all candidates between different ones whose set sizes allow a link."""
    n, out = len(cids), []
    if comps is not None:
        for i in range(n - 1):
            near = (comps[i + 1:] != comps[i]) & (cids[i + 1:] != cids[i])
            near &= 100 * np.minimum(sizes[i + 1:], sizes[i]) >= percent * np.maximum(sizes[i + 1:], sizes[i])
            at = i + 1 + np.flatnonzero(near)
            at = at[(sigs[at] == sigs[i]).mean(axis=1) >= least]
            out += [(int(cids[i]), int(c)) for c in cids[at]]
        return out
    best, link, left = np.full(n, -1.0), np.zeros(n, np.int64), np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        left[at] = False
        same = (sigs == sigs[at]).mean(axis=1)
        better = left & (same > best)
        best[better], link[better] = same[better], at
        at = int(np.argmax(np.where(left, best, -2.0)))
        if best[at] >= least and cids[link[at]] != cids[at]:
            out.append((int(cids[link[at]]), int(cids[at])))
    return out


def bound(percent: int, size: int) -> float:
    """Least agreement of ``size`` minima that a pair at the threshold may show: four standard errors below it."""
    share = percent / 100
    return share - 4 * (share * (1 - share) / size) ** 0.5


def strongest(members: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct candidate pairs (a < b) of a spanning forest of every region."""
    rows = members.join(classes.select("cid", "sig"), "cid").select("region", "cid", "sig")
    return _region_pairs(rows, ">u4", bound(percent, SIZE), percent)


def between(members: DataFrame, sets: DataFrame, comps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Distinct candidate pairs (a < b) of different components.

    Only regions that touch more than one component count.  Their classes get a second, longer sketch from
    the full sets; pairs that it or the set sizes rule out never leave their region, so what goes on is
    close to the true links, not to all pairs of a dense region."""
    rows = members.join(comps, F.col("cid") == F.col("node"), "left").select("region", "cid", F.coalesce("component", "cid").alias("component"))
    apart = rows.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("region")
    rows = saved(rows.join(apart, "region"), "apart")

    def sketch(batch: pa.RecordBatch) -> dict:
        sign, got = MinHash(LONG, seed=2), [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
        return {"cid": batch.column(0), "n": [len(s) for s in got], "sig": [(sign(s) & np.uint32(255)).astype(np.uint8).tobytes() for s in got]}

    long = saved(map_arrow(sets.join(rows.select("cid").distinct(), "cid").select("cid", "shingles"), sketch, "cid long, n long, sig binary", slice_rows=100).dropDuplicates(["cid"]), "long")
    # unequal minima share their byte once in 256: the bound is only lower for that
    return _region_pairs(rows.join(long, "cid").select("region", "cid", "sig", "component", "n"), "u1", bound(percent, LONG), percent)


def _region_pairs(rows: DataFrame, kind: str, least: float, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches):
            cids = np.array(group["cid"], np.int64)
            if len(cids) < 2:
                continue
            sigs = np.frombuffer(b"".join(group["sig"]), kind).reshape(len(cids), -1)
            comps, sizes = (np.array(group[c]) if c in group else None for c in ("component", "n"))
            pairs = forest_pairs(cids, sigs, comps, least, sizes, percent)
            if pairs:
                a, b = np.array(pairs, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return rows.repartition("region").sortWithinPartitions("region", "cid").mapInArrow(run, "a long, b long").distinct()


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str = "region") -> Iterator[dict]:
    """Consecutive rows of equal ``key`` as dicts of lists; one group is held at a time."""
    held, value = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = batch.to_pydict()
        keys = cols[key]
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = {k: v[lo:hi] for k, v in cols.items()}
            if held is not None and keys[lo] == value:
                for k, v in part.items():
                    held[k] += v
                continue
            if held is not None:
                yield held
            held, value = part, keys[lo]
    if held is not None:
        yield held


def full_sets(members: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, shingles): the full shingle set of every class in a region; texts are read once for all rounds."""
    ids = members.select("cid").distinct().join(classes.select("cid", "h1"), "cid")
    texts = docs.select(F.col("doc_id").cast("long").alias("cid"), "text").join(ids, "cid")

    def sets(batch: pa.RecordBatch) -> dict:
        got = [shingle_set(t) for t in batch.column(1).to_pylist()]
        return {"cid": batch.column(0), "h1": batch.column(2), "own": [int(s.sum().view(np.int64)) if len(s) else 0 for s in got], "shingles": [s.tobytes() for s in got]}

    # a doc_id may stand on rows with different texts: only those of the class count
    return map_arrow(texts.select("cid", "text", "h1"), sets, "cid long, h1 long, own long, shingles binary").where("own = h1").select("cid", "shingles")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    first = pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa")), "a")
    both = first.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb")), "b")

    def check(batch: pa.RecordBatch) -> dict:
        good = []
        for x, y in zip(batch.column(2), batch.column(3)):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            n = len(np.intersect1d(p, q, assume_unique=True))
            good.append(100 * n >= percent * (len(p) + len(q) - n))
        keep = pa.array(good, pa.bool_())
        return {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}

    return map_arrow(both.select("a", "b", "sa", "sb"), check, "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, th (xxhash64 of the text), n_shingles, component_id and kept per row of ``docs``; sets link at
    a similarity of ``percent`` or more (FIRST minima in TREES orders find 0.9999 of the pairs at 80)."""
    rows = saved(signed(docs), "signed")
    full = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = saved(full.groupBy("h1", "h2", "n_shingles").agg(F.min("doc_id").alias("cid"), F.count("*").alias("copies"), F.min("sig").alias("sig")), "classes")
    members, over = regions(classes)
    members, first, used = saved(members, "members"), None, None
    if over is not None:
        cids = saved(over.select("cid").distinct(), "dense")
        first, used = members.union(cut(over.where(F.col("tree") % EVERY == 0))), members.select("cid").union(cids)
    pairs = saved(strongest(members if first is None else first, classes, percent), "pairs")
    sets = saved(full_sets(members if used is None else used, docs, classes), "sets")
    links = saved(confirmed(pairs, sets, percent), "links")
    comps = components(links)
    more = between(members if over is None else members.union(dense_regions(cids, sets, comps, percent)), sets, comps, percent)
    more = saved(more.join(pairs, ["a", "b"], "left_anti"), "pairs")
    if not more.isEmpty():
        again = saved(confirmed(more, sets, percent), "links")
        if not again.isEmpty():
            comps = components(links.union(again))
    named = classes.select("h1", "h2", F.col("n_shingles").alias("n_"), "cid", "copies").join(comps, F.col("cid") == F.col("node"), "left")
    # classes of one row without a link are their own component and need no join
    named = named.where((F.col("copies") > 1) | F.col("component").isNotNull())
    named = named.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n_", F.coalesce("component", "cid").alias("found"))
    out = rows.drop("sig").join(named, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & (F.col("n_shingles") == F.col("n_")) & F.col("doc_id").isNotNull(), "left")
    out = out.withColumn("component_id", F.coalesce("found", "doc_id"))
    return out.select("doc_id", "th", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (all columns) with one document of each component: its smallest doc_id.
    Repeated rows (same doc_id and text) leave one row."""
    found = saved(near_duplicates(docs.select("doc_id", "text"), percent), "found")
    names = ("doc_id", "th")
    drop = found.where(~F.col("kept")).select(*names).distinct()
    # the columns travel as one struct, so their names cannot clash with the keys
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"))
    left = packed.join(drop, [*names], "left_anti")
    linked = found.where("kept and n_shingles > 0 and doc_id is not null")
    twice = saved(linked.groupBy(*names).count().where("count > 1").drop("count"), "twice")
    if not twice.isEmpty():
        left = left.join(twice, [*names], "left_anti").union(left.join(twice, [*names], "left_semi").dropDuplicates([*names]))
    return left.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op10_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("th")
