"""Exact top-k search by inner product in three phases under one uniform threshold.

The score of a query and a row is a sum over ``PARTS`` parts of the vector; each part of a group of rows
is one node with its own list of part scores.

1. Every node names its k best rows.  Their whole scores are known exactly, so the k-th best of them over
   all groups is a safe cutoff: k rows reach it.
2. The cutoff goes back to all groups with the query.  With ``low_p`` the least score of node p, a row
   below ``low_p + (cutoff - sum of low) / PARTS`` at every node is below the cutoff in total; only the
   other rows are collected, and only while their seen scores plus the threshold for the unseen ones
   reach the cutoff.
3. The unseen scores of what is left are looked up, whole scores below the cutoff fall away, and each
   group hands on its k best rows.

Rows are dealt at random (by row number, so no key is hot) into groups of about ``GROUP_ROWS``; queries
are sent to every group and meet it in blocks, streamed behind the group's rows.  A task holds one group
and one block of scores; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import saved, ship, table
from panelcast.llm.vectors import EXACT, integer_rows, matrix, widest

GROUP_ROWS = 32_768
#: Queries that meet a group at once: bounds the block of scores (rows of a group x queries x parts).
BLOCK = 32
PARTS = 4
LONG = (1 << 63) - 1

FOUND = "query long, query_id long, rid long, vec_id long, score long"


def part_scores(queries: np.ndarray, rows: np.ndarray, parts: int) -> list[np.ndarray]:
    """Exact scores of every part.  Products that float64 could round are summed as Python integers."""
    cuts = [i * rows.shape[1] // parts for i in range(parts + 1)]
    bound = float(np.abs(queries.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0)) * max(1, rows.shape[1])
    kind = np.float64 if bound < EXACT else object
    q, v = queries.astype(kind), rows.astype(kind)
    return [q[:, a:b] @ v[:, a:b].T if b > a else np.zeros((len(q), len(v)), kind) for a, b in zip(cuts, cuts[1:])]


def gather(scores: list[np.ndarray], own: int, k: int) -> tuple[np.ndarray, list]:
    """Phase 1 for one query: the k best rows of every node, own row aside, with their whole scores."""
    seats = np.unique(np.concatenate([_top(s, own, k) for s in scores]))
    total = sum(s[seats] for s in scores)
    return seats, list(total)


def _top(s: np.ndarray, own: int, k: int) -> np.ndarray:
    order = np.argpartition(-s, min(k, len(s) - 1))[:k + 1] if s.dtype != object else np.argsort(-s, kind="stable")[:k + 1]
    return order[order != own][:k + 1]


def collect(scores: list[np.ndarray], own: int, cutoff: int | None) -> tuple[np.ndarray, list]:
    """Phases 2 and 3 for one query: rows of the group that reach the cutoff, with their whole scores."""
    if cutoff is None:                       # fewer than k rows exist: everything is in the result
        seats = np.arange(len(scores[0]))
        seats = seats[seats != own]
        return seats, list(sum(s[seats] for s in scores))
    low = [int(s.min()) for s in scores]
    each = (cutoff - sum(low)) // len(scores)          # rounded down: the bars never add up to more than the cutoff
    bars = [lo + each for lo in low]
    seen = [s >= b for s, b in zip(scores, bars)]
    bound = sum(np.where(m, s, b) for s, b, m in zip(scores, bars, seen))
    seats = np.flatnonzero(np.logical_or.reduce(seen) & (bound >= cutoff))
    seats = seats[seats != own]
    total = sum(s[seats] for s in scores)                                        # the unseen parts are looked up
    keep = total >= cutoff
    return seats[keep], list(total[keep])


def _search(width: int, k: int, parts: int, phase: int):
    """The streamed task: rows of a group first (``is_query`` false), then its queries in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, rows, ids, known, rids = None, [], None, None, None, None

        def close() -> None:
            nonlocal held, rows, ids, known, rids
            if held or rows is None:
                rows = np.concatenate([matrix(b.column("ints"), width) for b in held]) if held else np.zeros((0, width), np.int64)
                col = [pa.concat_arrays([b.column(c) for b in held]) if held else pa.array([], pa.int64()) for c in ("vec_id", "rid")]
                known, ids = col[0].is_valid().to_numpy(zero_copy_only=False), col[0].fill_null(0).to_numpy()
                rids, held = col[1].to_numpy(), []

        for batch in batches:
            g = batch.column("grp").to_numpy()
            isq = batch.column("is_query").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (isq[1:] != isq[:-1])])) if len(g) else []
            for a, b in zip(edges, [*edges[1:], len(g)]):
                if g[a] != group:
                    group, held, rows = g[a], [], None
                piece = batch.slice(int(a), int(b - a))
                if not isq[a]:
                    held.append(piece)
                    continue
                close()
                if not len(rows):
                    continue
                out: list[list] = [[], [], [], [], []]
                for at in range(0, piece.num_rows, BLOCK):
                    block = piece.slice(at, BLOCK)
                    scores = part_scores(matrix(block.column("ints"), width), rows, parts)
                    cuts = block.column("cutoff").to_pylist()
                    for i, (q, qid) in enumerate(zip(block.column("rid").to_pylist(), block.column("vec_id").to_pylist())):
                        mine = np.flatnonzero(rids == q)
                        own = int(mine[0]) if len(mine) else -1
                        mono = [s[i] for s in scores]
                        seats, total = gather(mono, own, k) if phase == 1 else collect(mono, own, cuts[i])
                        order = sorted(range(len(seats)), key=lambda j: (-total[j], not known[seats[j]], ids[seats[j]], rids[seats[j]]))[:k]
                        for j in order:
                            s = seats[j]
                            for col, x in zip(out, (q, qid, int(rids[s]), int(ids[s]) if known[s] else None, min(max(int(total[j]), -LONG), LONG))):
                                col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["query", "query_id", "rid", "vec_id", "score"])

    return run


def top_k(df: DataFrame, queries: Callable[[Column], Column], k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256,
          parts: int = PARTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The ``k`` best rows of every query: query_id, rank (from 1), vec_id, score.

    ``queries`` says of an id whether its row asks; a query row meets every row but itself.  Components become
    floor(scale * x); the score is their inner product, as a long.  Score ties go to the smaller id, then
    (equal ids) to the row read first; a null id comes last and asks only if ``queries`` is true
    of null.  Vectors that are null or hold null or non-finite components take no part; a shorter vector counts
    as if it ended in zeros, an empty one scores 0.  Rows that repeat an id are rows of their own: each is
    a candidate for the others, and each gets its own list as a query.  Fewer than ``k`` other rows: all
    of them.  An empty table gives an empty result.  Other columns of the table are not read.  Sums that
    float64 can't hold exactly are computed with Python integers; scores beyond a long stop at its ends and
    then tie."""
    spark = df.sparkSession
    ship(spark)
    rows = saved(integer_rows(df, vec_col, scale, vec_id=id_col), "topk-rows")
    width, n = widest(rows), rows.count()
    groups = max(1, -(-n // group_rows), spark.sparkContext.defaultParallelism)
    asked = rows.where(F.coalesce(queries(F.col("vec_id")), F.lit(False)))
    dealt = rows.select(F.pmod(F.xxhash64("rid"), F.lit(groups)).alias("grp"), F.lit(False).alias("is_query"), "rid", "vec_id", "ints", F.lit(None).cast("long").alias("cutoff"))

    def phase(number: int, q: DataFrame) -> DataFrame:
        sent = q.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("grp"), F.lit(True).alias("is_query"), "rid", "vec_id", "ints", "cutoff")
        met = dealt.unionByName(sent).repartition(groups, "grp").sortWithinPartitions("grp", "is_query")
        return met.mapInArrow(_search(width, k, parts, number), FOUND)

    by_score = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
    named = phase(1, asked.withColumn("cutoff", F.lit(None).cast("long")))
    cut = named.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).where(F.col("rank") == k)
    cutoffs = saved(cut.select(F.col("query").alias("rid"), F.col("score").alias("cutoff")), "topk-cutoffs")
    found = phase(2, asked.join(cutoffs, "rid", "left"))
    return (found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows by integer inner product of every vector whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 50 == 0)
