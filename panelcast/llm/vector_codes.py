"""Vector codes by product quantisation: every vector becomes one byte a part, with the error it costs.

Lloyd's rounds run as one pass of Spark tasks each: a task builds the pair of trees of ``dual_tree`` over
its own rows and the codebooks (bounded: entries x vector length numbers), hands on counts and sums of
every entry, and Spark adds them up.  The codebooks are the only thing that meets the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm import dual_tree
from panelcast.llm.common import map_arrow, saved, ship, table
from panelcast.llm.vectors import integer_rows, matrix, widest

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Rows of one pair of trees.
TREE_ROWS = 4096
LONG_MAX = (1 << 63) - 1


def _parts(rows: np.ndarray, parts: int) -> np.ndarray:
    """(n, parts * w) -> (parts, n, w)."""
    return np.ascontiguousarray(rows.reshape(len(rows), parts, rows.shape[1] // parts).transpose(1, 0, 2))


def assign(points: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry per part and row, with the entries' counts and sums.  Numbers whose
    squared distances an int64 can't hold are compared as Python integers, without trees."""
    if dual_tree.safe(points, books):
        return dual_tree.nearest(points, books)[:3]
    p, n, w = points.shape
    big, ent = points.astype(object), books.astype(object)
    code = np.array([[min(range(ent.shape[1]), key=lambda e: (int(((big[i, r] - ent[i, e]) ** 2).sum()), e)) for r in range(n)] for i in range(p)], np.int64).reshape(p, n)
    count, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, object)
    for i in range(p):
        for r in range(n):
            count[i, code[i, r]] += 1
            total[i, code[i, r]] += big[i, r]
    return code, count, total


def _sums(width: int, parts: int, books: np.ndarray):
    """One task's counts and sums of every entry: (part, entry, at, count, total)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(books.shape[:2], object), np.zeros(books.shape, object)
        for batch in batches:
            for at in range(0, batch.num_rows, TREE_ROWS):
                _, c, t = assign(_parts(matrix(batch.column("ints").slice(at, TREE_ROWS), width), parts), books)
                count, total = count + c, total + t
        part, entry = np.nonzero(count)
        w = books.shape[2]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, w), pa.int32()), pa.array(np.repeat(entry, w), pa.int32()), pa.array(np.tile(np.arange(w), len(part)), pa.int32()),
             pa.array([int(x) for x in np.repeat(count[part, entry], w)], pa.int64()),
             pa.array([Decimal(int(x)) for x in total[part, entry].ravel()], pa.decimal128(38, 0))], names=["part", "entry", "at", "count", "total"])

    return run


def _codes(width: int, parts: int, books: np.ndarray):
    def run(batch: pa.RecordBatch) -> dict:
        points = _parts(matrix(batch.column("ints"), width), parts)
        code = assign(points, books)[0]
        kind = np.int64 if dual_tree.safe(points, books) else object
        gap = points.astype(kind) - np.take_along_axis(books, code[:, :, None], axis=1).astype(kind)
        error = (gap * gap).sum(axis=(0, 2)) if len(code[0]) else []
        text = [bytes(row).hex() for row in code.T.astype(np.uint8)]
        return {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": text, "error": [min(int(x), LONG_MAX) for x in error]}

    return run


def codebooks(rows: DataFrame, width: int, parts: int, entries: int, rounds: int) -> np.ndarray:
    """(parts, entries, w): first the parts of the rows with the smallest ids, then ``rounds`` rounds of Lloyd."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).select("ints").collect()      # at most ``entries`` rows
    start = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        start[i, :len(r[0])] = r[0]
    books = _parts(start, parts)
    for _ in range(rounds):
        found = (rows.select("ints").mapInArrow(_sums(width, parts, books), "part int, entry int, at int, count long, total decimal(38,0)")
                 .groupBy("part", "entry", "at").agg(F.sum("count").alias("count"), F.sum("total").alias("total")))
        books = books.copy()
        for r in found.collect():                                                                          # at most entries x width rows
            books[r["part"], r["entry"], r["at"]] = int(r["total"]) // r["count"]
    return books


def compress(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
             rounds: int = ROUNDS, scale: int = 256) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a usable vector.

    Components become floor(scale * x).  Vectors are cut into ``parts`` equal parts; where the longest
    vector's length is no multiple of ``parts``, and for shorter vectors, zeros are added at the end.  Each
    part's codebook starts as that part of the ``entries`` rows of the smallest ids (equal ids: the smaller
    vector first; null ids last; fewer rows: fewer entries), goes through ``rounds`` rounds of Lloyd with
    sums rounded down, and codes the rows at last.  Ties go to the lower index, unused entries stay.
    ``code`` holds two hexadecimal digits a part (so at most 256 entries), ``error`` the squared distance
    over all parts, ``label_error`` the error of all rows of the same label (null is a label of its own);
    both stop at the largest long.  Rows with a null vector, or with null or non-finite components, are
    dropped; repeated rows are rows of their own.  An empty table, or one without usable vectors, gives an
    empty result.  Other columns are not read."""
    spark = df.sparkSession
    ship(spark)
    if entries > 256:
        raise ValueError("a code of two hexadecimal digits names at most 256 entries")
    rows = saved(integer_rows(df, vec_col, scale, vec_id=id_col, label=label_col), "codes-rows")
    width = max(1, -(-widest(rows) // parts)) * parts
    books = codebooks(rows, width, parts, entries, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    coded = saved(map_arrow(rows.select("vec_id", "label", "ints"), _codes(width, parts, books),
                            f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long", TREE_ROWS), "codes")
    whole = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
    labels = coded.groupBy(F.col("label").alias("label_")).agg(whole.alias("label_error"))
    return (coded.join(labels, F.col("label").eqNullSafe(F.col("label_")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings as 16-byte codes, with the error by row and by label."""
    return compress(table(spark, sf_dir, "embeddings"))
