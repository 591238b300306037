"""Helpers that the operators share: table access, the shared folder, Arrow maps, id rules."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import checkpoint_dir, track

#: Rows that a Python helper handles at once; bounds the objects alive beside the Arrow batch.
SLICE_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark application."""
    sc = spark.sparkContext
    if getattr(sc, "_panelcast_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    folder = os.path.realpath(tempfile.mkdtemp(prefix="panelcast-zip-"))  # the driver serves it from here
    with zipfile.ZipFile(f"{folder}/{top.name}.zip", "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(f"{folder}/{top.name}.zip")
    sc._panelcast_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``); the folder is read
    from the session, and ``panelcast.session.drop_tables`` deletes what is no longer needed."""
    return track(spark, f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and a lost
    executor costs a read, not a recomputation."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` in slices of bounded rows; ``fn`` takes a record batch and returns columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(kind)
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                cols = fn(batch.slice(at, slice_rows))
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip((cols[f.name] for f in arrow), arrow)], schema=arrow)

    return df.mapInArrow(run, kind)


_OWNERS: dict[str, Callable[[], None]] = {}
_ACTIVE = ""


def own_memory(name: str, clear: Callable[[], None]) -> None:
    """Say that ``name`` uses this process's memory from now on: what other operators have remembered in
    the same Python worker is dropped, so the bounds of single operators don't add up."""
    global _ACTIVE
    if _ACTIVE != name:
        _OWNERS[name], _ACTIVE = clear, name
        for k, f in _OWNERS.items():
            if k != name:
                f()


def held_out(doc_id: Column | str) -> Column:
    """True for documents that no model may learn from: crc32 of the id as text, modulo 5, is 0."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def crc_rest(doc_id: Column | str, mod: int, salt: str = "") -> Column:
    """A stable pseudo-random number in [0, mod) from the id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.xxhash64(F.lit(salt), c), F.lit(mod))
