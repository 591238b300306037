"""Session and lineage helpers.

The library never creates a session implicitly; ``local_session`` exists for tests,
benchmarks and the command line.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from
the running session (a shared folder on a cluster) and only provides a private folder
when nothing is configured (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "panelcast", driver_memory: str = "16g") -> SparkSession:
    """A local session with the settings the tests and the benchmark use."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir``, else (local mode only) a private one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: lineage cuts and "
                               "intermediate tables must survive the loss of any executor")
        # local mode only (tests): no shared folder was named, a private one is enough
        configured = tempfile.mkdtemp(prefix="panelcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def track(spark: SparkSession, path: str) -> str:
    """Remember a table written to the shared folder, so that ``drop_tables`` can delete it."""
    sc = spark.sparkContext
    if not hasattr(sc, "_panelcast_tables"):
        sc._panelcast_tables = []
    sc._panelcast_tables.append(path)
    return path


def drop_tables(spark: SparkSession) -> int:
    """Delete every intermediate table this application wrote to the shared folder; returns their number.
    Call it when no DataFrame built on them is needed any more (they are never deleted on their own)."""
    paths, spark.sparkContext._panelcast_tables = getattr(spark.sparkContext, "_panelcast_tables", []), []
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def cut_lineage(df: DataFrame, name: str = "table", by: str | list[str] | None = None, dictionary: bool = True) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    The plan above is cut (later jobs start from the files, and a lost executor re-reads
    them instead of recomputing the lineage).  Parquet is used instead of an RDD checkpoint
    because it is columnar and compressed; RDD checkpoints serialise every row object.
    ``by`` gives every value of that column (every pair of values) a folder of its own; ``dictionary=False`` is for numbers that hardly repeat."""
    spark = df.sparkSession
    path = track(spark, f"{checkpoint_dir(spark).rstrip('/')}/panelcast-{name}-{uuid.uuid4().hex}")
    options = {"compression": "zstd", "parquet.enable.dictionary": str(dictionary).lower()}
    df.write.mode("error").options(**options).parquet(path, partitionBy=by)
    if by is None:
        return spark.read.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
