"""Scoring / calibration on a stream of new predictions (Structured Streaming).

The calibration step (M9) is a per-row lookup against a small per-cell table, so it runs
unchanged on a stream: a stream-static join with the cell scale table, the multiplier, the
clip.  The sink is a folder of Parquet files; the checkpoint folder belongs to the sink and is
named by the caller.  Calls with the same pair of folders go on where the last batch ended; a
sink with another checkpoint folder would take new batches for committed ones and skip them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelcast.operators.crossperiod import calibrate

PRED_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType(), False),
    T.StructField("geohash", T.StringType(), False),
    T.StructField("pred", T.DoubleType(), True),
])


def calibration_stream(stream: DataFrame, scale: DataFrame, entity: str = "geohash", pred: str = "pred",
                       alpha: float = 0.2) -> DataFrame:
    """Streaming DataFrame of calibrated predictions (stream-static join with ``scale``)."""
    return calibrate(stream, scale, entity, pred, alpha=alpha)


def run_calibration(spark: SparkSession, source_dir: str, scale: DataFrame, sink_dir: str,
                    checkpoint: str, alpha: float = 0.2, schema: T.StructType = PRED_SCHEMA):
    """Process every file in ``source_dir`` not yet processed (trigger availableNow) into ``sink_dir``.

    ``checkpoint`` must be the folder used for this sink from its first call on."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    out = calibration_stream(stream, scale, alpha=alpha)
    q = (out.writeStream.format("parquet").option("path", sink_dir)
         .option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
