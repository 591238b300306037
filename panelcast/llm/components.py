"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (node, component), component = smallest node reachable.

    Nodes without an edge to another node are not listed.  Every step is a grouped minimum and a
    join on the node; no neighbourhood is gathered in one place.  Each round is written to the
    shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        # large star: every node hands its smallest neighbour (or itself) to its larger neighbours
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every node hands its smallest neighbour to its smaller neighbours and itself
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = saved(small.where("u <> v").distinct(), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
        before = mark
