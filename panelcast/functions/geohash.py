"""Geohash cell centre (P10) and prefix regions (P11) as JVM-side column expressions.

A geohash interleaves longitude and latitude bits, five bits per base-32 character,
starting with a longitude bit.  The decode folds the characters left to right with
``aggregate`` (a higher-order function — no Python UDF): even-indexed characters add
3 longitude and 2 latitude bits, odd-indexed ones 3 latitude and 2 longitude bits.
The centre of the final cell is returned; any character outside the alphabet (or an
empty string) yields NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the geohash base-32 alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def _bit(d: Column, k: int) -> Column:
    return F.shiftright(d, k).bitwiseAND(F.lit(1)).cast("bigint")


def decode_center(cell: str | Column) -> tuple[Column, Column]:
    """(lat, lon) of the cell centre, NULL for an invalid cell id."""
    c = F.col(cell) if isinstance(cell, str) else cell
    chars = F.split(c, "")
    digits = F.transform(chars, lambda ch: F.instr(F.lit(GEOHASH_ALPHABET), ch) - 1)
    init = F.struct(F.lit(0).cast("bigint").alias("lon"), F.lit(0).cast("bigint").alias("lat"),
                    F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("nlon"),
                    F.lit(0).cast("bigint").alias("nlat"), F.lit(True).alias("ok"))

    def step(acc, d):
        even = (acc["i"] % 2) == 0
        three = _bit(d, 4) * 4 + _bit(d, 2) * 2 + _bit(d, 0)
        two = _bit(d, 3) * 2 + _bit(d, 1)
        return F.struct(
            F.when(even, acc["lon"] * 8 + three).otherwise(acc["lon"] * 4 + two).alias("lon"),
            F.when(even, acc["lat"] * 4 + two).otherwise(acc["lat"] * 8 + three).alias("lat"),
            (acc["i"] + 1).alias("i"),
            (acc["nlon"] + F.when(even, 3).otherwise(2)).alias("nlon"),
            (acc["nlat"] + F.when(even, 2).otherwise(3)).alias("nlat"),
            (acc["ok"] & (d >= 0)).alias("ok"),
        )

    acc = F.aggregate(digits, init, step)
    valid = acc["ok"] & (F.length(c) > 0)
    lat = (acc["lat"] + 0.5) * 180.0 / F.pow(F.lit(2.0), acc["nlat"]) - 90.0
    lon = (acc["lon"] + 0.5) * 360.0 / F.pow(F.lit(2.0), acc["nlon"]) - 180.0
    return F.when(valid, lat), F.when(valid, lon)


def prefix(cell: str | Column, k: int) -> Column:
    """First ``k`` characters of the cell id."""
    c = F.col(cell) if isinstance(cell, str) else cell
    return F.substring(c, 1, k)
