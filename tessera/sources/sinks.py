"""Sinks for pixel and timing tables.

Results are written as parquet sorted by the pixel key inside each task, so
row-group statistics on ``image_id``/``y`` let later scans skip data.  Writing
one directory per image is optional: with millions of images it would create
millions of folders, so it is off by default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.pixel import quantise8


def write_pixels(df: DataFrame, path: str, mode: str = "overwrite",
                 partition_by_image: bool = False) -> None:
    """Write a pixel table (8-bit or float) sorted by (image_id, y, x) per task."""
    w = df.sortWithinPartitions("image_id", "y", "x").write.mode(mode)
    if partition_by_image:
        w = w.partitionBy("image_id")
    w.parquet(path)


def to_8bit(df: DataFrame, cols=("b", "g", "r")) -> DataFrame:
    """Float samples in 0..1 -> 8-bit samples (x255, half-even, saturated)."""
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[quantise8(c).alias(c) for c in cols])


def scale_hdr(df: DataFrame, factor: float = 255.0, cols=("b", "g", "r")) -> DataFrame:
    """Float result scaled by ``factor`` before an HDR (float) write."""
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[(F.col(c) * F.lit(factor)).alias(c) for c in cols])


def append_timings(df: DataFrame, path: str) -> None:
    """Append timing rows to a parquet log (one file set per append)."""
    df.write.mode("append").parquet(path)
