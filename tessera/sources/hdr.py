"""HDR (float) pixel tables.

Two layouts are accepted: wide ``(image_id, y, x, b, g, r)`` and long
``(image_id, y, x, channel, value)`` with channel 0 = blue.  Samples are
promoted to double.  Like a colour HDR loader: a 1-channel image is expanded
to three equal channels, a 4-channel image loses its alpha, and any other
layout (or an image without pixels) goes to a rejects table instead of
stopping the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.joins import join_small

KEYS = ["image_id", "y", "x"]


def read_hdr(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Wide HDR table with explicit column types (no inference)."""
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raw = (spark.read.format(fmt).option("header", "true")
               .schema("image_id long, y int, x int, b double, g double, r double").load(path))
    return raw.select(F.col("image_id").cast("long"), F.col("y").cast("int"),
                      F.col("x").cast("int"),
                      *[F.col(c).cast("double").alias(c) for c in ("b", "g", "r")])


def hdr_from_samples(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long samples -> (wide HDR pixels, rejects ``(image_id, n_channels, reason)``).

    The per-image channel count is a small per-image table (partial + final
    aggregation), joined back with a size-checked broadcast or a salted join.
    """
    per_image = samples.groupBy("image_id").agg(
        (F.max("channel") + 1).alias("n_channels"), F.min("channel").alias("min_channel"))
    ok = F.col("n_channels").isin(1, 3, 4) & (F.col("min_channel") == 0)
    rejects = per_image.where(~ok).select(
        "image_id", "n_channels", F.lit("image must be colour").alias("reason"))
    good = per_image.where(ok).select("image_id", "n_channels")
    kept = join_small(samples, good, "image_id")
    v = F.col("value").cast("double")
    wide = kept.groupBy(*KEYS).agg(
        F.max("n_channels").alias("n"),
        *[F.max(F.when(F.col("channel") == k, v)).alias(f"c{k}") for k in range(3)])
    one = F.col("n") == 1
    pixels = wide.select(*KEYS,
                         F.col("c0").alias("b"),
                         F.when(one, F.col("c0")).otherwise(F.col("c1")).alias("g"),
                         F.when(one, F.col("c0")).otherwise(F.col("c2")).alias("r"))
    return pixels, rejects
