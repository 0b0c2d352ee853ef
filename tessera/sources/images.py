"""Image files -> pixel tables, using Spark's built-in ``image`` data source.

The source decodes each file (PNG, JPEG, ...) in the reading task into one
row ``(origin, height, width, nChannels, mode, data)`` with interleaved
B, G, R(, A) bytes.  To avoid carrying whole images further, each image is
cut into one binary strip per image row, the strips are spread across tasks
by ``(image_id, y)``, and a vectorised NumPy decoder (``mapInPandas``) turns a
strip into pixel rows.  Unreadable files and unsupported layouts are returned
as a rejects table instead of stopping the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.pixel import gray as gray_expr
from tessera.functions.pixel import image_type_name

SUPPORTED_CHANNELS = (1, 3, 4)


def read_images(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``(image_id, origin, height, width, n_channels, mode, data)`` per file.

    ``image_id`` is a 64-bit hash of the file URI, stable across runs and
    retries.  Files that cannot be decoded keep ``-1`` dimensions.
    """
    img = (spark.read.format("image").option("dropInvalid", False)
           .option("recursiveFileLookup", str(recursive).lower()).load(path))
    return img.select(
        F.xxhash64("image.origin").alias("image_id"),
        F.col("image.origin").alias("origin"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("n_channels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"))


def _valid(images: DataFrame) -> DataFrame:
    return images.where((F.col("height") > 0) & (F.col("width") > 0)
                        & F.col("n_channels").isin(*SUPPORTED_CHANNELS))


def image_id_collisions(images: DataFrame) -> DataFrame:
    """Image ids shared by more than one file (``image_id, n, origins``).

    Ids are 64-bit hashes, so a collision is unlikely but possible for very
    large corpora (about 3% for a billion files); run this once per corpus.
    A group is one id, so it holds at most the few colliding files.
    """
    return (images.groupBy("image_id")
            .agg(F.count(F.lit(1)).alias("n"), F.collect_set("origin").alias("origins"))
            .where(F.col("n") > 1))


def image_catalog(images: DataFrame) -> DataFrame:
    """Per image: key, origin, size, channel count and type name."""
    return images.select("image_id", "origin", "height", "width", "n_channels", "mode",
                         F.when(F.col("mode") >= 0, image_type_name("mode")).alias("type_name"))


def image_rejects(images: DataFrame) -> DataFrame:
    """Images that are empty, unreadable or not 1/3/4-channel, with a reason."""
    reason = (F.when((F.col("height") <= 0) | (F.col("width") <= 0), F.lit("unreadable"))
              .otherwise(F.lit("unsupported channels")))
    return (images.where(~((F.col("height") > 0) & (F.col("width") > 0)
                           & F.col("n_channels").isin(*SUPPORTED_CHANNELS)))
            .select("image_id", "origin", "height", "width", "n_channels",
                    reason.alias("reason")))


def image_strips(images: DataFrame) -> DataFrame:
    """One binary strip per image row: ``(image_id, y, width, n_channels, strip)``.

    The strips are cut inside one expression and then exploded, so a
    generated row carries its own strip only, never the whole image.
    """
    v = _valid(images)
    rb = F.col("width") * F.col("n_channels")
    strips = F.transform(F.sequence(F.lit(0), F.col("height") - 1),
                         lambda y: F.substring(F.col("data"), y * rb + 1, rb))
    return (v.select("image_id", "width", "n_channels",
                     F.posexplode(strips).alias("y", "strip"))
            .repartition("image_id", "y"))


_PIXEL_SCHEMA = T.StructType([
    T.StructField("image_id", T.LongType(), False),
    T.StructField("y", T.IntegerType(), False),
    T.StructField("x", T.IntegerType(), False),
    T.StructField("b", T.IntegerType(), False),
    T.StructField("g", T.IntegerType(), False),
    T.StructField("r", T.IntegerType(), False),
    T.StructField("a", T.IntegerType(), False),
])


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for image_id, y, width, nch, strip in zip(pdf["image_id"], pdf["y"], pdf["width"],
                                                  pdf["n_channels"], pdf["strip"]):
            px = np.frombuffer(strip, dtype=np.uint8).reshape(int(width), int(nch)).astype(np.int32)
            if nch == 1:
                b = g = r = px[:, 0]
                a = np.full(int(width), 255, dtype=np.int32)
            else:
                b, g, r = px[:, 0], px[:, 1], px[:, 2]
                a = px[:, 3] if nch == 4 else np.full(int(width), 255, dtype=np.int32)
            out.append(pd.DataFrame({
                "image_id": np.full(int(width), image_id, dtype=np.int64),
                "y": np.full(int(width), y, dtype=np.int32),
                "x": np.arange(int(width), dtype=np.int32),
                "b": b, "g": g, "r": r, "a": a}))
        if out:
            yield pd.concat(out, ignore_index=True)


def image_pixels(images: DataFrame, as_: str = "color") -> DataFrame:
    """Pixel table of the valid images.

    ``as_="color"``: ``(image_id, y, x, b, g, r)`` (a gray file repeats its
    sample); ``"rgba"``: ``(image_id, y, x, r, g, b, a)``; ``"gray"``:
    ``(image_id, y, x, gray)`` (a colour file is converted with half-even
    rounding, like a library colour conversion).
    """
    px = image_strips(images).mapInPandas(_decode, _PIXEL_SCHEMA)
    keys = ["image_id", "y", "x"]
    if as_ == "color":
        return px.select(*keys, "b", "g", "r")
    if as_ == "rgba":
        return px.select(*keys, "r", "g", "b", "a")
    if as_ == "gray":
        return px.select(*keys, gray_expr("r", "g", "b", rounding="half_even").alias("gray"))
    raise ValueError("as_ must be 'color', 'rgba' or 'gray'")
