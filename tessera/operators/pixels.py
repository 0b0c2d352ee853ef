"""Per-pixel projections over pixel tables keyed by ``(image_id, y, x)``.

Each operator is a single narrow projection (no shuffle); Catalyst collapses
chains of them into one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import pixel as px

KEYS = ["image_id", "y", "x"]

# The bracketed exposure set (alpha, beta) in output order.
EXPOSURE_BRACKET = ((1.0, 25.0), (1.0, -25.0), (1.0, 50.0), (1.0, -10.0))


def gray(pixels: DataFrame, rounding: str = "floor") -> DataFrame:
    """``(image_id, y, x, gray)`` from 8-bit BGR pixels."""
    return pixels.select(*KEYS, px.gray("r", "g", "b", rounding).alias("gray"))


def double_wrap(gray_df: DataFrame, value: str = "gray") -> DataFrame:
    """Twice the brightness stored into a byte: wraps modulo 256."""
    return gray_df.select(*KEYS, px.wrap8(F.col(value) * 2).alias(value))


def exposure(pixels: DataFrame, alpha: float, beta: float) -> DataFrame:
    """``alpha*v+beta`` per channel, truncated and saturated to 8 bit."""
    return pixels.select(*KEYS, *[px.exposure(c, alpha, beta).alias(c) for c in "bgr"])


def exposure_bracket(pixels: DataFrame,
                     settings: tuple[tuple[float, float], ...] = EXPOSURE_BRACKET
                     ) -> DataFrame:
    """One image -> one exposure per setting, keyed by ``exposure_id``.

    The settings are a literal array exploded per row (a Generate inside the
    codegen span), so no join and no shuffle is needed.
    """
    if not settings:
        raise ValueError("at least one exposure setting is required")
    table = F.array(*[
        F.struct(F.lit(k).alias("exposure_id"), F.lit(float(a)).alias("alpha"),
                 F.lit(float(b)).alias("beta"))
        for k, (a, b) in enumerate(settings)
    ])
    exploded = pixels.select(*KEYS, "b", "g", "r", F.explode(table).alias("e"))
    return exploded.select(
        F.col("e.exposure_id").alias("exposure_id"), *KEYS,
        *[px.exposure(c, F.col("e.alpha"), F.col("e.beta")).alias(c) for c in "bgr"])


def to_rgba(pixels: DataFrame, alpha: int = 255) -> DataFrame:
    """BGR -> RGBA with an opaque alpha channel."""
    return pixels.select(*KEYS, "r", "g", "b", F.lit(alpha).alias("a"))


def from_rgba(rgba: DataFrame) -> DataFrame:
    """RGBA -> BGR, dropping alpha."""
    return rgba.select(*KEYS, "b", "g", "r")


def channel_split(pixels: DataFrame, channels: tuple[str, ...] = ("b", "g", "r"),
                  value: str = "value") -> DataFrame:
    """Wide -> long: one row per (pixel, channel); channel 0 = blue."""
    arr = F.array(*[F.col(c) for c in channels])
    return pixels.select(*KEYS, F.posexplode(arr).alias("channel", value))


def channel_merge(long_df: DataFrame, channels: tuple[str, ...] = ("b", "g", "r"),
                  value: str = "value") -> DataFrame:
    """Long -> wide: group the channel rows of each pixel back into columns.

    Groups are single pixels (at most ``len(channels)`` rows), so the shuffle
    on the pixel key cannot skew.
    """
    aggs = [F.max(F.when(F.col("channel") == k, F.col(value))).alias(c)
            for k, c in enumerate(channels)]
    return long_df.groupBy(*KEYS).agg(*aggs)


def abs_saturate(df: DataFrame, value: str) -> DataFrame:
    """``|v|`` saturated to 255 (absolute value of a signed gradient), as int."""
    return df.select(*KEYS, F.least(F.lit(255), F.abs(F.col(value))).cast("int").alias(value))


def assemble_rows(pixels: DataFrame, cols: tuple[str, ...] = ("b", "g", "r"),
                  out: str = "pixels") -> DataFrame:
    """Reassemble pixels into one sorted array per image row ``(image_id, y, out)``.

    A group is one image row, so no group grows with the image height or the
    corpus size; whole images are never gathered into one task.
    """
    packed = F.struct(F.col("x"), *[F.col(c) for c in cols])
    return (pixels.groupBy("image_id", "y")
            .agg(F.sort_array(F.collect_list(packed)).alias(out)))


def explode_rows(rows: DataFrame, src: str = "pixels") -> DataFrame:
    """Inverse of :func:`assemble_rows`."""
    return rows.select("image_id", "y", F.explode(src).alias("p")).select(
        "image_id", "y", "p.*")
