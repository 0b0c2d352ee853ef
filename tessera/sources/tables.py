"""Typed tables derived from the driver's parquet files.

Every derivation is a narrow projection of one scan, so Catalyst prunes the
parquet columns and the result partitions exactly like the scan does.  The
column formulas are the fixture definitions shared with the SQL oracles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixtures: images are 50 wide and 40 high, one pixel per
# event, pixels numbered row-major inside an image.
IMAGE_WIDTH = 50
IMAGE_HEIGHT = 40
IMAGE_PIXELS = IMAGE_WIDTH * IMAGE_HEIGHT

PIXEL_KEYS = ("image_id", "y", "x")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pixel_keys(event_id: Column) -> list[Column]:
    return [
        F.floor(event_id / IMAGE_PIXELS).cast("int").alias("image_id"),
        F.floor((event_id % IMAGE_PIXELS) / IMAGE_WIDTH).cast("int").alias("y"),
        (event_id % IMAGE_WIDTH).cast("int").alias("x"),
    ]


def pixels8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """8-bit colour pixels ``(image_id, y, x, b, g, r)``."""
    ev = read_table(spark, sf_dir, "events")
    v100 = F.floor(F.col("value") * 100)
    return ev.select(
        *_pixel_keys(F.col("event_id")),
        (v100 % 256).cast("int").alias("b"),
        ((v100 * 7 + F.col("user_id") * 13) % 256).cast("int").alias("g"),
        ((F.col("user_id") * 31 + F.col("event_id")) % 256).cast("int").alias("r"),
    )


def hdr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Float colour pixels ``(image_id, y, x, b, g, r)`` (doubles).

    Every 389th pixel is black, red is 0 in every 97th pixel.
    """
    ev = read_table(spark, sf_dir, "events")
    eid, val = F.col("event_id"), F.col("value")
    black = eid % 389 == 0
    zero = F.lit(0.0).cast("double")
    return ev.select(
        *_pixel_keys(eid),
        F.when(black, zero).otherwise(val * F.lit(0.01)).alias("b"),
        F.when(black, zero)
        .otherwise(val * F.lit(0.02) * (1 + F.col("user_id") % 3)).alias("g"),
        F.when(black | (eid % 97 == 0), zero).otherwise(val * F.lit(0.015)).alias("r"),
    )


def hdr_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hdr`` with undefined samples: red is NaN in every 101st pixel (from the
    7th), green is NULL in every 103rd (from the 5th)."""
    h = hdr(spark, sf_dir).withColumn(
        "__id", F.col("image_id") * IMAGE_PIXELS + F.col("y") * IMAGE_WIDTH + F.col("x"))
    return h.select(
        *PIXEL_KEYS, "b",
        F.when(F.col("__id") % 103 == 5, F.lit(None)).otherwise(F.col("g")).alias("g"),
        F.when(F.col("__id") % 101 == 7, F.lit(float("nan"))).otherwise(F.col("r")).alias("r"))


# Channels of image ``image_id`` in the long sample table, by ``image_id % 4``.
SAMPLE_CHANNELS = (3, 1, 4, 2)


def hdr_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long samples ``(image_id, y, x, channel, value)`` of images with one to
    four channels."""
    ev = read_table(spark, sf_dir, "events")
    keys = _pixel_keys(F.col("event_id"))
    n = F.element_at(F.array(*[F.lit(k) for k in SAMPLE_CHANNELS]), F.col("image_id") % 4 + 1)
    px = ev.select(*keys, "value")
    return px.select(*PIXEL_KEYS, F.explode(F.sequence(F.lit(0), n - 1)).alias("channel"),
                     "value").select(
        *PIXEL_KEYS, "channel",
        (F.col("value") * F.lit(0.01) * (F.col("channel") + 1)).alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log lines ``(line, file, name)`` written from the events: three layouts,
    and malformed lines."""
    ev = read_table(spark, sf_dir, "events")
    a, b = F.floor("value").cast("string"), F.col("user_id").cast("string")
    line = (F.when(F.col("event_id") % 13 == 0, F.concat(a, F.lit(" seconds")))
            .when(F.col("event_id") % 17 == 0, F.lit("1 2 3 4"))
            .when(F.col("event_id") % 19 == 0, F.lit("  "))
            .when(F.col("event_id") % 3 == 0, F.concat(a, F.lit(" "), b, F.lit(" 7")))
            .when(F.col("event_id") % 3 == 1, F.concat(a, F.lit(", "), b)).otherwise(a))
    name = F.concat(F.lit("img"), (F.col("event_id") % 5).cast("string"), F.lit(".jpg"),
                    F.when(F.col("user_id") % 2 == 0, F.lit("CM")).otherwise(F.lit("")), F.lit("Times"))
    return ev.select(line.alias("line"), F.concat(F.lit("logs/"), name).alias("file"), name.alias("name"))


def sparse_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse matrix of doubles from the events ``(i, j, v)``: user by event
    number modulo 97, repeated cells as they come."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").cast("long").alias("i"),
                     (F.col("event_id") % 97).cast("long").alias("j"), F.col("value").alias("v"))


def integer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense integer matrix from the events ``(i, j, v)``, 53 by 37, with
    repeated cells."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select((F.col("event_id") % 53).cast("long").alias("i"),
                     (F.floor(F.col("event_id") / 53) % 37).cast("long").alias("j"),
                     F.floor(F.col("value") * 100).cast("long").alias("v"))


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of distinct values ``(v double, n bigint)`` (partial + final agg)."""
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(F.col("value").alias("v")).agg(F.count(F.lit(1)).alias("n"))


def vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two position-keyed vectors ``(i, v)`` taken from the events table."""
    ev = read_table(spark, sf_dir, "events")
    a = ev.select(F.col("event_id").alias("i"), F.col("value").alias("v"))
    b = ev.select(F.col("event_id").alias("i"),
                  (F.col("user_id") * F.lit(0.5)).alias("v"))
    return a, b


VARIANTS = ("naive", "const", "shared")


def timing_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timing rows ``(workload, variant, event_id, gpu, cpu)`` without run numbers.

    Run numbers need an ordering per (workload, variant); operators that care
    about them add them with a bounded top-k (see operators.timings).
    """
    ev = read_table(spark, sf_dir, "events")
    variant = (F.when(F.col("user_id") % 3 == 0, "naive")
               .when(F.col("user_id") % 3 == 1, "const").otherwise("shared"))
    return ev.select(
        F.col("event_type").alias("workload"),
        variant.alias("variant"),
        F.col("event_id"),
        (F.col("value") / F.lit(1000.0)).alias("gpu"),
        (F.col("value") * (2 + F.col("event_id") % 5) / F.lit(1000.0)).alias("cpu"),
    )


def embedding_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings matrix as coordinate cells ``(i bigint, j int, v double)``."""
    emb = read_table(spark, sf_dir, "embeddings")
    return (emb.select("vec_id", F.posexplode("embedding").alias("j", "v"))
            .select(F.col("vec_id").alias("i"), F.col("j").cast("int"),
                    F.col("v").cast("double")))

