"""A corpus where one image holds over a third of all pixels: no shuffle
stage may send that image to a single task."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import pixel
from tessera.operators import stencil, tone


def _corpus(spark):
    # image 0: 3000 x 40 (120k pixels); images 1..20: 40 x 40 (32k pixels)
    big = spark.range(3000 * 40).select(
        F.lit(0).alias("image_id"), (F.col("id") / 40).cast("int").alias("y"),
        (F.col("id") % 40).cast("int").alias("x"))
    small = spark.range(20 * 1600).select(
        (F.col("id") / 1600 + 1).cast("int").alias("image_id"),
        ((F.col("id") % 1600) / 40).cast("int").alias("y"), (F.col("id") % 40).cast("int").alias("x"))
    px = big.unionByName(small)
    return px.select("*", (F.pmod(F.xxhash64("image_id", "y", "x"), F.lit(256))).cast("int").alias("gray"),
                     (F.pmod(F.xxhash64("x", "y"), F.lit(1000)) / 100.0).alias("b"),
                     (F.pmod(F.xxhash64("y", "x"), F.lit(1000)) / 100.0).alias("g"),
                     (F.pmod(F.xxhash64("x", "image_id", "y"), F.lit(1000)) / 100.0).alias("r"))


def _max_share(df, key_cols):
    """Largest share of one image's rows held by a single post-shuffle task."""
    tagged = df.select(*key_cols, F.spark_partition_id().alias("p"))
    counts = tagged.where("image_id = 0").groupBy("p").count().collect()
    total = sum(r["count"] for r in counts)
    return max(r["count"] for r in counts) / total, len(counts)


@pytest.fixture
def shuffled(spark):
    """No broadcasts, no coalescing, many partitions: the plans beyond the size
    checks, with one task per shuffle partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_stencil_bands_spread_a_hot_image(shuffled):
    px = _corpus(shuffled)
    out = stencil.sobel_x(px)                         # partitions are the tiles' tasks
    share, parts = _max_share(out, ["image_id"])
    assert parts >= 8 and share < 0.25
    assert out.count() == px.count()


def test_salted_joins_spread_a_hot_image(shuffled):
    px = _corpus(shuffled)
    for df in (tone._binned(px, 1024), tone.tone_log(px, 0.4, 1.2), tone.histeq_tonemap(px)):
        share, parts = _max_share(df, ["image_id"])   # partitions are the join's tasks
        assert parts >= 8 and share < 0.25
        assert df.count() == px.count()
    # The aggregation after the join has an exchange and a partial step of its own.
    hist = tone.lum_histogram(px)
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(image_id" in plan.split("Join")[0]
    assert hist.where("image_id = 0").agg(F.sum("n")).first()[0] == 120000


def test_large_join_side_is_not_broadcast_by_its_file_size(spark):
    """90,000 rows that compress to a few bytes each are over the size check, so
    their salted copies may not be broadcast either."""
    from tessera.plans.joins import join_small

    keys = spark.range(90000).select((F.col("id") % 400).cast("int").alias("image_id"),
                                      (F.col("id") / 400).cast("int").alias("bin"))
    small = keys.withColumn("cdf_norm", F.col("bin") / 500)
    big = keys.unionByName(keys.limit(3).withColumn("bin", F.lit(-1)))
    out = join_small(big, small, ["image_id", "bin"], "left")
    rows = out.select(F.count(F.lit(1)).alias("n"), F.count("cdf_norm").alias("hits"),
                      F.sum((F.col("cdf_norm") != F.col("bin") / 500).cast("int")).alias("wrong"))
    assert tuple(rows.first()) == (90003, 90000, 0)
    plan = rows._jdf.queryExecution().executedPlan()
    assert "BroadcastHashJoin" not in plan.toString() and "SortMergeJoin" in plan.toString()


def test_per_image_kmeans_on_a_hot_image(spark, monkeypatch):
    from tessera.operators import cluster as cl

    px = _corpus(spark)
    monkeypatch.setattr(cl, "ROWS_PER_PART", 10000)   # the hot image is dealt in 12 parts
    out = cl.kmeans_tonemap_per_image(px, k=8, iterations=2)
    share, parts = _max_share(out, ["image_id"])
    assert out.count() == px.count()
    assert share < 0.6 and parts > 1
    # Every image got its own codebook: at most 8 distinct luminances each.
    out = out.select("image_id", "y", "x", pixel.luminance().alias("lum"))
    scales = (out.alias("o").join(px.alias("p"), ["image_id", "y", "x"])
              .select("image_id", F.round(F.try_divide(F.col("o.lum"), F.lit(1.0)), 9).alias("s"))
              .where("s is not null").groupBy("image_id").agg(F.countDistinct("s").alias("k")))
    assert 1 < scales.agg(F.max("k")).first()[0] <= 8
