"""Catalogue of registered queries: each takes ``(spark, sf_dir)`` and returns
a DataFrame whose column names equal those of its oracle in ``oracles.py``.

Library operators return full precision; the catalogue rounds float columns
on a 2^-20 grid only so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import pixel as px
from tessera.functions.pixel import quantise8
from tessera.operators import cluster as cl
from tessera.operators import matrix as mx
from tessera.operators import pixels as pxo
from tessera.operators import stencil, tiles, tone, vectors
from tessera.operators import timings as tm
from tessera.functions import sql as px_sql
from tessera.plans.colocated import bucketed
from tessera.plans.joins import scratch_path
from tessera.sources import raster
from tessera.sources import tables as tb
from tessera.sources.appends import append_once, read_appended
from tessera.sources.hdr import hdr_from_samples
from tessera.sources.sinks import scale_hdr, to_8bit
from tessera.sources.timing_logs import parse_timing_lines, rejected_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


@register("gray")
def q_gray(spark, sf_dir):
    return pxo.gray(tb.pixels8(spark, sf_dir))


@register("sobel")
def q_sobel(spark, sf_dir):
    return stencil.sobel_x(pxo.gray(tb.pixels8(spark, sf_dir)))


# ----------------------------------------------------------------- helpers
def cmp_round(c):
    """Round a float column for cross-engine comparison, on a binary grid.

    ``round(x * 2^20) / 2^20`` (resolution about 1e-6): scaling by a power of
    two is exact, and a value with a short decimal expansion (this data has
    many) almost never lies on a binary half-step, so a last-bit difference
    between engines (summation order) does not flip the rounded result, as it
    can with a decimal tie such as 1.7910375 at 6 decimals.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.round(x * F.lit(COMPARE_SCALE), 0) / F.lit(COMPARE_SCALE) + F.lit(0.0)


def _round_cols(df: DataFrame, cols) -> DataFrame:
    return df.select(*[cmp_round(c).alias(c) if c in cols else F.col(c) for c in df.columns])


def _with_8bit(df: DataFrame, cols=("b", "g", "r")) -> DataFrame:
    """Float channels rounded for comparison plus their 8-bit quantisation."""
    return df.select(*[c for c in df.columns if c not in cols],
                     *[cmp_round(c).alias(c) for c in cols],
                     *[quantise8(c).alias(f"{c}8") for c in cols])


# Resolution of the comparison rounding (2^20).
COMPARE_SCALE = 1048576.0

# Fixed parameters of the registered queries.
EXPOSURE_ALPHA, EXPOSURE_BETA = 1.5, -20.0
TONE_P1, TONE_P2 = 0.4, 1.2
ROW_BLOCKS = 7
CLUSTER_K = 8
LLOYD_ITERATIONS = 3
VECTOR_K = 16
CONVOLVE_MASK = (
    (1, 0, 0, 0, -1),
    (2, 1, 0, -1, -2),
    (3, 2, 1, -2, -3),
    (2, 1, 0, -1, -2),
    (0, 0, 1, 0, 0),
)


# ------------------------------------------------------------ pixels (A, B)
@register("double_wrap")
def q_double_wrap(spark, sf_dir):
    return pxo.double_wrap(pxo.gray(tb.pixels8(spark, sf_dir)))


@register("exposure")
def q_exposure(spark, sf_dir):
    return pxo.exposure(tb.pixels8(spark, sf_dir), EXPOSURE_ALPHA, EXPOSURE_BETA)


@register("exposure_bracket")
def q_exposure_bracket(spark, sf_dir):
    return pxo.exposure_bracket(tb.pixels8(spark, sf_dir))


@register("rgba_swizzle")
def q_rgba_swizzle(spark, sf_dir):
    return pxo.to_rgba(tb.pixels8(spark, sf_dir))


@register("channel_split")
def q_channel_split(spark, sf_dir):
    return pxo.channel_split(tb.pixels8(spark, sf_dir))


@register("sobel_reflect101")
def q_sobel_reflect101(spark, sf_dir):
    return stencil.sobel_x(pxo.gray(tb.pixels8(spark, sf_dir)), border="reflect101")


@register("sobel_abs")
def q_sobel_abs(spark, sf_dir):
    grad = stencil.sobel_x(pxo.gray(tb.pixels8(spark, sf_dir)), clamp=False)
    return pxo.abs_saturate(grad, "gray")


@register("convolve")
def q_convolve(spark, sf_dir):
    return stencil.convolve(pxo.gray(tb.pixels8(spark, sf_dir)), CONVOLVE_MASK)


@register("strip_assemble")
def q_strip_assemble(spark, sf_dir):
    rows = pxo.assemble_rows(tb.pixels8(spark, sf_dir))
    text = F.array_join(F.transform(
        "pixels", lambda s: F.concat_ws(":", s["b"], s["g"], s["r"])), " ")
    return rows.select("image_id", "y", F.size("pixels").alias("n"), text.alias("strip"))


# ------------------------------------------------------------- HDR (A, C)
@register("hdr_scan")
def q_hdr_scan(spark, sf_dir):
    return _round_cols(tb.hdr(spark, sf_dir), ("b", "g", "r"))


@register("luminance")
def q_luminance(spark, sf_dir):
    h = tb.hdr(spark, sf_dir)
    return h.select("image_id", "y", "x", cmp_round(px.luminance()).alias("lum"))


@register("rgb_to_xyy")
def q_rgb_to_xyy(spark, sf_dir):
    return _round_cols(tone.rgb_to_xyy(tb.hdr(spark, sf_dir)), ("cx", "cy", "log_y"))


@register("max_sample")
def q_max_sample(spark, sf_dir):
    return _round_cols(tone.max_sample(tb.hdr(spark, sf_dir)), ("max_sample",))


@register("tone_log")
def q_tone_log(spark, sf_dir):
    return _with_8bit(tone.tone_log(tb.hdr(spark, sf_dir), TONE_P1, TONE_P2))


@register("tone_adaptive")
def q_tone_adaptive(spark, sf_dir):
    return _with_8bit(tone.tone_adaptive(tb.hdr(spark, sf_dir), TONE_P1, TONE_P2))


@register("tone_gamma")
def q_tone_gamma(spark, sf_dir):
    return _with_8bit(tone.tone_gamma(tb.hdr(spark, sf_dir), TONE_P1, TONE_P2))


@register("tone_batch_params")
def q_tone_batch_params(spark, sf_dir):
    h = tb.hdr(spark, sf_dir)
    # One parameter row per image present in the data: bias varies by image.
    # Taken from the per-image max aggregate, whose shuffle the batch tone map
    # needs anyway (Spark reuses the exchange).
    params = tone.max_sample(h).select(
        "image_id", (F.lit(TONE_P1) + F.lit(0.1) * (F.col("image_id") % 3)).alias("p1"),
        F.lit(TONE_P2).alias("p2"))
    return _with_8bit(tone.tone_with_params(h, params, "A"))


@register("lum_histogram")
def q_lum_histogram(spark, sf_dir):
    return tone.lum_histogram(tb.hdr(spark, sf_dir))


@register("lum_cdf")
def q_lum_cdf(spark, sf_dir):
    return _round_cols(tone.lum_cdf(tone.lum_histogram(tb.hdr(spark, sf_dir))), ("cdf_norm",))


@register("histeq_tonemap")
def q_histeq_tonemap(spark, sf_dir):
    return _with_8bit(tone.histeq_tonemap(tb.hdr(spark, sf_dir)))


# ---------------------------------------------------------- linear algebra (D)
def _gram_cells(df: DataFrame) -> DataFrame:
    return _round_cols(df.select(F.col("i").cast("int"), F.col("j").cast("int"), "v"), ("v",))


@register("vector_add")
def q_vector_add(spark, sf_dir):
    a, b = tb.vectors(spark, sf_dir)
    return _round_cols(mx.vector_add(a, b), ("v",))


@register("matmul_coo")
def q_matmul_coo(spark, sf_dir):
    # Sparse input: one join row per pair of stored cells of a user.
    m = tb.sparse_cells(spark, sf_dir)
    return _gram_cells(mx.matmul_coo(mx.transpose(m), m))


@register("matmul_int")
def q_matmul_int(spark, sf_dir):
    m = tb.integer_cells(spark, sf_dir)
    return mx.matmul_block(mx.transpose(m), m, bs=16, side=2)


@register("matmul_block")
def q_matmul_block(spark, sf_dir):
    e = tb.embedding_cells(spark, sf_dir)
    return _gram_cells(mx.matmul_block(mx.transpose(e), e, bs=128))


@register("matmul_gram")
def q_matmul_gram(spark, sf_dir):
    rows = tb.read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("i"), F.col("embedding").cast("array<double>").alias("vec"))
    return _gram_cells(mx.gram(rows))


@register("matmul_rect")
def q_matmul_rect(spark, sf_dir):
    emb = tb.read_table(spark, sf_dir, "embeddings")
    # Right factor: the label-centroid matrix (dimension x label), derived
    # from the same table by one aggregation; its size is checked before every
    # task gets it.
    centroids = (emb.select("label", F.posexplode("embedding").alias("k", "x"))
                 .groupBy("k", "label").agg(F.avg(F.col("x").cast("double")).alias("v"))
                 .select(F.col("k").cast("long").alias("i"),
                         F.col("label").cast("long").alias("j"), "v"))
    rows = emb.select(F.col("vec_id").alias("i"), F.col("embedding").alias("vec"))
    prod = mx.matmul_rows(rows, centroids).select("i", F.posexplode("vec").alias("j", "v"))
    return _round_cols(prod, ("v",))


@register("matrix_diff")
def q_matrix_diff(spark, sf_dir):
    # Truncating gray (GPU kernel) against half-even gray (library
    # conversion), compared cell by cell.
    p = tb.pixels8(spark, sf_dir)
    a = pxo.gray(p, "floor")
    b = pxo.gray(p, "half_even")
    return mx.matrix_diff(a, b, keys=("image_id", "y", "x"), value="gray")


@register("matrix_diff_summary")
def q_matrix_diff_summary(spark, sf_dir):
    p = tb.pixels8(spark, sf_dir)
    return mx.matrix_diff_summary(pxo.gray(p, "floor"), pxo.gray(p, "half_even"),
                                  keys=("image_id", "y", "x"), value="gray").select(
        "n_cells", "n_diff", F.col("max_abs_diff").cast("int").alias("max_abs_diff"))


@register("row_blocks")
def q_row_blocks(spark, sf_dir):
    ev = tb.read_table(spark, sf_dir, "events").select(F.col("event_id").alias("i"))
    return mx.row_blocks(ev, ROW_BLOCKS)


@register("row_block_extents")
def q_row_block_extents(spark, sf_dir):
    ev = tb.read_table(spark, sf_dir, "events").select(F.col("event_id").alias("i"))
    return mx.block_extents(mx.row_blocks(ev, ROW_BLOCKS))


# ---------------------------------------------------------------- clusters (C)
@register("value_histogram")
def q_value_histogram(spark, sf_dir):
    return tb.values(spark, sf_dir)


def _grid_assigned(spark, sf_dir):
    vals = tb.values(spark, sf_dir)
    return cl.nearest_centre(vals, cl.grid_centres(spark, vals, CLUSTER_K))


@register("nearest_centre")
def q_nearest_centre(spark, sf_dir):
    return _grid_assigned(spark, sf_dir)


@register("cluster_weighted_mean")
def q_cluster_weighted_mean(spark, sf_dir):
    return _round_cols(cl.cluster_weighted_mean(_grid_assigned(spark, sf_dir)), ("mean",))


@register("lloyd_centres")
def q_lloyd_centres(spark, sf_dir):
    vals = tb.values(spark, sf_dir)
    cents = cl.lloyd(vals, cl.grid_centres(spark, vals, CLUSTER_K), LLOYD_ITERATIONS)
    return _round_cols(cents, ("c",))


def _embedding_clusters(spark, sf_dir):
    return vectors.kmeans_vectors(tb.read_table(spark, sf_dir, "embeddings"), VECTOR_K,
                                  LLOYD_ITERATIONS, id="vec_id", vec="embedding")


@register("kmeans_vectors")
def q_kmeans_vectors(spark, sf_dir):
    rows, _ = _embedding_clusters(spark, sf_dir)
    return _round_cols(rows.withColumnRenamed("id", "vec_id"), ("dist",))


@register("kmeans_vector_centres")
def q_kmeans_vector_centres(spark, sf_dir):
    _, model = _embedding_clusters(spark, sf_dir)
    return _round_cols(vectors.centre_cells(spark, model), ("c",))


@register("kmeans_tonemap")
def q_kmeans_tonemap(spark, sf_dir):
    return _with_8bit(cl.kmeans_tonemap(tb.hdr(spark, sf_dir), seed=42))


@register("kmeans_tonemap_per_image")
def q_kmeans_tonemap_per_image(spark, sf_dir):
    # One codebook per image (grid start per image), as when each image is
    # tone-mapped on its own.
    return _with_8bit(cl.kmeans_tonemap_per_image(tb.hdr(spark, sf_dir), init="grid"))


@register("kmeans_tonemap_grid")
def q_kmeans_tonemap_grid(spark, sf_dir):
    # Same pipeline from centres spread evenly over the luminance range, so
    # that an SQL oracle can reproduce every Lloyd step.
    return _with_8bit(cl.kmeans_tonemap(tb.hdr(spark, sf_dir), init="grid"))


# ----------------------------------------------------------------- timings (E)
def _timings(spark, sf_dir):
    return tb.timing_runs(spark, sf_dir)


@register("timing_mean")
def q_timing_mean(spark, sf_dir):
    return _round_cols(tm.timing_mean(_timings(spark, sf_dir)), ("mean_gpu", "mean_cpu"))


@register("timing_speedup")
def q_timing_speedup(spark, sf_dir):
    return _round_cols(tm.timing_speedup(_timings(spark, sf_dir)), ("speedup",))


@register("timing_variant_ratio")
def q_timing_variant_ratio(spark, sf_dir):
    return _round_cols(tm.timing_variant_ratio(_timings(spark, sf_dir), "naive"), ("ratio",))


# --------------------------------------------------- undefined samples (NaN, NULL)
@register("tone_log_holes")
def q_tone_log_holes(spark, sf_dir):
    return _with_8bit(tone.tone_log(tb.hdr_holes(spark, sf_dir), TONE_P1, TONE_P2))


@register("histeq_tonemap_holes")
def q_histeq_tonemap_holes(spark, sf_dir):
    out = tone.histeq_tonemap(tb.hdr_holes(spark, sf_dir))
    return _with_8bit(out.fillna(-1, ["bin"]))        # -1: no bin


@register("kmeans_tonemap_holes")
def q_kmeans_tonemap_holes(spark, sf_dir):
    return _with_8bit(cl.kmeans_tonemap(tb.hdr_holes(spark, sf_dir), init="grid"))


@register("kmeans_tonemap_per_image_holes")
def q_kmeans_tonemap_per_image_holes(spark, sf_dir):
    return _with_8bit(cl.kmeans_tonemap_per_image(tb.hdr_holes(spark, sf_dir), init="grid"))


@register("kmeans_tonemap_per_image_random")
def q_kmeans_tonemap_per_image_random(spark, sf_dir):
    return _with_8bit(cl.kmeans_tonemap_per_image(tb.hdr(spark, sf_dir), init="random", seed=42))


# ------------------------------------------------------------- remaining operators
@register("convolve_reflect101")
def q_convolve_reflect101(spark, sf_dir):
    # 40 rows in bands of 13: the last band has one row, the halo two.
    return stencil.tiled(pxo.gray(tb.pixels8(spark, sf_dir)), CONVOLVE_MASK,
                         border="reflect101", band_rows=13)


@register("hdr_promote")
def q_hdr_promote(spark, sf_dir):
    return _round_cols(hdr_from_samples(tb.hdr_samples(spark, sf_dir))[0], ("b", "g", "r"))


@register("hdr_rejects")
def q_hdr_rejects(spark, sf_dir):
    return hdr_from_samples(tb.hdr_samples(spark, sf_dir))[1]


@register("timing_log_rows")
def q_timing_log_rows(spark, sf_dir):
    return parse_timing_lines(tb.log_lines(spark, sf_dir))


@register("timing_log_rejects")
def q_timing_log_rejects(spark, sf_dir):
    return rejected_lines(tb.log_lines(spark, sf_dir))


@register("scale_hdr")
def q_scale_hdr(spark, sf_dir):
    return _round_cols(scale_hdr(tb.hdr(spark, sf_dir)), ("b", "g", "r"))


@register("rgba_round_trip")
def q_rgba_round_trip(spark, sf_dir):
    return pxo.from_rgba(pxo.to_rgba(tb.pixels8(spark, sf_dir)))


@register("channel_merge")
def q_channel_merge(spark, sf_dir):
    return pxo.channel_merge(pxo.channel_split(tb.pixels8(spark, sf_dir)))


@register("image_type_name")
def q_image_type_name(spark, sf_dir):
    ev = tb.read_table(spark, sf_dir, "events")
    code = (F.col("event_id") % 64).cast("int")
    return ev.select("event_id", code.alias("code"), px.image_type_name(code).alias("name"))


@register("lum_cdf_exclusive")
def q_lum_cdf_exclusive(spark, sf_dir):
    hist = tone.lum_histogram(tb.hdr(spark, sf_dir))
    return _round_cols(tone.lum_cdf(hist, exclusive=True), ("cdf_norm",))


@register("cluster_mean")
def q_cluster_mean(spark, sf_dir):
    return _round_cols(cl.cluster_weighted_mean(_grid_assigned(spark, sf_dir), weight="count"),
                       ("mean",))


@register("tone_dispatch")
def q_tone_dispatch(spark, sf_dir):
    h = tb.hdr(spark, sf_dir)
    out = [tone.tonemap(h, mode, TONE_P1, TONE_P2).withColumn("mode", F.lit(mode[0]))
           for mode in ("Logarithmic", "adaptive", "G")]
    return _round_cols(out[0].unionByName(out[1]).unionByName(out[2]), ("b", "g", "r"))


@register("write_8bit")
def q_write_8bit(spark, sf_dir):
    return to_8bit(tone.tone_log(tb.hdr(spark, sf_dir), TONE_P1, TONE_P2))


# ------------------------------------------------- tables without a dense index
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@register("row_blocks_by_order")
def q_row_blocks_by_order(spark, sf_dir):
    lines = tb.read_table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    return mx.row_blocks_by(lines, ROW_BLOCKS, LINE_ORDER)


@register("vector_add_by_order")
def q_vector_add_by_order(spark, sf_dir):
    a = tb.read_table(spark, sf_dir, "events").select("ts", "event_id", F.col("value").alias("v"))
    b = tb.read_table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey",
                                                      (F.col("o_custkey") * F.lit(0.5)).alias("v"))
    return mx.vector_add_by(a, b, ("ts", "event_id"), ("o_totalprice", "o_orderkey"))


# ------------------------------------------------------------------ packed tiles
# A 31 x 31 mask of rank two; SQL has the same formula.
LARGE_MASK = tuple(tuple((i % 4 + 1) * (j % 5 - 2) + i - 15 for j in range(31)) for i in range(31))


def _gray_tiles(spark, sf_dir):
    return tiles.pack(pxo.gray(tb.pixels8(spark, sf_dir)), "gray", "uint8")


@register("sobel_tiles")
def q_sobel_tiles(spark, sf_dir):
    return tiles.unpack(tiles.sobel_x(_gray_tiles(spark, sf_dir)))


@register("sobel_reflect101_tiles")
def q_sobel_reflect101_tiles(spark, sf_dir):
    return tiles.unpack(tiles.sobel_x(_gray_tiles(spark, sf_dir), border="reflect101"))


@register("convolve_tiles")
def q_convolve_tiles(spark, sf_dir):
    return tiles.unpack(tiles.convolve(_gray_tiles(spark, sf_dir), CONVOLVE_MASK))


@register("convolve_reflect101_tiles")
def q_convolve_reflect101_tiles(spark, sf_dir):
    return tiles.unpack(tiles.convolve(_gray_tiles(spark, sf_dir), CONVOLVE_MASK, border="reflect101"))


@register("convolve_large_mask")
def q_convolve_large_mask(spark, sf_dir):
    out = tiles.convolve(_gray_tiles(spark, sf_dir), LARGE_MASK, clamp=False)
    return tiles.unpack(out, types=("bigint",))


@register("gray_tiles")
def q_gray_tiles(spark, sf_dir):
    colour = tiles.pack(tb.pixels8(spark, sf_dir), ("b", "g", "r"), "uint8")
    return tiles.unpack(tiles.gray(colour))


# ------------------------------------------------------------ uneven inner indices
@register("matmul_sparse")
def q_matmul_sparse(spark, sf_dir):
    # Inner index 0 holds a third of all cells.
    ev = tb.read_table(spark, sf_dir, "events")
    cells = ev.select((F.col("event_id") % 997).alias("i"),
                      F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id") + 1)
                      .cast("long").alias("j"), F.floor(F.col("value") * 100).cast("long").alias("v"))
    return mx.matmul_sparse(cells, mx.transpose(cells.where("i < 400")), heavy_pairs=1 << 16)


# ------------------------------------------------------- raster files, appended logs
def _raster(spark, sf_dir, values):
    """The pixels of the events written as raster files and read in small ranges."""
    path = scratch_path(spark, "raster")
    packed = tiles.pack(tb.pixels8(spark, sf_dir).withColumn("a", (F.col("x") * 5) % 256), values, "uint8")
    raster.write_raster(raster.tiles_to_strips(packed), path)
    return raster.read_raster(spark, path, split_bytes=2000)


@register("raster_color")
def q_raster_color(spark, sf_dir):
    return raster.raster_pixels(_raster(spark, sf_dir, ("r", "g", "b")), "color")


@register("raster_gray")
def q_raster_gray(spark, sf_dir):
    return raster.raster_pixels(_raster(spark, sf_dir, ("r", "g", "b")), "gray")


@register("raster_rgba")
def q_raster_rgba(spark, sf_dir):
    return raster.raster_pixels(_raster(spark, sf_dir, ("r", "g", "b", "a")), "rgba")


@register("raster_sobel")
def q_raster_sobel(spark, sf_dir):
    # From file bytes to tiles to gradient: pixels become rows only at the end.
    scan = raster.strips_to_tiles(_raster(spark, sf_dir, ("b", "g", "r")), 3)
    return tiles.unpack(tiles.sobel_x(tiles.gray(scan)))


@register("timing_append_once")
def q_timing_append_once(spark, sf_dir):
    runs, log = _timings(spark, sf_dir), scratch_path(spark, "timings")
    for batch in (0, 1, 0):                           # batch 0 comes twice
        append_once(runs.where(F.col("event_id") % 2 == batch), log, f"run-{batch}")
    return read_appended(spark, log, runs.schema)


# --------------------------------------------------- co-located joins, block digests
@register("vector_add_bucketed")
def q_vector_add_bucketed(spark, sf_dir):
    a, b = (bucketed(v, ["i"], 8, "vector") for v in tb.vectors(spark, sf_dir))
    return _round_cols(mx.vector_add_colocated(a, b), ("v",))


@register("matrix_diff_bucketed")
def q_matrix_diff_bucketed(spark, sf_dir):
    p, keys = tb.pixels8(spark, sf_dir), ("image_id", "y", "x")
    a, b = (bucketed(pxo.gray(p, how), keys, 8, "gray") for how in ("floor", "half_even"))
    return mx.matrix_diff_colocated(a, b, keys=keys, value="gray")


@register("matrix_diff_blocks")
def q_matrix_diff_blocks(spark, sf_dir):
    # The conversions differ in a few rows of every third image only.
    p, keys = tb.pixels8(spark, sf_dir), ("image_id", "y", "x")
    other = F.when((F.col("image_id") % 3 == 0) & (F.col("y") < 5), px.gray(rounding="half_even")).otherwise(
        px.gray())
    return mx.matrix_diff_blocks(pxo.gray(p), p.select(*keys, other.alias("gray")), keys=keys,
                                 value="gray", block=10)


# ------------------------------------------------------- some images of a pixel store
@register("tone_store_params")
def q_tone_store_params(spark, sf_dir):
    path = scratch_path(spark, "pixels")
    h = tb.hdr(spark, sf_dir)
    tone.write_pixel_store(h, path)
    store = spark.read.schema(h.schema).parquet(path)
    ids = tb.read_table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / tb.IMAGE_PIXELS).cast("int").alias("image_id")).distinct()
    params = ids.where("image_id % 4 = 1").select(
        "image_id", (F.lit(TONE_P1) + F.lit(0.1) * (F.col("image_id") % 3)).alias("p1"),
        F.lit(TONE_P2).alias("p2"))
    return _with_8bit(tone.tone_store_with_params(store, params, "A").select("image_id", "y", "x", *"bgr"))


# --------------------------------------------------------------- SQL functions
PIXEL_SQL = """
select image_id, y, x, px_gray8(r, g, b) gray, px_gray8_even(r, g, b) gray_even,
       px_exposure8(b, 1.5, -20) exposed, px_wrap8(2 * g) doubled, px_clamp8(r - g + 0L) clamped,
       px_abs8(r - g + 0L) absolute, px_quantise8(b / 300D) quantised, px_image_type_name(r) name
from pixels8"""


@register("pixel_functions_sql")
def q_pixel_functions_sql(spark, sf_dir):
    px_sql.register(spark)
    return spark.sql(PIXEL_SQL.replace("from pixels8", "from {pixels8}"), pixels8=tb.pixels8(spark, sf_dir))
