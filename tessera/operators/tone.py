"""Tone mapping of HDR pixel tables ``(image_id, y, x, b, g, r)`` (doubles).

Global operators need one statistic per image (maximum sample, log-luminance
range, luminance CDF).  They are computed by partial + final aggregation,
written once to the checkpoint folder and joined back by ``image_id`` with a
size-checked broadcast or, beyond the check, a salted shuffle join
(``tessera.plans.joins.join_small``), so a hot image is never gathered in one
task.  The per-pixel formulas are built-in expressions inside one codegen span.

Undefined samples (NaN or NULL) are left out of the statistics; results that
depend on one are NULL (0 after quantising), and the pixel's row stays.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import pixel as px
from tessera.plans.joins import broadcast_fits, join_small, materialise, size_in_bytes

KEYS = ["image_id", "y", "x"]
CHANNELS = ("b", "g", "r")

# Number of log-luminance bins of the histogram equalisation.
HISTEQ_BINS = 1024


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


# --------------------------------------------------------------------- stats
def defined(c: str | Column) -> Column:
    """The value, NULL instead of NaN."""
    return F.nanvl(px.col(c), F.lit(None).cast("double"))


def max_sample(hdr: DataFrame) -> DataFrame:
    """Per image: the largest defined channel sample, never below 0."""
    return hdr.groupBy("image_id").agg(F.greatest(
        F.lit(0.0), F.max(F.greatest(*[defined(c) for c in CHANNELS]))).alias("max_sample"))


def _with_max(hdr: DataFrame) -> DataFrame:
    return join_small(hdr, max_sample(hdr), "image_id", "left")


# -------------------------------------------------------------- per-sample maps
def log_map(v: Column, m: Column, q, k) -> Column:
    """``log10(1 + q v) / log10(1 + k M)``; NULL when the denominator is 0."""
    return F.log10(1 + _lit(q) * v) / F.nullif(F.log10(1 + _lit(k) * m), F.lit(0.0))


def adaptive_map(v: Column, m: Column, q, k) -> Column:
    """Adaptive logarithmic map with bias ``q`` and screen factor ``k``.

    ``k ln(1+v) / (100 log10(1+M) * ln(2 + 8 v/M) ^ (ln q / ln 0.5))``; the bias
    power applies to the logarithm, as in the original formula.
    """
    expo = F.log(_lit(q)) / F.lit(math.log(0.5))
    inner = F.log(2 + 8 * px.safe_div(v, m))
    den = F.lit(100.0) * F.log10(1 + m) * F.pow(inner, expo)
    return _lit(k) * F.log(1 + v) / F.nullif(den, F.lit(0.0))


def gamma_map(v: Column, f_stop, gamma) -> Column:
    """``(v * 2^f_stop) ^ (1/gamma)``."""
    return F.pow(v * F.pow(F.lit(2.0), _lit(f_stop)), F.lit(1.0) / _lit(gamma))


def _check_bias(q) -> None:
    if not isinstance(q, Column) and q <= 0:
        raise ValueError("bias q must be > 0 (its logarithm is taken)")


def _check_gamma(gamma) -> None:
    if not isinstance(gamma, Column) and gamma == 0:
        raise ValueError("gamma must be non-zero")


# ------------------------------------------------------------------ operators
def tone_log(hdr: DataFrame, q: float, k: float) -> DataFrame:
    j = _with_max(hdr)
    m = F.col("max_sample")
    return j.select(*KEYS, *[defined(log_map(F.col(c), m, q, k)).alias(c) for c in CHANNELS])


def tone_adaptive(hdr: DataFrame, q: float, k: float) -> DataFrame:
    _check_bias(q)
    j = _with_max(hdr)
    m = F.col("max_sample")
    return j.select(*KEYS, *[defined(adaptive_map(F.col(c), m, q, k)).alias(c) for c in CHANNELS])


def tone_gamma(hdr: DataFrame, f_stop: float, gamma: float) -> DataFrame:
    _check_gamma(gamma)
    return hdr.select(*KEYS, *[defined(gamma_map(F.col(c), f_stop, gamma)).alias(c) for c in CHANNELS])


def tonemap(hdr: DataFrame, mode: str, p1: float, p2: float) -> DataFrame:
    """Dispatch on ``mode``: L(ogarithmic), A(daptive) or G(amma), any case.

    ``p1``/``p2`` are (q, k) for L and A, (f_stop, gamma) for G.
    """
    m = (mode or "")[:1].upper()
    if m == "L":
        return tone_log(hdr, p1, p2)
    if m == "A":
        return tone_adaptive(hdr, p1, p2)
    if m == "G":
        return tone_gamma(hdr, p1, p2)
    raise ValueError(f"unknown tone-map mode {mode!r}; use L, G or A")


def tone_with_params(hdr: DataFrame, params: DataFrame, mode: str) -> DataFrame:
    """Batch tone map with per-image parameters ``(image_id, p1, p2)``.

    ``params`` has one row per image; it is joined with a size check.  Pixels
    of an image without parameters stay, with NULL samples.
    """
    m = (mode or "")[:1].upper()
    if m not in ("L", "A", "G"):
        raise ValueError(f"unknown tone-map mode {mode!r}; use L, G or A")
    per_image = params.select("image_id", "p1", "p2")
    if m != "G":
        # Both per-image tables are small: join them first, materialise once.
        per_image = max_sample(hdr).join(per_image, "image_id", "left")
    j = join_small(hdr, per_image, "image_id", "left")
    p1, p2 = F.col("p1"), F.col("p2")
    if m == "G":
        exprs = [gamma_map(F.col(c), p1, p2) for c in CHANNELS]
    else:
        fn = log_map if m == "L" else adaptive_map
        exprs = [fn(F.col(c), F.col("max_sample"), p1, p2) for c in CHANNELS]
    return j.select(*KEYS, *[defined(e).alias(c) for e, c in zip(exprs, CHANNELS)])


def write_pixel_store(hdr: DataFrame, path: str) -> None:
    """Write float pixels as a table with a folder per image; an image is spread
    over as many files as it takes."""
    hdr.write.mode("overwrite").partitionBy("image_id").parquet(path)


def tone_store_with_params(store: DataFrame, params: DataFrame, mode: str) -> DataFrame:
    """``tone_with_params`` for the images that ``params`` names, of a table from
    ``write_pixel_store``.

    The parameter table, once it is under the broadcast threshold, prunes the
    folders of the scan at run time, so other images are never read.
    """
    params = materialise(params.select("image_id", "p1", "p2"), "params")
    least = params.agg(F.min("image_id")).first()[0]
    if least is None:
        return tone_with_params(store.where(F.lit(False)), params, mode)
    # Spark prunes by a table only if that is filtered, so the bound is spelled out.
    wanted = params.where(F.col("image_id") >= F.lit(least)).select("image_id")
    fits = broadcast_fits(store.sparkSession, size_in_bytes(params))
    pixels = store.join(F.broadcast(wanted) if fits else wanted, "image_id", "left_semi")
    return tone_with_params(pixels, params, mode)


# ------------------------------------------------------ histogram equalisation
def rgb_to_xyy(hdr: DataFrame, delta: float = px.LOG_Y_DELTA) -> DataFrame:
    """``(image_id, y, x, cx, cy, log_y)``: chromaticity and log10 luminance.

    Black pixels (X+Y+Z = 0) have NULL chromaticity; a pixel with an undefined
    sample has no value at all.
    """
    xx, yy, zz = px.rgb_to_xyz(F.col("r"), F.col("g"), F.col("b"))
    total = xx + yy + zz
    return hdr.select(*KEYS,
                      defined(px.safe_div(xx, total)).alias("cx"),
                      defined(px.safe_div(yy, total)).alias("cy"),
                      defined(F.log10(F.lit(delta) + yy)).alias("log_y"))


def _lum_range(xyy: DataFrame) -> DataFrame:
    return xyy.groupBy("image_id").agg(F.min("log_y").alias("min_log_y"),
                                       F.max("log_y").alias("max_log_y"))


def bin_index(log_y: Column, lo: Column, hi: Column, bins: int) -> Column:
    """``min(bins-1, floor(bins (log_y - lo) / (hi - lo)))``; bin 0 for a flat image, NULL for an
    undefined value."""
    scaled = F.floor(F.lit(bins) * (log_y - lo) / F.nullif(hi - lo, F.lit(0.0)))
    index = F.coalesce(F.least(F.lit(bins - 1), scaled.cast("int")), F.lit(0))
    return F.when(log_y.isNotNull(), index)


def _binned(hdr: DataFrame, bins: int) -> DataFrame:
    if bins < 1:
        raise ValueError("bins must be >= 1")
    xyy = rgb_to_xyy(hdr)
    j = join_small(xyy, _lum_range(xyy), "image_id", "left")
    return j.select(*KEYS, "cx", "cy", "log_y",
                    bin_index(F.col("log_y"), F.col("min_log_y"), F.col("max_log_y"),
                              bins).alias("bin"))


def lum_histogram(hdr: DataFrame, bins: int = HISTEQ_BINS) -> DataFrame:
    """Non-empty log-luminance bins ``(image_id, bin, n)``."""
    return _histogram(_binned(hdr, bins))


def _histogram(binned: DataFrame) -> DataFrame:
    return (binned.where("bin is not null").groupBy("image_id", "bin")
            .agg(F.count(F.lit(1)).alias("n")))


def lum_cdf(hist: DataFrame, bins: int = HISTEQ_BINS, exclusive: bool = False) -> DataFrame:
    """CDF per image over its (at most ``bins``) histogram rows.

    Windows are partitioned by image over at most ``bins`` rows, so no window
    partition grows with the image size.  ``cdf_norm`` divides by the CDF's
    last bin (the pixel count for the inclusive CDF).
    """
    w = Window.partitionBy("image_id").orderBy("bin").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("image_id")
    cdf = F.sum("n").over(w)
    total = F.sum("n").over(whole)
    if exclusive:
        cdf = cdf - F.col("n")
        last_n = F.max(F.when(F.col("bin") == bins - 1, F.col("n"))).over(whole)
        last = total - F.coalesce(last_n, F.lit(0))
    else:
        last = total
    return hist.select("image_id", "bin", "n", cdf.alias("cdf"),
                       (cdf / F.nullif(last, F.lit(0)).cast("double")).alias("cdf_norm"))


def histeq_tonemap(hdr: DataFrame, bins: int = HISTEQ_BINS,
                   exclusive: bool = False) -> DataFrame:
    """Histogram equalisation of log luminance in xyY, back to B, G, R.

    Output ``(image_id, y, x, bin, b, g, r)``; undefined (black) pixels are NULL.
    """
    binned = _binned(hdr, bins)
    cdf = lum_cdf(_histogram(binned), bins, exclusive).select("image_id", "bin", "cdf_norm")
    j = join_small(binned, cdf, ["image_id", "bin"], "left")
    y_new = F.col("cdf_norm")
    ratio = px.safe_div(y_new, F.col("cy"))
    x_new = F.col("cx") * ratio
    z_new = (1 - F.col("cx") - F.col("cy")) * ratio
    r, g, b = px.xyz_to_rgb(x_new, y_new, z_new)
    return j.select(*KEYS, "bin", b.alias("b"), g.alias("g"), r.alias("r"))
