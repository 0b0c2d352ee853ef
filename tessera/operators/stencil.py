"""Neighbourhood operators (convolution, Sobel) over ``(image_id, y, x, v)``.

Three physical strategies, all free of per-image groups (an image may be a
third of the corpus, so nothing is ever grouped by ``image_id`` alone):

* **scatter** (any odd k x k mask): every pixel sends ``w * v`` to each target
  it influences, then one aggregation on the pixel key sums the
  contributions.  Input is row-major, so the map-side partial aggregate
  collapses most contributions before the shuffle.
* **bands** (3-tap separable masks such as Sobel): pixels are hash-partitioned
  once by ``(image_id, band)`` where a band is ``band_rows`` image rows plus a
  one-row halo copied from each neighbouring band.  A horizontal window over
  ``(image_id, band, y)`` and a vertical window over ``(image_id, band, x)``
  both reuse that single shuffle.  Groups never exceed ``band_rows + 2`` rows.
* **tiles** (any odd mask, default): bands of rows cut in tiles of columns
  (halo of ``k // 2`` on all sides), one shuffle by ``(image_id, band, tile)``
  with rows sorted inside each partition, then ``mapInPandas`` turns each tile
  into one NumPy array and applies the mask by shifted slices.  A group is at
  most ``(band_rows + k - 1) x (TILE_COLS + k - 1)`` pixels, independent of the
  image size and of the corpus size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.pixel import clamp8

KEYS = ["image_id", "y", "x"]

# The Sobel-x mask, rows top to bottom (cross-correlation).
SOBEL_X = ((-1, 0, 1), (-2, 0, 2), (-1, 0, 1))
# Its separable factors: vertical smoothing and horizontal derivative.
SOBEL_X_VERTICAL = (1, 2, 1)
SOBEL_X_HORIZONTAL = (-1, 0, 1)

BORDERS = ("zero", "reflect101")


def _check_mask(mask) -> int:
    k = len(mask)
    if k == 0 or k % 2 == 0 or any(len(row) != k for row in mask):
        raise ValueError("mask must be square with an odd width")
    return k


def convolve(df: DataFrame, mask, value: str = "gray", clamp: bool = True,
             out: str | None = None, method: str = "tiles", band_rows: int = 64) -> DataFrame:
    """Cross-correlate every image with an odd k x k integer or float mask.

    Neighbours outside the image count as zero.  Output has one row per input
    pixel: ``(image_id, y, x, out)``; ``clamp`` saturates to 0..255.
    ``method="tiles"`` (default) works band by band in NumPy;
    ``method="scatter"`` stays in the JVM and emits one row per non-zero
    weight before a partially aggregated shuffle.
    """
    if method == "tiles":
        return tiled(df, mask, value=value, clamp=clamp, band_rows=band_rows, out=out)
    if method != "scatter":
        raise ValueError(f"unknown method {method!r}")
    k = _check_mask(mask)
    r = k // 2
    out = out or value
    entries = []
    for i in range(k):
        for j in range(k):
            w = mask[i][j]
            is_self = i == r and j == r
            if w != 0 or is_self:
                entries.append((i - r, j - r, w, is_self))
    numeric = "int" if all(isinstance(w, int) for row in mask for w in row) else "double"
    arr = F.array(*[
        F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx"),
                 F.lit(w).cast(numeric).alias("w"), F.lit(s).alias("s"))
        for dy, dx, w, s in entries
    ])
    sent = (df.select("image_id", "y", "x", F.col(value).alias("v"),
                      F.explode(arr).alias("m"))
            .select("image_id",
                    (F.col("y") - F.col("m.dy")).alias("y"),
                    (F.col("x") - F.col("m.dx")).alias("x"),
                    (F.col("v") * F.col("m.w")).alias("c"),
                    F.col("m.s").alias("s"))
            .where((F.col("y") >= 0) & (F.col("x") >= 0)))
    # Targets beyond the right/bottom edge receive contributions but no
    # self-marker; the marker also keeps pixels with no contributions.
    agg = (sent.groupBy(*KEYS)
           .agg(F.sum("c").alias("acc"), F.max(F.col("s").cast("int")).alias("present"))
           .where(F.col("present") == 1))
    res = F.col("acc")
    if clamp:
        res = clamp8(res).cast("int") if numeric == "int" else F.least(
            F.lit(255.0), F.greatest(F.lit(0.0), res))
    return agg.select(*KEYS, res.alias(out))


def _neighbours(v: Column, pos: str, order_w: Window, border: str) -> tuple[Column, Column]:
    """Previous/next sample along ``pos`` with the border rule applied."""
    prev_raw = F.when(F.lag(pos, 1).over(order_w) == F.col(pos) - 1, F.lag(v, 1).over(order_w))
    next_raw = F.when(F.lead(pos, 1).over(order_w) == F.col(pos) + 1, F.lead(v, 1).over(order_w))
    if border == "zero":
        zero = F.lit(0)
        return F.coalesce(prev_raw, zero), F.coalesce(next_raw, zero)
    # reflect-101: the missing neighbour mirrors the one on the other side;
    # a line of length 1 mirrors onto itself.
    return F.coalesce(prev_raw, next_raw, v), F.coalesce(next_raw, prev_raw, v)


def separable3(df: DataFrame, vertical=SOBEL_X_VERTICAL, horizontal=SOBEL_X_HORIZONTAL,
               value: str = "gray", border: str = "zero", clamp: bool = True,
               band_rows: int = 64, out: str | None = None) -> DataFrame:
    """3x3 separable mask ``vertical (x) horizontal`` by banded windows."""
    if border not in BORDERS:
        raise ValueError(f"border must be one of {BORDERS}")
    if len(vertical) != 3 or len(horizontal) != 3:
        raise ValueError("separable3 needs 3-tap factors")
    if band_rows < 1:
        raise ValueError("band_rows must be >= 1")
    out = out or value
    b = F.lit(band_rows)
    own = F.floor(F.col("y") / b).cast("int")
    # Rows at a band edge are also sent to the neighbouring band as halo.
    offsets = F.explode(F.array(F.lit(0), F.lit(-1), F.lit(1))).alias("o")
    banded = (df.select("image_id", "y", "x", F.col(value).alias("v"), own.alias("own"), offsets)
              .where((F.col("o") == 0)
                     | ((F.col("o") == -1) & (F.col("y") % b == 0) & (F.col("own") > 0))
                     | ((F.col("o") == 1) & (F.col("y") % b == band_rows - 1)))
              .select("image_id", "y", "x", "v", (F.col("own") + F.col("o")).alias("band"))
              .repartition("image_id", "band"))
    row_w = Window.partitionBy("image_id", "band", "y").orderBy("x")
    left, right = _neighbours(F.col("v"), "x", row_w, border)
    h0, h1, h2 = horizontal
    hsum = left * F.lit(h0) + F.col("v") * F.lit(h1) + right * F.lit(h2)
    horiz = banded.select("image_id", "band", "y", "x", hsum.alias("h"))
    col_w = Window.partitionBy("image_id", "band", "x").orderBy("y")
    up, down = _neighbours(F.col("h"), "y", col_w, border)
    v0, v1, v2 = vertical
    vsum = up * F.lit(v0) + F.col("h") * F.lit(v1) + down * F.lit(v2)
    res = clamp8(vsum) if clamp else vsum
    return (horiz.select("image_id", "band", "y", "x", res.alias(out))
            .where(F.floor(F.col("y") / b).cast("int") == F.col("band"))
            .select(*KEYS, out))


# Columns of a tile: a wide mosaic is cut in x as well.
TILE_COLS = 2048


def _owners(c: str, size: int, halo: int):
    """The tiles along one axis that need a pixel: its own, and the neighbour
    whose halo it lies in (edge pixels only)."""
    own = F.floor(F.col(c) / F.lit(size)).cast("int")
    pos = F.col(c) % F.lit(size)
    return F.explode(F.array_compact(F.array(
        own, F.when((pos < halo) & (own > 0), own - 1),
        F.when(pos >= size - halo, own + 1))))


def _banded(df: DataFrame, value: str, band_rows: int, halo: int) -> DataFrame:
    """``(image_id, band, tile, y, x, v)``: each pixel in its tile, plus copies of
    the ``halo`` edge rows and columns of a tile in the neighbouring tiles."""
    if band_rows < 1:
        raise ValueError("band_rows must be >= 1")
    if halo > min(band_rows, TILE_COLS):
        raise ValueError("band_rows must be at least the mask radius")
    v = F.col(value).alias("v")
    rows = df.select("image_id", "y", "x", v, _owners("y", band_rows, halo).alias("band"))
    return rows.select("image_id", "band", _owners("x", TILE_COLS, halo).alias("tile"), "y", "x", "v")


def _band_result(mask: np.ndarray, band: int, tile: int, image_id, ys, xs, vs, band_rows: int,
                 tile_cols: int, border: str, clamp: bool):
    """Apply ``mask`` to one tile given as coordinate arrays; core pixels only."""
    k = mask.shape[0]
    r = k // 2
    lo_core, hi_core = band * band_rows, band * band_rows + band_rows - 1
    lo_col, hi_col = tile * tile_cols, tile * tile_cols + tile_cols - 1
    y0, y1 = int(ys.min()), int(ys.max())
    x0, x1 = int(xs.min()), int(xs.max())
    h, w = y1 - y0 + 1, x1 - x0 + 1
    grid = np.zeros((h, w), dtype=mask.dtype)
    present = np.zeros((h, w), dtype=bool)
    grid[ys - y0, xs - x0] = vs
    present[ys - y0, xs - x0] = True
    if border == "zero":
        padded = np.pad(grid, r)
    else:
        # Mirror as many rows and columns as the halo lacks (it ends at an image edge).
        padded = grid
        for axis, size, before, after in (
                (0, h, lo_core - y0, y1 - hi_core), (1, w, lo_col - x0, x1 - hi_col)):
            lack = (r - min(r, max(0, before)), r - min(r, max(0, after)))
            rest = (r - lack[0], r - lack[1])
            wide = [(0, 0), (0, 0)]
            wide[axis] = lack
            padded = np.pad(padded, wide, mode="reflect" if size > 1 else "edge")
            wide[axis] = rest
            padded = np.pad(padded, wide)
    acc = np.zeros((h, w), dtype=mask.dtype)
    for i in range(k):
        for j in range(k):
            if mask[i, j] != 0:
                acc += mask[i, j] * padded[i:i + h, j:j + w]
    if clamp:
        acc = np.clip(acc, 0, 255)
    yy, xx = np.nonzero(present)
    core = ((yy + y0 >= lo_core) & (yy + y0 <= hi_core)
            & (xx + x0 >= lo_col) & (xx + x0 <= hi_col))
    yy, xx = yy[core], xx[core]
    return (np.full(len(yy), image_id), (yy + y0).astype(np.int32),
            (xx + x0).astype(np.int32), acc[yy, xx])


def _tile_fn(mask, band_rows: int, border: str, clamp: bool, out: str, integer: bool):
    m = np.asarray(mask, dtype=np.int64 if integer else np.float64)
    tile_cols = TILE_COLS

    def bands_of(pdf: pd.DataFrame):
        img = pdf["image_id"].to_numpy()
        band, tile = pdf["band"].to_numpy(), pdf["tile"].to_numpy()
        cut = np.flatnonzero((img[1:] != img[:-1]) | (band[1:] != band[:-1])
                             | (tile[1:] != tile[:-1])) + 1
        starts = np.concatenate(([0], cut))
        ends = np.concatenate((cut, [len(pdf)]))
        ys = pdf["y"].to_numpy(np.int64)
        xs = pdf["x"].to_numpy(np.int64)
        vs = pdf["v"].to_numpy(m.dtype)
        parts = [_band_result(m, int(band[a]), int(tile[a]), img[a], ys[a:b], xs[a:b], vs[a:b],
                              band_rows, tile_cols, border, clamp) for a, b in zip(starts, ends)]
        if not parts:
            return None
        cols = [np.concatenate(c) for c in zip(*parts)]
        return pd.DataFrame({"image_id": cols[0], "y": cols[1], "x": cols[2], out: cols[3]})

    def run(batches):
        # Rows arrive sorted by (image_id, band, tile); a tile may continue over
        # several Arrow batches.  The pieces of the open tile are kept in a
        # list and joined once when it is complete (no repeated copies).
        pending: list[pd.DataFrame] = []
        open_key = None
        for pdf in batches:
            if not len(pdf):
                continue
            img = pdf["image_id"].to_numpy()
            band, tile = pdf["band"].to_numpy(), pdf["tile"].to_numpy()
            if open_key is not None:
                same = (img == open_key[0]) & (band == open_key[1]) & (tile == open_key[2])
                n_same = len(pdf) if same.all() else int(np.argmin(same))
                if n_same:
                    pending.append(pdf.iloc[:n_same])
                if n_same == len(pdf):
                    continue
                res = bands_of(pd.concat(pending, ignore_index=True))
                if res is not None:
                    yield res
                pending = []
                pdf = pdf.iloc[n_same:].reset_index(drop=True)
                img, band, tile = img[n_same:], band[n_same:], tile[n_same:]
            last = (img == img[-1]) & (band == band[-1]) & (tile == tile[-1])
            open_key = (img[-1], band[-1], tile[-1])
            if (~last).any():
                res = bands_of(pdf[~last].reset_index(drop=True))
                if res is not None:
                    yield res
            pending = [pdf[last]]
        if pending:
            res = bands_of(pd.concat(pending, ignore_index=True))
            if res is not None:
                yield res

    return run


def tiled(df: DataFrame, mask, value: str = "gray", border: str = "zero",
          clamp: bool = True, band_rows: int = 64, out: str | None = None) -> DataFrame:
    """Cross-correlate with an odd k x k mask, one NumPy tile at a time.

    Tiles of ``band_rows`` x ``TILE_COLS`` pixels (with halos) are
    hash-partitioned by ``(image_id, band, tile)`` and sorted inside each
    partition; ``mapInPandas`` then walks the sorted rows and processes every
    tile as a dense array, so memory depends on neither height nor width.  ``border="zero"``: neighbours
    outside the image (or absent) count as 0, exactly like :func:`convolve`.
    ``"reflect101"`` mirrors at image edges and assumes rectangular images.
    """
    k = _check_mask(mask)
    if border not in BORDERS:
        raise ValueError(f"border must be one of {BORDERS}")
    out = out or value
    integer = all(isinstance(w, (int, np.integer)) for row in mask for w in row)
    id_type = dict(df.dtypes).get("image_id", "int")
    out_type = "int" if integer and clamp else ("bigint" if integer else "double")
    schema = f"image_id {id_type}, y int, x int, {out} {out_type}"
    banded = (_banded(df, value, band_rows, k // 2)
              .repartition("image_id", "band", "tile")
              .sortWithinPartitions("image_id", "band", "tile"))
    res = banded.mapInPandas(_tile_fn(mask, band_rows, border, clamp, out, integer), schema)
    return res


def sobel_x(df: DataFrame, value: str = "gray", border: str = "zero",
            clamp: bool = True, method: str = "tiles", band_rows: int = 64,
            out: str | None = None) -> DataFrame:
    """Horizontal Sobel gradient, 8-bit saturated unless ``clamp=False``.

    ``border="zero"`` is the GPU kernels' rule, ``"reflect101"`` the
    library comparator's.  ``method`` is ``"tiles"`` (NumPy per band),
    ``"bands"`` (two windows over one shuffle) or ``"scatter"`` (zero border
    only).
    """
    if method == "tiles":
        return tiled(df, SOBEL_X, value=value, border=border, clamp=clamp,
                     band_rows=band_rows, out=out)
    if method == "scatter":
        if border != "zero":
            raise ValueError("scatter supports the zero border only")
        return convolve(df, SOBEL_X, value=value, clamp=clamp, out=out, method="scatter")
    if method != "bands":
        raise ValueError(f"unknown method {method!r}")
    return separable3(df, SOBEL_X_VERTICAL, SOBEL_X_HORIZONTAL, value=value,
                      border=border, clamp=clamp, band_rows=band_rows, out=out)
