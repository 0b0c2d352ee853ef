"""Pixel, stencil and tone operators: NumPy references and metamorphic checks."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF001, SF01
from tessera.functions import pixel as px
from tessera.operators import pixels as pxo
from tessera.operators import stencil, tone
from tessera.sources import tables as tb


def _gray_df(spark, img, image_id=0):
    h, w = img.shape
    rows = [(image_id, y, x, int(img[y, x])) for y in range(h) for x in range(w)]
    return spark.createDataFrame(rows, "image_id int, y int, x int, gray int")


def _to_array(df, h, w, col="gray", image_id=0):
    out = np.full((h, w), -999, dtype=np.int64)
    for r in df.where(f"image_id = {image_id}").collect():
        out[r["y"], r["x"]] = r[col]
    return out


def _np_correlate(img, mask, border):
    k = len(mask)
    r = k // 2
    mode = "constant" if border == "zero" else "reflect"
    pad = np.pad(img.astype(np.int64), r, mode=mode)
    h, w = img.shape
    out = np.zeros((h, w), dtype=np.int64)
    for i in range(k):
        for j in range(k):
            out += mask[i][j] * pad[i:i + h, j:j + w]
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(h=st.integers(1, 9), w=st.integers(1, 9), band=st.integers(1, 4), seed=st.integers(0, 99))
def test_sobel_matches_numpy(spark, h, w, band, seed):
    img = np.random.default_rng(seed).integers(0, 256, size=(h, w))
    df = _gray_df(spark, img)
    want = np.clip(_np_correlate(img, stencil.SOBEL_X, "zero"), 0, 255)
    got = _to_array(stencil.sobel_x(df, band_rows=band), h, w)
    np.testing.assert_array_equal(got, want)
    np.testing.assert_array_equal(_to_array(stencil.sobel_x(df, method="scatter"), h, w), want)
    np.testing.assert_array_equal(
        _to_array(stencil.sobel_x(df, method="bands", band_rows=band), h, w), want)
    if h >= 2 and w >= 2:
        want_r = np.clip(_np_correlate(img, stencil.SOBEL_X, "reflect101"), 0, 255)
        for method in ("tiles", "bands"):
            got_r = _to_array(stencil.sobel_x(df, border="reflect101", band_rows=band,
                                              method=method), h, w)
            np.testing.assert_array_equal(got_r, want_r)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(h=st.integers(1, 8), w=st.integers(1, 8), seed=st.integers(0, 99))
def test_convolve_5x5_matches_numpy(spark, h, w, seed):
    rng = np.random.default_rng(seed)
    img = rng.integers(0, 256, size=(h, w))
    mask = rng.integers(-3, 4, size=(5, 5)).tolist()
    df = _gray_df(spark, img)
    want = _np_correlate(img, mask, "zero")
    np.testing.assert_array_equal(
        _to_array(stencil.convolve(df, mask, clamp=False, method="scatter"), h, w), want)
    got_t = _to_array(stencil.tiled(df, mask, clamp=False, band_rows=3), h, w)
    np.testing.assert_array_equal(got_t, want)


def test_sobel_strategies_agree_and_interior_borders_agree(spark):
    g = pxo.gray(tb.pixels8(spark, SF01))
    bands = stencil.sobel_x(g, method="bands")
    scatter = stencil.sobel_x(g, method="scatter")
    tiles = stencil.sobel_x(g)
    assert bands.exceptAll(scatter).count() == 0 and scatter.exceptAll(bands).count() == 0
    assert tiles.exceptAll(bands).count() == 0 and bands.exceptAll(tiles).count() == 0
    refl = stencil.sobel_x(g, border="reflect101")
    interior = "y > 0 and y < 39 and x > 0 and x < 49"
    assert bands.where(interior).exceptAll(refl.where(interior)).count() == 0
    for method in ("tiles", "scatter"):
        conv = stencil.convolve(g, stencil.SOBEL_X, method=method)
        assert conv.exceptAll(bands).count() == 0


def test_exposure_identity_and_saturation(spark):
    p = tb.pixels8(spark, SF001)
    assert pxo.exposure(p, 1.0, 0.0).exceptAll(p).count() == 0
    hi = pxo.exposure(p, 1e9, 1e9).select("b", "g", "r").distinct().collect()
    assert [tuple(r) for r in hi] == [(255, 255, 255)] or all(max(r) == 255 for r in hi)
    br = pxo.exposure_bracket(p)
    assert br.count() == 4 * p.count()
    one = br.where("exposure_id = 0").drop("exposure_id")
    assert one.exceptAll(pxo.exposure(p, 1.0, 25.0)).count() == 0


def test_channel_split_merge_and_strip_round_trip(spark):
    p = tb.pixels8(spark, SF001)
    merged = pxo.channel_merge(pxo.channel_split(p))
    assert merged.exceptAll(p).count() == 0 and p.exceptAll(merged).count() == 0
    back = pxo.explode_rows(pxo.assemble_rows(p))
    assert back.exceptAll(p).count() == 0 and p.exceptAll(back).count() == 0


def test_image_type_names(spark):
    depth = ["8U", "8S", "16U", "16S", "32S", "32F", "64F", "User"]
    got = {r["id"]: r["t"] for r in spark.range(32).select(
        "id", px.image_type_name("id").alias("t")).collect()}
    assert got == {c: f"{depth[c & 7]}C{1 + (c >> 3)}" for c in range(32)}


def test_quantise_undefined_and_saturation(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (-1.0,), (2.0,), (0.5,), (1.5 / 255,)],
                               "v double")
    got = [r[0] for r in df.select(px.quantise8("v")).collect()]
    assert got == [0, 0, 0, 255, 128, 2]


def test_tonemap_dispatch_and_parameter_checks(spark):
    h = tb.hdr(spark, SF001)
    for mode in ("l", "L", "a", "A", "g", "G"):
        assert set(tone.tonemap(h, mode, 0.4, 1.2).columns) == {"image_id", "y", "x", "b", "g", "r"}
    with pytest.raises(ValueError):
        tone.tonemap(h, "x", 0.4, 1.2)
    with pytest.raises(ValueError):
        tone.tone_gamma(h, 1.0, 0.0)
    with pytest.raises(ValueError):
        tone.tone_adaptive(h, 0.0, 1.0)


def test_tone_log_matches_numpy(spark):
    h = tb.hdr(spark, SF001).toPandas()
    m = max(0.0, h[["b", "g", "r"]].to_numpy().max())
    got = tone.tone_log(tb.hdr(spark, SF001), 0.4, 1.2).toPandas().sort_values(["y", "x"])
    want = np.log10(1 + 0.4 * h.sort_values(["y", "x"])["g"].to_numpy()) / math.log10(1 + 1.2 * m)
    np.testing.assert_allclose(got["g"].to_numpy(), want, rtol=1e-12)


def test_histogram_and_cdf_properties(spark):
    hdr = tb.hdr(spark, SF01)
    hist = tone.lum_histogram(hdr)
    per_image = {r["image_id"]: r["s"] for r in hist.groupBy("image_id").agg({"n": "sum"})
                 .withColumnRenamed("sum(n)", "s").collect()}
    assert per_image == {i: 2000 for i in range(5)}
    cdf = tone.lum_cdf(hist).toPandas().sort_values(["image_id", "bin"])
    for _, g in cdf.groupby("image_id"):
        assert (np.diff(g["cdf"].to_numpy()) > 0).all()
        assert g["cdf_norm"].iloc[-1] == 1.0
    exc = tone.lum_cdf(hist, exclusive=True).toPandas()
    assert (exc["cdf_norm"] <= 1.0).all() and (exc["cdf_norm"] >= 0.0).all()


def test_splitting_corpus_by_image_changes_nothing(spark):
    hdr = tb.hdr(spark, SF01)
    whole = tone.histeq_tonemap(hdr)
    parts = None
    for i in (0, 1, 2, 3, 4):
        one = tone.histeq_tonemap(hdr.where(f"image_id = {i}"))
        parts = one if parts is None else parts.unionByName(one)
    assert whole.exceptAll(parts).count() == 0 and parts.exceptAll(whole).count() == 0


def test_black_pixels_are_null_then_zero(spark):
    hdr = tb.hdr(spark, SF01)
    out = tone.histeq_tonemap(hdr).where("image_id = 0 and y = 0 and x = 0").collect()[0]
    assert out["r"] is None and out["g"] is None and out["b"] is None


def test_tiles_with_bands_spanning_many_arrow_batches(spark):
    from pyspark.sql import functions as F

    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        px_ = spark.range(3 * 130 * 90).select(
            (F.col("id") / (130 * 90)).cast("int").alias("image_id"),
            ((F.col("id") % (130 * 90)) / 90).cast("int").alias("y"),
            (F.col("id") % 90).cast("int").alias("x"),
            F.pmod(F.xxhash64("id"), F.lit(256)).cast("int").alias("gray"))
        for border in ("zero", "reflect101"):
            a = stencil.sobel_x(px_, border=border, method="tiles")
            b = stencil.sobel_x(px_, border=border, method="bands")
            assert a.count() == 3 * 130 * 90
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


@pytest.mark.parametrize("cols", [2048, 4])
def test_reflect101_of_any_radius_around_tile_edges(spark, monkeypatch, cols):
    """Against NumPy's mirror padding, for heights around a band's edge, with
    one tile across and with narrow tiles."""
    monkeypatch.setattr(stencil, "TILE_COLS", cols)
    rng = np.random.default_rng(4)
    for radius in (1, 2, 3):
        mask = rng.integers(-3, 4, (2 * radius + 1, 2 * radius + 1)).tolist()
        for h in (radius + 1, 7, 8, 9, 10, 15, 16, 17):
            img = rng.integers(0, 256, (h, 9))
            rows = [(0, y, x, int(img[y, x])) for y in range(h) for x in range(9)]
            df = spark.createDataFrame(rows, "image_id int, y int, x int, gray int")
            got = np.zeros((h, 9), int)
            for r in stencil.tiled(df, mask, border="reflect101", clamp=False, band_rows=8).collect():
                got[r["y"], r["x"]] = r["gray"]
            pad = np.pad(img, radius, mode="reflect")
            want = sum(mask[i][j] * pad[i:i + h, j:j + 9]
                       for i in range(2 * radius + 1) for j in range(2 * radius + 1))
            np.testing.assert_array_equal(got, want)
