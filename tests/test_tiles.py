"""Packed tiles: round trips, stencils against NumPy and the pixel-row operators, plans."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF01
from tessera.operators import pixels as pxo
from tessera.operators import stencil, tiles
from tessera.sources import tables as tb


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(tiles, "BAND_ROWS", 7)
    monkeypatch.setattr(tiles, "TILE_COLS", 9)


def _pixels(spark, images, kind="int"):
    rows = [(i, y, x, g[y, x].item()) for i, g in images.items()
            for y in range(g.shape[0]) for x in range(g.shape[1])]
    return spark.createDataFrame(rows, f"image_id long, y int, x int, gray {kind}")


def _grids(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.image_id, {})[(r.y, r.x)] = r[3]
    return out


def _want(g, mask, border, clamp=True):
    m = np.asarray(mask)
    r = len(m) // 2
    p = np.pad(g, r)
    if border == "reflect101":
        p = g
        for axis in (0, 1):
            wide = [(0, 0), (0, 0)]
            wide[axis] = (r, r)
            p = np.pad(p, wide, mode="reflect" if g.shape[axis] > 1 else "edge")
    acc = sum(m[i, j] * p[i:i + g.shape[0], j:j + g.shape[1]] for i in range(len(m)) for j in range(len(m)))
    return np.clip(acc, 0, 255) if clamp else acc


MASKS = [stencil.SOBEL_X, ((1, 0, 0, 0, -1), (2, 1, 0, -1, -2), (3, 2, 1, -2, -3), (2, 1, 0, -1, -2),
                           (0, 0, 1, 0, 0)), ((3,),), tuple((1,) * 7 for _ in range(7))]


@pytest.mark.parametrize("border", ["zero", "reflect101"])
def test_stencils_equal_numpy(spark, small, border):
    rng = np.random.default_rng(5)
    images = {i: rng.integers(0, 256, s) for i, s in enumerate(
        [(1, 1), (7, 9), (8, 10), (15, 28), (40, 3), (2, 40), (14, 18)])}
    packed = tiles.pack(_pixels(spark, images).repartition(5), "gray", "uint8")
    for mask in MASKS:
        for clamp in (True, False):
            got = _grids(tiles.unpack(tiles.convolve(packed, mask, border, clamp), types=("bigint",)))
            for i, g in images.items():
                want = _want(g, mask, border, clamp)
                assert got[i] == {(y, x): int(v) for (y, x), v in np.ndenumerate(want)}, (i, mask, clamp)


def test_round_trip_of_holes_channels_and_types(spark, small):
    rows = [(i, y, x, y * 0.5, None if (x + y) % 5 == 0 else float("nan") if x == 3 else x * 0.25)
            for i in ("a", "b") for y in range(9) for x in range(12) if (y * 7 + x) % 3]
    df = spark.createDataFrame(rows, "image_id string, y int, x int, u double, v double")
    back = tiles.unpack(tiles.pack(df, ("u", "v")), ("u", "v"), ("double", "double"))
    key = lambda r: tuple(str(c) for c in r)
    assert sorted(map(key, back.collect())) == sorted(key(r) for r in rows if r[4] is not None)


def test_repeated_rows_empty_tables_and_samples_that_do_not_fit(spark, small):
    df = spark.createDataFrame([(1, 0, 0, 5), (1, 0, 0, 5), (1, 0, 1, 300)],
                               "image_id long, y int, x int, gray int")
    assert tiles.unpack(tiles.pack(df)).count() == 2
    with pytest.raises(Exception, match="do not fit"):
        tiles.pack(df, "gray", "uint8").collect()
    none = tiles.pack(df.where("gray < 0"))
    assert tiles.sobel_x(none).collect() == []


def test_holes_count_as_zero(spark, small):
    df = spark.createDataFrame([(1, 0, 0, 10), (1, 0, 2, 30), (1, 1, 1, 9)], "image_id long, y int, x int, gray int")
    a = sorted(map(tuple, tiles.unpack(tiles.sobel_x(tiles.pack(df), clamp=False), types=("bigint",)).collect()))
    b = sorted(map(tuple, stencil.sobel_x(df, clamp=False).collect()))
    assert a == b


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4), st.data())
def test_factors_are_exact(half, data):
    k = 2 * half + 1
    rank = data.draw(st.integers(0, 2))
    vec = st.lists(st.integers(-6, 6), min_size=k, max_size=k)
    m = np.zeros((k, k), int)
    for _ in range(rank):
        m += np.outer(data.draw(vec), data.draw(vec))
    parts, divisor = tiles.factors(m.tolist())
    assert len(parts) <= rank
    assert (sum((np.outer(c, r) for c, r in parts), np.zeros((k, k), int)) == divisor * m).all()


def test_large_masks_take_work_in_proportion_to_their_width():
    box = np.ones((31, 31), int)
    ramp = np.add.outer(np.arange(31), np.arange(31))     # rank two
    assert sum(np.count_nonzero(c) + np.count_nonzero(r) for c, r in tiles._plan(box)[0]) == 62
    assert len(tiles._plan(ramp)[0]) == 2
    assert tiles._plan(np.eye(5, dtype=int)) is None       # full rank: weight by weight


def test_stencil_on_packed_tiles_moves_no_pixels(spark, tmp_path):
    px = pxo.gray(tb.pixels8(spark, SF01))
    tiles.pack(px, "gray", "uint8").write.parquet(str(tmp_path / "t"))
    packed = spark.read.parquet(str(tmp_path / "t"))
    text = tiles.sobel_x(packed)._jdf.queryExecution().executedPlan().toString()
    assert " y#" not in text and " x#" not in text    # no row is a pixel
    assert all("band#" in line for line in text.splitlines() if "hashpartitioning" in line)
    assert "MapInPandas" not in text
    a = tiles.unpack(tiles.sobel_x(packed)).withColumn("image_id", F.col("image_id").cast("int"))
    assert a.exceptAll(stencil.sobel_x(px)).count() == 0 and a.count() == px.count()


def test_gray_of_packed_colour(spark):
    px = tb.pixels8(spark, SF01)
    got = tiles.unpack(tiles.gray(tiles.pack(px, ("b", "g", "r"), "uint8")))
    assert got.exceptAll(pxo.gray(px)).count() == 0 and got.count() == px.count()
