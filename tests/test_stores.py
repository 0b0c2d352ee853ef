"""Raster files and appended logs: splits, odd files, commits that count once."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import tiles
from tessera.sources import appends, raster


def _write(path, head, grid):
    path.write_bytes(head + grid.astype(np.uint8).tobytes())


def _image(strips, image_id=None):
    rows = [r for r in strips.collect() if r.data is not None and image_id in (None, r.image_id)]
    rows.sort(key=lambda r: r.y0)
    return np.concatenate([np.frombuffer(r.data, np.uint8).reshape(r.h, r.w, r.channels) for r in rows])


@pytest.mark.parametrize("split", [1, 7, 100, 1 << 20])
def test_one_image_is_read_in_ranges(spark, tmp_path, split):
    grid = np.random.default_rng(1).integers(0, 256, (23, 11, 3))
    _write(tmp_path / "a.ppm", b"P6 # note\n11 23\n# more\n255\n", grid)
    strips = raster.read_raster(spark, str(tmp_path), split)
    assert (_image(strips) == grid).all()
    assert sum(r.h for r in strips.collect()) == 23    # no row twice
    if split == 100:
        assert strips.rdd.getNumPartitions() >= 7      # several tasks for one file


def test_layouts_rejects_and_pixels(spark, tmp_path):
    rng = np.random.default_rng(2)
    g, c, a = rng.integers(0, 256, (2, 3, 1)), rng.integers(0, 256, (2, 3, 3)), rng.integers(0, 256, (2, 3, 4))
    _write(tmp_path / "1.pgm", raster.header_bytes(1, 0, 2, 3, 1), g)
    _write(tmp_path / "2.ppm", raster.header_bytes(2, 0, 2, 3, 3), c)
    _write(tmp_path / "3.pam", raster.header_bytes(3, 0, 2, 3, 4), a)
    (tmp_path / "4.ppm").write_bytes(b"P6\n9 9\n255\nshort")
    (tmp_path / "5.ppm").write_bytes(b"P6\n1 1\n65535\n......")
    (tmp_path / "6.pgm").write_bytes(b"")
    (tmp_path / "7.pgm").write_bytes(b"P5 \xff what")
    (tmp_path / "_8.pgm").write_bytes(b"hidden")
    strips = raster.read_raster(spark, str(tmp_path))
    bad = {os.path.basename(r.path): r.reason for r in raster.raster_rejects(strips).collect()}
    assert bad == {"4.ppm": "truncated", "5.ppm": "unsupported layout", "6.pgm": "not a raster file",
                   "7.pgm": "bad header"}
    px = {(r.image_id, r.y, r.x): (r.r, r.g, r.b, r.a) for r in raster.raster_pixels(strips, "rgba").collect()}
    assert px[1, 1, 2] == (g[1, 2, 0],) * 3 + (255,) and px[2, 0, 1] == (*c[0, 1], 255)
    assert px[3, 1, 0] == tuple(a[1, 0]) and len(px) == 18
    gray = {(r.image_id, r.y, r.x): r.gray for r in raster.raster_pixels(strips, "gray").collect()}
    assert gray[2, 0, 0] == round(c[0, 0] @ [0.299, 0.587, 0.114])


def test_strips_and_tiles_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tiles, "BAND_ROWS", 4)
    monkeypatch.setattr(tiles, "TILE_COLS", 5)
    monkeypatch.setattr(raster, "STRIP_BYTES", 60)
    grid = np.random.default_rng(3).integers(0, 256, (9, 12, 3))
    _write(tmp_path / "x.ppm", raster.header_bytes(5, 0, 9, 12, 3), grid)
    packed = raster.strips_to_tiles(raster.read_raster(spark, str(tmp_path), 50), 3)
    assert packed.count() == 9
    out = str(tmp_path / "out")
    raster.write_raster(raster.tiles_to_strips(packed), out)
    assert len(os.listdir(out)) == 3                   # one per band, nothing staged
    assert (_image(raster.read_raster(spark, out)) == grid).all()
    raster.write_raster(raster.tiles_to_strips(packed).where("y0 = 0"), out, mode="overwrite")
    assert _image(raster.read_raster(spark, out)).shape == (4, 12, 3)


def test_failed_writes_leave_nothing(spark, tmp_path):
    boom = F.when(F.col("id") == 19, F.raise_error(F.lit("boom"))).otherwise(F.col("id"))
    rows = spark.range(20).repartition(4).select(boom.cast("long").alias("image_id"), F.lit(0).alias("y0"),
                                                 F.lit(1).alias("h"), F.lit(1).alias("w"),
                                                 F.lit(1).alias("channels"), F.lit(b"x").alias("data"))
    with pytest.raises(Exception, match="boom"):
        raster.write_raster(rows, str(tmp_path / "r"))
    with pytest.raises(Exception, match="boom"):
        appends.append_once(rows, str(tmp_path / "a"), "one")
    left = [f for d in ("r", "a") for _, _, names in os.walk(tmp_path / d) for f in names]
    assert left == []
    assert appends.read_appended(spark, str(tmp_path / "a"), rows.schema).collect() == []


def test_a_batch_counts_once(spark, tmp_path):
    log, df = str(tmp_path / "log"), spark.range(10).repartition(3)
    for batch, part in (("a/1", "id < 6"), ("a/1", "id < 6"), ("b", "id >= 6"), ("a/1", "id >= 0"),
                        ("none", "id < 0")):
        appends.append_once(df.where(part), log, batch)
    assert sorted(r.id for r in appends.read_appended(spark, log).collect()) == list(range(10))
    assert sorted(os.listdir(tmp_path / "log" / "_commits")) == ["a%2F1.json", "b.json", "none.json"]
    files = sum(len(n) for d, _, n in os.walk(log) if "_commits" not in d)
    assert files == len(appends.committed_files(log))  # a skipped batch leaves no file
    with pytest.raises(Exception, match="only appends"):
        df.write.format("append_once").mode("overwrite").option("batch", "c").save(log)
    with pytest.raises(Exception, match="batch is missing"):
        df.write.format("append_once").mode("append").save(log)


def test_two_runs_of_a_batch_commit_once(tmp_path):
    a, b = (appends.OnceWriter(str(tmp_path), "x") for _ in range(2))
    import pyarrow as pa
    done = [w.write(iter([pa.RecordBatch.from_pydict({"v": [i]})])) for i, w in enumerate((a, b))]
    b.commit([done[1]])
    a.commit([done[0]])
    assert [f["file"].split("/")[0] for f in appends.committed_files(str(tmp_path))] == [b.folder]
    assert not os.path.exists(tmp_path / a.folder)
