"""Image, HDR and timing-log sources; sinks round trips."""

import os
import struct
import tempfile
import zlib

import numpy as np
import pytest

from tessera.operators import pixels as pxo
from tessera.sources import hdr as hdrsrc
from tessera.sources import images as imgs
from tessera.sources import sinks
from tessera.sources.timing_logs import read_timing_logs


def _png(path, arr):
    """Minimal PNG encoder: 8-bit RGB (HxWx3) or gray (HxW), filter 0."""
    h, w = arr.shape[:2]
    color_type = 2 if arr.ndim == 3 else 0
    raw = b"".join(b"\x00" + arr[y].tobytes() for y in range(h))

    def chunk(tag, data):
        return (struct.pack(">I", len(data)) + tag + data
                + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF))

    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n"
                + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color_type, 0, 0, 0))
                + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


@pytest.fixture(scope="module")
def image_dir():
    d = tempfile.mkdtemp(prefix="tessera-img-")
    rng = np.random.default_rng(7)
    rgb = rng.integers(0, 256, size=(13, 37, 3), dtype=np.uint8)
    gray = rng.integers(0, 256, size=(5, 9), dtype=np.uint8)
    _png(os.path.join(d, "colour.png"), rgb)
    _png(os.path.join(d, "gray.png"), gray)
    with open(os.path.join(d, "junk.png"), "wb") as f:
        f.write(b"not an image at all")
    return d, rgb, gray


def test_image_scan_decodes_bgr(spark, image_dir):
    d, rgb, gray = image_dir
    images = imgs.read_images(spark, d)
    cat = {os.path.basename(r["origin"]): r for r in imgs.image_catalog(images).collect()}
    assert cat["colour.png"]["type_name"] == "8UC3"
    assert cat["gray.png"]["type_name"] == "8UC1"
    assert (cat["colour.png"]["height"], cat["colour.png"]["width"]) == (13, 37)
    px = imgs.image_pixels(images, "color").toPandas()
    col = px[px.image_id == cat["colour.png"]["image_id"]].sort_values(["y", "x"])
    assert len(col) == 13 * 37
    np.testing.assert_array_equal(col["r"].to_numpy().reshape(13, 37), rgb[:, :, 0])
    np.testing.assert_array_equal(col["g"].to_numpy().reshape(13, 37), rgb[:, :, 1])
    np.testing.assert_array_equal(col["b"].to_numpy().reshape(13, 37), rgb[:, :, 2])
    g = px[px.image_id == cat["gray.png"]["image_id"]].sort_values(["y", "x"])
    np.testing.assert_array_equal(g["b"].to_numpy().reshape(5, 9), gray)


def test_image_rejects_and_gray_read(spark, image_dir):
    d, rgb, gray = image_dir
    images = imgs.read_images(spark, d)
    assert imgs.image_id_collisions(images).count() == 0
    rej = imgs.image_rejects(images).collect()
    assert [os.path.basename(r["origin"]) for r in rej] == ["junk.png"]
    assert rej[0]["reason"] == "unreadable"
    gr = imgs.image_pixels(images, "gray").toPandas()
    cat = {os.path.basename(r["origin"]): r["image_id"] for r in images.collect()}
    one = gr[gr.image_id == cat["gray.png"]].sort_values(["y", "x"])
    np.testing.assert_array_equal(one["gray"].to_numpy().reshape(5, 9), gray)
    col = gr[gr.image_id == cat["colour.png"]].sort_values(["y", "x"])
    f = rgb[:, :, 0] * 0.299 + rgb[:, :, 1] * 0.587 + rgb[:, :, 2] * 0.114
    np.testing.assert_array_equal(col["gray"].to_numpy().reshape(13, 37), np.rint(f))


def test_rgba_round_trip(spark, image_dir):
    d, rgb, _ = image_dir
    images = imgs.read_images(spark, d)
    bgr = imgs.image_pixels(images, "color")
    rgba = pxo.to_rgba(bgr)
    assert set(r["a"] for r in rgba.select("a").distinct().collect()) == {255}
    back = pxo.from_rgba(rgba)
    assert back.exceptAll(bgr).count() == 0 and bgr.exceptAll(back).count() == 0


def test_hdr_samples_promote_and_reject(spark):
    rows = []
    # image 1: 3 channels; image 2: 1 channel (promoted); image 3: 2 channels (rejected)
    for x in range(4):
        rows += [(1, 0, x, c, float(10 * x + c)) for c in range(3)]
        rows += [(2, 0, x, 0, float(x))]
        rows += [(3, 0, x, c, 1.0) for c in range(2)]
    df = spark.createDataFrame(rows, "image_id long, y int, x int, channel int, value double")
    pixels, rejects = hdrsrc.hdr_from_samples(df)
    assert [r["image_id"] for r in rejects.collect()] == [3]
    got = {(r["image_id"], r["x"]): (r["b"], r["g"], r["r"]) for r in pixels.collect()}
    assert got[(1, 2)] == (20.0, 21.0, 22.0)
    assert got[(2, 3)] == (3.0, 3.0, 3.0)
    assert not any(k[0] == 3 for k in got)


def test_hdr_csv_scan_types(spark):
    d = tempfile.mkdtemp(prefix="tessera-hdr-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("image_id,y,x,b,g,r\n1,0,0,0.5,1,2\n1,0,1,3,4,5\n")
    df = hdrsrc.read_hdr(spark, d, fmt="csv")
    assert dict(df.dtypes)["b"] == "double"
    assert df.count() == 2


def test_timing_log_reader(spark):
    d = tempfile.mkdtemp(prefix="tessera-logs-")
    os.makedirs(os.path.join(d, "plain"))
    os.makedirs(os.path.join(d, "tiled"))
    # The first runs of the N=128 plain and tiled logs.
    plain = [0.000121, 0.000112, 0.00011, 0.000112, 0.000111, 0.00011, 0.000111, 0.00011,
             0.00011, 0.000109, 0.00011, 0.000111, 0.000111, 0.000111, 0.000112, 0.000111,
             0.000114, 0.000112, 0.000113, 0.000111]
    tiled = [8.9e-05, 8.5e-05, 8.2e-05, 8.2e-05, 8.1e-05, 8.2e-05, 8.1e-05, 8.2e-05, 8e-05,
             8.2e-05, 8.1e-05, 8.2e-05, 8.1e-05, 8.2e-05, 8.1e-05, 8.2e-05, 8.1e-05, 8.1e-05,
             8.2e-05, 8.2e-05, 8.9e-05, 9.1e-05, 9.2e-05, 8.9e-05]
    with open(os.path.join(d, "plain", "TimesMult.txt128"), "w") as f:
        f.writelines(f"{g} 0.0078 70.0\n" for g in plain)
    with open(os.path.join(d, "tiled", "TimesMult.txt128"), "w") as f:
        f.writelines(f"{g} 0.0078 95.0\n" for g in tiled)
    with open(os.path.join(d, "crash.jpgCMTimes"), "w") as f:
        f.write("11.514, 0.045952\n1.795, 0.045472\n")
    with open(os.path.join(d, "crash.jpgopencvCudaTimes"), "w") as f:
        f.write("0.65648\n0.3336\n")
    logs = read_timing_logs(spark, [os.path.join(d, p) for p in
                                    ("plain", "tiled", "crash.jpgCMTimes",
                                     "crash.jpgopencvCudaTimes")])
    from tessera.operators import timings as tm

    mm = logs.where("unit = 's'")
    ratio = {r["variant"]: r["ratio"] for r in tm.timing_variant_ratio(mm, "plain", first_runs=20).collect()}
    # Published ratio of means for N=128 (first 20 runs of each log).
    assert ratio["tiled"] == pytest.approx(1.360146252, rel=1e-8)
    cm = {(r["variant"], r["run_no"]): (r["gpu"], r["cpu"])
          for r in logs.where("workload = 'crash.jpg'").collect()}
    assert cm[("CM", 1)] == (0.045952, 11.514)
    assert cm[("opencvCuda", 2)] == (0.3336, None)


def test_write_pixels_round_trip(spark, tmp_path):
    from conftest import SF001
    from tessera.sources import tables as tb

    p = tb.pixels8(spark, SF001)
    out = str(tmp_path / "px")
    sinks.write_pixels(p, out)
    back = spark.read.parquet(out)
    assert back.exceptAll(p).count() == 0 and p.exceptAll(back).count() == 0
    log = str(tmp_path / "log")
    row = spark.createDataFrame([("w", "v", 1, 0.1, 0.2)],
                                "workload string, variant string, run_no int, gpu double, cpu double")
    sinks.append_timings(row, log)
    sinks.append_timings(row, log)
    assert spark.read.parquet(log).count() == 2


def test_golden_gray_timing_report(spark):
    """Published gray timings for the 640x360 image: mean GPU 0.00016625 s,
    mean CPU 0.0007245 s, speedup (mean of per-run ratios) 4.2346495."""
    from tessera.operators import timings as tm

    d = tempfile.mkdtemp(prefix="tessera-gray-")
    # The 20 recorded runs (gpu s, cpu s, ratio).
    runs = [
        (0.000234, 0.002419, 10.3376), (0.000186, 0.000545, 2.93011),
        (0.000162, 0.000512, 3.16049), (0.000164, 0.000628, 3.82927),
        (0.000162, 0.000648, 4), (0.000162, 0.000661, 4.08025),
        (0.000162, 0.000665, 4.10494), (0.000162, 0.000613, 3.78395),
        (0.000161, 0.000661, 4.10559), (0.00016, 0.000681, 4.25625),
        (0.00016, 0.000602, 3.7625), (0.000161, 0.000603, 3.74534),
        (0.000161, 0.0007, 4.34783), (0.000161, 0.000634, 3.93789),
        (0.00016, 0.000636, 3.975), (0.000162, 0.000643, 3.96914),
        (0.000161, 0.000671, 4.1677), (0.000162, 0.000638, 3.93827),
        (0.000161, 0.000703, 4.36646), (0.000161, 0.000627, 3.89441),
    ]
    with open(os.path.join(d, "crash.jpgTimes"), "w") as f:
        f.writelines(f"{g} {c} {q}\n" for g, c, q in runs)
    logs = read_timing_logs(spark, d)
    m = tm.timing_mean(logs).collect()[0]
    assert (m["workload"], m["variant"], m["n_runs"]) == ("crash.jpg", "", 20)
    assert m["mean_gpu"] == pytest.approx(0.00016625, rel=1e-12)
    assert m["mean_cpu"] == pytest.approx(0.0007245, rel=1e-12)
    sp = tm.timing_speedup(logs).collect()[0]["speedup"]
    assert sp == pytest.approx(4.2346495, rel=1e-7)
