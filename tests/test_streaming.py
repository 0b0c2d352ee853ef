"""Streaming running statistics over appended timing logs."""

import os
import tempfile

import pytest

from tessera.streaming.timings import start_running_stats


def _write(folder, name, lines):
    tmp = os.path.join(folder, "." + name)
    with open(tmp, "w") as f:
        f.write("".join(lines))
    os.replace(tmp, os.path.join(folder, name))


def test_running_stats_fold_in_new_files(spark):
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    out = tempfile.mkdtemp(prefix="tessera-stream-out-")
    _write(src, "crash.jpgCMTimes", ["2.0, 0.5\n", "4.0, 0.5\n"])
    q = start_running_stats(spark, src, "timing_stats", checkpoint=os.path.join(out, "ckpt"),
                            to_table=True)
    try:
        q.processAllAvailable()
        r = spark.sql("select * from timing_stats").collect()
        assert len(r) == 1 and r[0]["n_runs"] == 2 and r[0]["mean_cpu"] == 3.0
        assert r[0]["speedup"] == pytest.approx(6.0)
        _write(src, "moon.jpgCMTimes", ["6.0, 1.0\n"])
        _write(src, "crash.jpgCM2Times", ["1.0, 1.0\n"])
        q.processAllAvailable()
        rows = {(x["workload"], x["variant"]): x for x in
                spark.sql("select * from timing_stats").collect()}
        assert rows[("crash.jpg", "CM")]["n_runs"] == 2
        assert rows[("moon.jpg", "CM")]["mean_gpu"] == 1.0
        assert rows[("crash.jpg", "CM2")]["n_runs"] == 1
    finally:
        q.stop()


def test_snapshot_sink_survives_restart(spark):
    src = tempfile.mkdtemp(prefix="tessera-stream-src-")
    out = tempfile.mkdtemp(prefix="tessera-stream-out-")
    ckpt = os.path.join(out, "ckpt")
    snap = os.path.join(out, "snap")
    _write(src, "TimesMult.txt128", ["0.0001 0.008 80\n", "0.0001 0.008 80\n"])
    q = start_running_stats(spark, src, snap, checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    _write(src, "TimesMult.txt512", ["0.002 0.5 250\n"])
    q = start_running_stats(spark, src, snap, checkpoint=ckpt, available_now=True)
    q.awaitTermination()
    got = {r["workload"]: r["n_runs"] for r in spark.read.parquet(snap).collect()}
    assert got == {"128": 2, "512": 1}


def test_tonemap_stream_matches_batch(spark):
    from conftest import SF01
    from tessera.operators import tone
    from tessera.sources import tables as tb
    from tessera.streaming.tonemap import start_tonemap_stream

    src = tempfile.mkdtemp(prefix="tessera-hdr-src-")
    out = tempfile.mkdtemp(prefix="tessera-hdr-out-")
    hdr = tb.hdr(spark, SF01).selectExpr("cast(image_id as long) image_id", "y", "x", "b", "g", "r")
    # One image per file; two images first, three later.
    for i in (0, 1):
        hdr.where(f"image_id = {i}").coalesce(1).write.parquet(f"{src}/img{i}")
    q = start_tonemap_stream(spark, f"{src}/*", out, "L", 0.4, 1.2,
                             checkpoint=f"{out}/_ckpt", available_now=True)
    q.awaitTermination()
    for i in (2, 3, 4):
        hdr.where(f"image_id = {i}").coalesce(1).write.parquet(f"{src}/img{i}")
    q = start_tonemap_stream(spark, f"{src}/*", out, "L", 0.4, 1.2,
                             checkpoint=f"{out}/_ckpt", available_now=True)
    q.awaitTermination()
    got = spark.read.parquet(f"{out}/batch_id=*").select("image_id", "y", "x", "b", "g", "r")
    want = tone.tone_log(hdr, 0.4, 1.2)
    assert got.count() == 10000
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        start_tonemap_stream(spark, src, out, "Q", 1.0, 1.0, checkpoint=f"{out}/_ckpt")
