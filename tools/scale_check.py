"""Throughput of the heavy operators on a replicated corpus.

Usage: python tools/scale_check.py SCRATCH_DIR [REPLICAS] [SF_DIR]

Builds, once, a corpus of REPLICAS copies of the fixture images (each copy
with its own image ids) as 16 parquet files under SCRATCH_DIR, then times
each operator on it with the noop sink and prints rows per second as JSON.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import pixels as pxo  # noqa: E402
from tessera.operators import stencil, tone  # noqa: E402
from tessera.session import local_session  # noqa: E402
from tessera.sources import tables as tb  # noqa: E402


def replicate(df, k: int, n_images: int):
    rep = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("copy")
    return (df.select("*", rep)
            .withColumn("image_id", F.col("image_id") + F.col("copy") * n_images)
            .drop("copy"))


def main() -> None:
    scratch = sys.argv[1]
    k = int(sys.argv[2]) if len(sys.argv) > 2 else 50
    sf_dir = sys.argv[3] if len(sys.argv) > 3 else "/root/testdata/sf0.1"
    spark = local_session(cores=8, shuffle_partitions=16)
    n_images = tb.pixels8(spark, sf_dir).select(F.max("image_id")).first()[0] + 1
    paths = {}
    for name, build in (("pixels8", tb.pixels8), ("hdr", tb.hdr)):
        path = f"{scratch}/{name}_x{k}"
        if not os.path.exists(path):
            replicate(build(spark, sf_dir), k, n_images).repartition(16).write.parquet(path)
        paths[name] = path
    pix = spark.read.parquet(paths["pixels8"])
    hdr = spark.read.parquet(paths["hdr"])
    n = pix.count()
    gray = pxo.gray(pix)
    ops = {
        "gray": lambda: gray,
        "sobel_tiles": lambda: stencil.sobel_x(gray),
        "sobel_bands": lambda: stencil.sobel_x(gray, method="bands"),
        "sobel_scatter": lambda: stencil.sobel_x(gray, method="scatter"),
        "convolve_5x5_tiles": lambda: stencil.tiled(gray, [[1] * 5] * 5),
        "convolve_5x5_scatter": lambda: stencil.convolve(gray, [[1] * 5] * 5, method="scatter"),
        "tone_log": lambda: tone.tone_log(hdr, 0.4, 1.2),
        "histeq_tonemap": lambda: tone.histeq_tonemap(hdr),
    }
    out = {"rows": n, "replicas": k}
    for name, build in ops.items():
        build().write.format("noop").mode("overwrite").save()  # warm-up
        t0 = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        out[name] = {"sec": round(dt, 3), "rows_per_sec": round(n / dt)}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
