"""Incremental tone mapping of HDR pixel files as they arrive.

The batch tone map over a corpus (one parameter set, many images) runs on
each micro-batch of newly arrived parquet files through ``foreachBatch``.
Per-image statistics are computed inside the micro-batch, so every image
must arrive whole in one file set (one image per file, as an image writer
produces).  Output goes to ``<out>/batch_id=<n>``; a replayed micro-batch
overwrites its own folder, which makes the sink idempotent under retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import tone

HDR_SCHEMA = "image_id long, y int, x int, b double, g double, r double"


def start_tonemap_stream(spark: SparkSession, folder: str, out: str, mode: str,
                         p1: float, p2: float, checkpoint: str,
                         available_now: bool = False) -> StreamingQuery:
    """Tone-map HDR pixel files (``image_id, y, x, b, g, r``) arriving in ``folder``.

    ``checkpoint`` is a folder on shared storage; the same folder makes a
    restart resume.  A trigger takes all files that are there, so the files of
    an image that arrive together are never split over two batches.
    """
    m = (mode or "")[:1].upper()
    if m not in ("L", "A", "G"):
        raise ValueError(f"unknown tone-map mode {mode!r}; use L, G or A")
    stream = spark.readStream.schema(HDR_SCHEMA).parquet(folder)

    def process(batch: DataFrame, batch_id: int) -> None:
        result = tone.tonemap(batch, m, p1, p2)
        result.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}")

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(process)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
