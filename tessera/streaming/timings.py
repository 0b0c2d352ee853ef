"""Structured Streaming over timing logs that grow by appended runs.

New log files dropped into a folder are parsed as they arrive and fold into
running per-(workload, variant, unit) statistics.  The state is one small
aggregation buffer per group (count and sums), kept in the state store under
the session's shared checkpoint folder, so a restarted query resumes where it
stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.sources.timing_logs import parse_timing_lines


def read_timing_log_stream(spark: SparkSession, folder: str,
                           max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of parsed log lines from files arriving in ``folder``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(folder).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("name"))
    return parse_timing_lines(raw)


def running_timing_stats(lines: DataFrame) -> DataFrame:
    """Running count, mean times and mean per-run speedup per group."""
    ratio = F.col("cpu") / F.nullif(F.col("gpu"), F.lit(0.0))
    return lines.groupBy("workload", "variant", "unit").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.avg("gpu").alias("mean_gpu"),
        F.avg("cpu").alias("mean_cpu"),
        F.avg(ratio).alias("speedup"))


def start_running_stats(spark: SparkSession, folder: str, sink: str,
                        checkpoint: str, to_table: bool = False,
                        available_now: bool = False) -> StreamingQuery:
    """Start the running-statistics query.

    ``sink`` is a parquet folder rewritten with the latest snapshot after each
    micro-batch (``to_table=False``) or the name of an in-memory table (for
    tests and notebooks).  ``checkpoint`` is a folder on shared storage; the
    same folder makes a restart resume where the query stopped.
    """
    stats = running_timing_stats(read_timing_log_stream(spark, folder))
    writer = stats.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if to_table:
        return writer.format("memory").queryName(sink).start()

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    return writer.foreachBatch(snapshot).start()
