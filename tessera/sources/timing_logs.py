"""Reader for plain-text timing logs.

A log holds one run per line, separated by spaces or commas, in one of three
layouts: ``gpu cpu ratio`` (seconds), ``cpu, gpu`` (milliseconds) or ``gpu``
(milliseconds).  The workload and variant are encoded in the file name:
``<image><variant>Times`` (variant may be empty) or ``TimesMult.txt<N>``,
whose variant is the name of the folder holding it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.plans.joins import join_small

# File-name patterns of the logs.
SOBEL_OR_GRAY_LOG = r"^(.*\.(?:jpg|png|jpeg))(.*)Times$"
MATMUL_LOG = r"^TimesMult\.txt(\d+)$"


def parse_timing_lines(raw: DataFrame) -> DataFrame:
    """Parse ``(line, file, name, ...)`` rows into timing columns.

    Works on batch and streaming DataFrames alike (no window, no state).
    Output ``(workload, variant, gpu, cpu, ratio, unit, file)`` followed by
    any other input columns, unchanged.  Malformed lines are left out here;
    :func:`rejected_lines` returns them.
    """
    return _parsed(raw).where("reason is null").drop("reason", "line")


def rejected_lines(raw: DataFrame) -> DataFrame:
    """``(file, line, reason)`` of the lines that are no timing row."""
    return _parsed(raw).where("reason is not null").select("file", "line", "reason")


def _parsed(raw: DataFrame) -> DataFrame:
    """All non-blank lines with their values and a ``reason`` if malformed."""
    raw = raw.where(F.trim("line") != "")
    parts = F.split(F.trim(F.regexp_replace("line", r"[,\s]+", " ")), " ")
    n = F.size(parts)
    num = lambda k: F.try_element_at(parts, F.lit(k)).try_cast("double")
    folder = F.element_at(F.split("file", "/"), -2)
    is_mm = F.regexp_extract("name", MATMUL_LOG, 1) != ""
    workload = F.when(is_mm, F.regexp_extract("name", MATMUL_LOG, 1)).otherwise(
        F.regexp_extract("name", SOBEL_OR_GRAY_LOG, 1))
    variant = F.when(is_mm, folder).otherwise(F.regexp_extract("name", SOBEL_OR_GRAY_LOG, 2))
    extra = [c for c in raw.columns if c not in ("line", "file", "name")]
    numbers = F.size(F.filter(parts, lambda p: p.try_cast("double").isNotNull()))
    reason = (F.when(~n.isin(1, 2, 3), F.lit("wrong number of fields"))
              .when(numbers != n, F.lit("not a number"))
              .when(workload == "", F.lit("unknown file name")))
    return raw.select(
        workload.alias("workload"), variant.alias("variant"),
        F.when(n == 2, num(2)).otherwise(num(1)).alias("gpu"),
        F.when(n == 3, num(2)).when(n == 2, num(1)).alias("cpu"),
        F.when(n == 3, num(3)).alias("ratio"),
        F.when(n == 3, F.lit("s")).otherwise(F.lit("ms")).alias("unit"),
        "file", "line", reason.alias("reason"), *extra)


def read_timing_logs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(workload, variant, run_no, gpu, cpu, ratio, unit, file)`` per log line.

    Seconds are kept as seconds and milliseconds as milliseconds; ``unit``
    says which.  ``run_no`` counts the non-blank lines of a file in order.  Lines
    are numbered inside each input split; the splits' first numbers come from
    one aggregation (a row per file and split), so a long log is never gathered.
    """
    raw = (spark.read.text(paths).where(F.trim("value") != "")
           .select(F.col("value").alias("line"),
                   F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_name").alias("name"),
                   F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("seq")))
    w = Window.partitionBy("file").orderBy("block")
    splits = raw.groupBy("file", "block").agg(
        F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    splits = splits.select("file", "block", (
        F.sum("n").over(w) - F.col("n") - F.col("first") + 1).alias("shift"))
    numbered = join_small(raw, splits, ["file", "block"])
    return parse_timing_lines(numbered).select(
        "workload", "variant", (F.col("seq") + F.col("shift")).cast("int").alias("run_no"),
        "gpu", "cpu", "ratio", "unit", "file")
