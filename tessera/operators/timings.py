"""Benchmark-timing analytics over ``(workload, variant, run_no, gpu, cpu)``.

Statistics cover every run.  ``first_runs=k`` restricts them to runs numbered
up to ``k`` (the published tables average the first 20 lines of logs that grew
later); ``number_runs`` numbers rows that have no ``run_no``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = ["workload", "variant"]

# Fixed value: runs averaged in the published tables.
REPORT_RUNS = 20


def number_runs(df: DataFrame, order: str, first_runs: int) -> DataFrame:
    """Keep the first ``first_runs`` runs of each group, numbered from 1 in ``order``.

    The bound is required: numbering every run would sort each whole group
    in one task.  Statistics over all runs need no numbering (pass the
    un-numbered rows with ``first_runs=None`` to the aggregates).
    """
    if first_runs is None or first_runs < 1:
        raise ValueError("first_runs must be a positive bound")
    w = Window.partitionBy(*GROUP).orderBy(order)
    return df.withColumn("run_no", F.row_number().over(w)).where(F.col("run_no") <= first_runs)


def _runs(df: DataFrame, first_runs: int | None) -> DataFrame:
    if first_runs is None:
        return df
    if "run_no" not in df.columns:
        raise ValueError("first_runs needs run numbers (see number_runs)")
    return df.where(F.col("run_no") <= first_runs)


def timing_mean(runs: DataFrame, first_runs: int | None = None) -> DataFrame:
    """Mean GPU and CPU time per workload and variant."""
    return _runs(runs, first_runs).groupBy(*GROUP).agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.avg("gpu").alias("mean_gpu"),
        F.avg("cpu").alias("mean_cpu"))


def timing_speedup(runs: DataFrame, first_runs: int | None = None) -> DataFrame:
    """Speedup as the mean of per-run ratios ``cpu / gpu`` (0 s runs skipped)."""
    ratio = F.col("cpu") / F.nullif(F.col("gpu"), F.lit(0.0))
    return _runs(runs, first_runs).groupBy(*GROUP).agg(F.avg(ratio).alias("speedup"))


def timing_variant_ratio(runs: DataFrame, base: str,
                         first_runs: int | None = None) -> DataFrame:
    """Ratio of means ``mean_gpu(base) / mean_gpu(variant)`` per workload; NULL
    for a workload without the base variant.

    Means are aggregated first (one row per workload and variant), so the
    self-join pairs tiny tables only.
    """
    means = timing_mean(runs, first_runs).select(*GROUP, "mean_gpu")
    b = means.where(F.col("variant") == base).select(
        "workload", F.col("mean_gpu").alias("base_gpu"))
    return (means.join(b, "workload", "left")
            .select("workload", "variant",
                    (F.col("base_gpu") / F.nullif(F.col("mean_gpu"), F.lit(0.0))).alias("ratio")))
