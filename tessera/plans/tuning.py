"""Session settings for large inputs.

Adaptive execution can merge small shuffle partitions and split skewed ones,
but it cannot split a partition that is simply too big: the initial number of
shuffle partitions must be sized from the input.  These settings follow the
usual rule of ~128 MiB per shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

MIB = 1 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
TEXT_BATCH_BYTES = 4 * MIB


def scale_conf(input_bytes: int, partition_bytes: int = 128 * MIB) -> dict[str, str]:
    """Settings for a job reading ``input_bytes`` of parquet."""
    if input_bytes < 0 or partition_bytes <= 0:
        raise ValueError("sizes must be positive")
    parts = max(200, int(input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        # Arrow batches handed to Python (matrix blocks, image strips) are
        # bounded by bytes as well as by records.
        BATCH_KEY: str(64 * MIB),
    }


def apply_scale_conf(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    conf = scale_conf(input_bytes)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def bound_text_batches(spark: SparkSession, limit: int = TEXT_BATCH_BYTES) -> str:
    """Bound the Arrow batches that Python tasks of this session get by bytes,
    unless the session names a bound.  Spark's own is 10,000 rows, whatever they
    hold: whole texts make batches of 20 MB and more, which the executor keeps
    several times off its heap and the Python worker twice.  No result depends
    on it.  Returns the bound in force.

    A plan reads the setting when it runs, so it stays set.
    """
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, str(limit))
    return spark.conf.get(BATCH_KEY)
