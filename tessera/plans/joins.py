"""Joining a small derived table back to a large one, with a checked size.

Per-image statistics (max sample, log-luminance range, CDF bins) have one row
per image (or per image and bin), so their size grows with the number of
images, not with pixels, but it is not bounded by a constant.  They are
materialised once in the session's checkpoint folder (lineage cut, survives
executor loss) and broadcast only when rows times width are under the broadcast
threshold.  Beyond it the join is a shuffle join on the key and a salt.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


def broadcast_threshold(spark) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")
    raw = str(raw).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
             "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


# Folders written by this process and not released yet, and tables on them.
_WRITTEN: list[str] = []
_TABLES: list[str] = []


def register_table(name: str) -> None:
    """Let :func:`release` drop the table ``name``."""
    _TABLES.append(name)


def release(spark) -> int:
    """Delete the tables that :func:`materialise` wrote so far.

    Call it when the results built on them have been written or collected: a
    DataFrame that still reads one of them fails afterwards.  Returns how many
    folders went.
    """
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS `{_TABLES.pop()}`")
    paths, _WRITTEN[:] = list(_WRITTEN), []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def scratch_path(spark, name: str) -> str:
    """A new path in the shared checkpoint folder, deleted by :func:`release`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialise(df: DataFrame, name: str = "derived") -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    return the re-read table.

    One job computes it (``Dataset.checkpoint`` would compute it twice) and
    the lineage is cut.  The re-read table's statistics are its exact file
    size, known without another job.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a result of :func:`materialise` that nothing reads any more."""
    spark = table.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders = {file.rsplit("/", 2)[-2] for file in table.inputFiles()}
    for path in [p for p in _WRITTEN if p.rsplit("/", 1)[-1] in folders]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
        _WRITTEN.remove(path)


# In-memory bytes assumed per field of a hashed row, and per row.
_FIELD_BYTES = 24
_ROW_BYTES = 48
# Copies of the small side in a shuffle join: a hot key spreads over as many tasks.
SALTS = 16


def size_in_bytes(df: DataFrame) -> int:
    """Rows times an assumed row width (compressed file size says little about
    the size in memory).  ``df`` is a written table of numbers, so the count
    comes from file metadata."""
    return df.count() * (_ROW_BYTES + _FIELD_BYTES * len(df.columns))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int | None = None, written: bool = False) -> DataFrame:
    """Join ``big`` with a derived ``small`` table of numbers.

    ``small`` is materialised (unless ``written``: it already is a plain
    parquet scan) and broadcast if its size in memory is under the broadcast
    threshold.  Otherwise both sides are shuffled by the key and a salt: a key
    that holds a large share of ``big`` is dealt over ``SALTS`` tasks, and no
    later aggregation can reuse a partitioning by the bare key.  The sort-merge
    hint keeps Spark from broadcasting the copies by their compressed file size.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if not written:
        small = materialise(small, "join-side")
    if broadcast_fits(big.sparkSession, size_in_bytes(small), max_bytes):
        return big.join(F.broadcast(small), on, how)
    keys = [on] if isinstance(on, str) else list(on)
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies.hint("merge"), [*keys, "__salt"], how).drop("__salt")


def broadcast_fits(spark, est_bytes: int, max_bytes: int | None = None) -> bool:
    """Whether a table of ``est_bytes`` (in memory) may be broadcast."""
    limit = broadcast_threshold(spark) if max_bytes is None else max_bytes
    return limit > 0 and est_bytes <= limit
