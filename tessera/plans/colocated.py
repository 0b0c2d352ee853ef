"""Tables that are written once by key and joined many times without a shuffle.

``bucketed`` writes a table in buckets by its keys.  Two tables with the same keys
and number of buckets are joined bucket by bucket: the plan has no Exchange,
and the shuffle is paid once, when a table is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.joins import materialise, register_table, scratch_path


def bucketed(df: DataFrame, keys, buckets: int | None = None, name: str = "bucketed") -> DataFrame:
    """``df`` as a table in ``buckets`` (default: shuffle partitions) buckets by
    ``keys``, sorted in each.  The table lives until ``joins.release``."""
    spark, keys = df.sparkSession, list(keys)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    # One task per bucket, so a bucket is one file.
    (df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))
    register_table(table)
    return spark.table(table)


def colocated_join(a: DataFrame, b: DataFrame, keys, how: str = "inner") -> DataFrame:
    """Join of two tables from :func:`bucketed`; a merge of sorted buckets."""
    return a.hint("merge").join(b.hint("merge"), list(keys), how)


# ------------------------------------------------------------------- digests
def block_digests(df: DataFrame, keys, value: str, block: int) -> DataFrame:
    """Digest of the cells of each block: count, two xors and a sum of cell hashes,
    none of which depends on their order.  ``keys``: position columns, cut in blocks
    of ``block``; the first of more than two names a whole matrix and is not cut."""
    keys = list(keys)
    v, odd = F.col(value), F.lit(False)
    if dict(df.dtypes)[value] in ("double", "float"):
        v, odd = v + 0, F.isnan(v - v)                # -0.0 is 0.0
    cell = [F.xxhash64(F.lit(seed), *keys, v, v.isNull()) for seed in (1, 2, 3)]
    return df.groupBy(*block_keys(keys, block)).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(cell[0]).alias("x1"), F.bit_xor(cell[1]).alias("x2"),
        F.sum(cell[2].bitwiseAND(F.lit(0x7FFFFFFF))).alias("s"), F.count_if(odd).alias("undefined"))


def block_keys(keys, block: int):
    whole = len(keys) - 2 if len(keys) > 2 else 0
    return [(F.col(k) if i < whole else F.floor(F.col(k) / block)).alias(f"__{k}")
            for i, k in enumerate(keys)]


def differing_blocks(a: DataFrame, b: DataFrame, keys, value: str = "v", block: int = 64,
                     undefined_differ: bool = False) -> DataFrame:
    """Blocks ``(__key, ...)`` that are not equal in both tables, written;
    ``undefined_differ``: and those that hold NaN or infinity."""
    names = [f"__{k}" for k in keys]
    da, db = (block_digests(x, keys, value, block) for x in (a, b))
    da = da.select(*names, F.struct("n", "x1", "x2", "s").alias("da"), F.col("undefined").alias("ua"))
    db = db.select(*names, F.struct("n", "x1", "x2", "s").alias("db"), F.col("undefined").alias("ub"))
    differ = ~F.col("da").eqNullSafe(F.col("db"))
    if undefined_differ:
        differ = differ | (F.coalesce("ua", F.lit(0)) > 0) | (F.coalesce("ub", F.lit(0)) > 0)
    out = da.join(db, names, "full_outer").where(differ)
    return materialise(out.select(*names), "differing-blocks")


def only_blocks(df: DataFrame, blocks: DataFrame, keys, block: int) -> DataFrame:
    """Cells of ``df`` in the given blocks (a semi-join; Spark broadcasts few blocks)."""
    cut = df.select("*", *block_keys(keys, block))
    return cut.join(blocks, [f"__{k}" for k in keys], "left_semi").select(*df.columns)
