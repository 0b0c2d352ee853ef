"""Dense row numbers in sort order without a window over the table.

Rows are dealt by range over the sort columns and sorted inside partitions, so
the number of a row is its place in its partition plus the rows of earlier
partitions.  One pass inside the partitions finds the places; the sums over
partitions have one row per partition, however many rows or groups there are.
A group that holds most rows is spread over many partitions like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.joins import join_small, materialise

_TAG, _PART, _RUN, _AT = "__tag", "__part", "__run", "__at"


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value differs from the one before it; null equals null."""
    a, b = column[1:], column[:-1]
    differ = pc.fill_null(pc.not_equal(a, b), False)
    if pa.types.is_floating(column.type):             # NaN is one value, as in grouping
        differ = pc.and_(differ, pc.invert(pc.and_(pc.fill_null(pc.is_nan(a), False),
                                                   pc.fill_null(pc.is_nan(b), False))))
    differ = pc.or_(differ, pc.not_equal(pc.is_null(a), pc.is_null(b)))
    return differ.to_numpy(zero_copy_only=False)


def _places(group: list[str]):
    """Number of the run of equal groups in the partition, place in that run."""
    def run(batches):
        runs, at, last = -1, 0, None
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            start = np.zeros(n, bool)
            start[0] = last is None
            for g in group:
                col = batch.column(batch.schema.get_field_index(g))
                start[1:] |= _changes(col)
                if last is not None:
                    both = pa.concat_arrays([last[g], col.slice(0, 1)])
                    start[0] |= _changes(both)[0]
            last = {g: batch.column(batch.schema.get_field_index(g)).slice(n - 1, 1) for g in group}
            row = np.arange(n)
            first = np.maximum.accumulate(np.where(start, row, -1))
            place = np.where(first < 0, at + row, row - first)
            number = runs + np.cumsum(start)
            runs, at = int(number[-1]), int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(number, pa.int64()), pa.array(place, pa.int64())],
                names=[*batch.schema.names, _RUN, _AT])
    return run


def number_rows(df: DataFrame, order, group=(), name: str = "row", dense: str | None = None
                ) -> DataFrame:
    """``df`` with ``name``: 0-based number of each row by ``order`` within its
    ``group`` (column names; all rows if empty), and with ``dense`` the 0-based
    number of the group itself in the order of the group columns.

    Nulls come first, strings by their UTF-8 bytes.  Rows that tie keep an
    order that stays the same in every read of the result, but is otherwise
    not defined.  No rows give no rows.  The result is a written table joined
    with one row per partition.
    """
    group, order = list(group), list(order)
    for c in (name, dense):
        if c is not None and c in df.columns:
            raise ValueError(f"column {c} exists")
    if dense is not None and not group:
        raise ValueError("dense needs group columns")
    # Written with a tag, so that rows which tie are spread by range as well.
    tagged = materialise(df.withColumn(_TAG, F.monotonically_increasing_id()), "tagged")
    by = [F.col(f"`{c}`") for c in [*group, *order, _TAG]]
    dealt = (tagged.repartitionByRange(*by).sortWithinPartitions(*by)
             .withColumn(_PART, F.spark_partition_id()))
    kind = T.StructType([*dealt.schema.fields, T.StructField(_RUN, T.LongType()),
                         T.StructField(_AT, T.LongType())])
    placed = materialise(dealt.mapInArrow(_places(group), kind).drop(_TAG), "placed")
    keys = [F.col(f"`{c}`") for c in group]
    runs = placed.groupBy(_PART, *keys).agg(F.count(F.lit(1)).alias("n"), F.min(_RUN).alias("r"))
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(_PART, "r", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # Only the first run of a partition can continue a group of earlier ones.
    parts = runs.groupBy(_PART).agg(
        F.max(F.when(F.col("r") == 0, F.col("before"))).alias("before"),
        F.sum((F.col("before") == 0).cast("long")).alias("begun"))
    over = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(_PART, F.col("before").alias("__before"), (
        F.coalesce(F.sum("begun").over(over), F.lit(0))
        - (F.col("before") > 0).cast("long")).alias("__dense"))
    out = join_small(placed, parts, _PART)
    number = F.col(_AT) + F.when(F.col(_RUN) == 0, F.col("__before")).otherwise(F.lit(0))
    cols = [F.col(f"`{c}`") for c in df.columns]
    if dense is not None:
        cols.append((F.col("__dense") + F.col(_RUN)).alias(dense))
    return out.select(*cols, number.alias(name))
