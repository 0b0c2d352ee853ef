"""Joins without a shuffle, block digests, pruned stores, SQL functions: plans and odd values."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tessera.functions import sql as px_sql
from tessera.operators import matrix as mx
from tessera.operators import tone
from tessera.plans import joins
from tessera.plans.catalog import QUERIES
from tessera.plans.colocated import bucketed, differing_blocks
from tessera.sources import tables as tb


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["vector_add_bucketed", "matrix_diff_bucketed"])
def test_joins_of_bucketed_tables_have_no_exchange(spark, name):
    assert "Exchange" not in _plan(QUERIES[name](spark, SF01))


def test_bucketed_tables_of_nulls_and_repeats(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 2.0), (None, 3.0), (4, None)], "i long, v double")
    b = spark.createDataFrame([(1, 10.0), (4, 1.0), (None, 1.0)], "i long, v double")
    got = mx.vector_add_colocated(bucketed(a, ["i"], 3), bucketed(b, ["i"], 3)).collect()
    assert sorted((r.i, r.v or 0) for r in got) == [(1, 11.0), (1, 12.0), (4, 0)]


def _cells(spark, n):
    return spark.range(n * n).select((F.col("id") / n).cast("long").alias("i"), (F.col("id") % n).alias("j"),
                                     (F.col("id") * 0.5).alias("v"))


def test_block_diff_equals_the_join_on_odd_cells(spark):
    nan = float("nan")
    rows = [(0, 0, 1.0), (0, 1, None), (5, 5, nan), (5, 6, 0.0), (9, 9, 3.0), (70, 70, 1.0), (2, 2, 7.0)]
    a = spark.createDataFrame(rows, "i long, j long, v double")
    b = spark.createDataFrame([*rows[:2], (5, 5, nan), (5, 6, -0.0), (9, 9, 3.0 + 1e-12), (2, 2, None),
                               (-3, 4, 1.0)], "i long, j long, v double")
    key = lambda df: sorted(str(tuple(r)) for r in df.collect())
    for tol in (0.0, 1e-9):
        for block in (1, 4, 64):
            assert key(mx.matrix_diff_blocks(a, b, tol, block=block)) == key(mx.matrix_diff(a, b, tol))
    none = a.where("i > 1000")
    assert key(mx.matrix_diff_blocks(none, none)) == []
    assert key(mx.matrix_diff_blocks(a, none)) == key(mx.matrix_diff(a, none))


def test_block_diff_joins_only_what_differs(spark):
    a = _cells(spark, 256)
    b = a.withColumn("v", F.when((F.col("i") == 100) & (F.col("j") == 7), -1.0).otherwise(F.col("v")))
    assert differing_blocks(a, b, ("i", "j"), block=64).collect()[0][:] == (1, 0)
    df = mx.matrix_diff_blocks(a, b)
    assert [tuple(r)[:2] for r in df.collect()] == [(100, 7)]
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_only_wanted_images_are_read(spark, tmp_path):
    h = tb.hdr(spark, SF01)
    tone.write_pixel_store(h, str(tmp_path / "px"))
    store = spark.read.schema(h.schema).parquet(str(tmp_path / "px"))
    params = spark.createDataFrame([(1, 0.4, 1.2), (3, 0.5, 1.2), (99, 0.5, 1.0), (None, 1.0, 1.0)],
                                   "image_id int, p1 double, p2 double")
    out = tone.tone_store_with_params(store, params, "G")
    text = _plan(out)
    assert "dynamicpruning" in text
    assert {r.image_id for r in out.collect()} == {1, 3}
    whole = tone.tone_with_params(h.where("image_id in (1, 3)"), params, "G")
    assert out.select(whole.columns).exceptAll(whole).count() == 0
    files = out.select("image_id", F.spark_partition_id()).distinct().count()
    assert files >= 2


def test_sql_functions_are_inlined(spark):
    df = QUERIES["pixel_functions_sql"](spark, SF01)
    text = _plan(df)
    assert "Python" not in text and "Arrow" not in text and not re.search(r"px_\w+\(", text)
    assert len(px_sql.register(spark)) == len(px_sql.FUNCTIONS)
    row = spark.sql("select px_quantise8(double('NaN')) q, px_quantise8(null) n, px_chroma_x(0D, 0D, 0D) c, "
                    "px_gray8(null, 1, 2) g, px_exposure8(200, 1e300, 0) e, px_wrap8(-1) w").first()
    assert tuple(row) == (0, 0, None, None, 255, 255)


def test_release_drops_tables(spark):
    t = bucketed(spark.range(5).withColumnRenamed("id", "i"), ["i"], 2, "gone")
    name = joins._TABLES[-1]
    assert t.count() == 5
    before, joins._WRITTEN[:] = list(joins._WRITTEN[:-1]), joins._WRITTEN[-1:]
    tables, joins._TABLES[:] = list(joins._TABLES[:-1]), joins._TABLES[-1:]
    joins.release(spark)
    joins._WRITTEN[:], joins._TABLES[:] = before, tables
    assert not spark.catalog.tableExists(name)
