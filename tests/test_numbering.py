"""Dense numbering: against plain Python, on odd values, hot groups and plans."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.operators import matrix as mx
from tessera.plans import numbering
from tessera.plans.joins import materialise
from tessera.plans.numbering import number_rows


def _key(v):
    return (v is not None, v)


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_and_group_numbers(spark, parts):
    rows = [(None if i % 11 == 0 else "ab"[i % 2] if i % 3 else "é", (i * 37) % 50, i) for i in range(300)]
    rows += [("hot", 5, 5)] * 400                      # one group of rows that all tie
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(parts)
    got = number_rows(df, ["o", "v"], ["g"], name="n", dense="d").collect()
    by = defaultdict(list)
    for r in got:
        by[r.g].append(r)
    order = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for d, g in enumerate(order):
        want = sorted((o, v) for x, o, v in rows if x == g)
        mine = sorted(by[g], key=lambda r: r.n)
        assert [r.n for r in mine] == list(range(len(want)))
        assert [(r.o, r.v) for r in mine] == want
        assert {r.d for r in mine} == {d}


def test_whole_table_and_null_order(spark):
    df = spark.createDataFrame([(3.0,), (None,), (float("nan"),), (1.0,), (float("nan"),)], "x double")
    got = sorted(number_rows(df, ["x"]).collect(), key=lambda r: r.row)
    assert [str(r.x) for r in got] == ["None", "1.0", "3.0", "nan", "nan"]
    groups = number_rows(df, [], ["x"], dense="d").collect()
    assert sorted(r.d for r in groups) == [0, 1, 2, 3, 3]


def test_empty_table_and_taken_names(spark):
    empty = spark.createDataFrame([], "g long, o long")
    assert number_rows(empty, ["o"], ["g"], dense="d").collect() == []
    with pytest.raises(ValueError):
        number_rows(empty, ["o"], name="g")


def test_hot_group_is_spread_over_tasks(spark, monkeypatch):
    written = {}

    def keep(df, name):
        written[name] = materialise(df, name)
        return written[name]

    monkeypatch.setattr(numbering, "materialise", keep)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit("hot").alias("g"), F.lit(1).alias("o"), "id")
        out = number_rows(df.repartition(8), ["o"], ["g"], name="n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_task = written["placed"].groupBy("__part").count().collect()
    assert len(per_task) == 8 and max(r["count"] for r in per_task) < 1500
    assert tuple(out.agg(F.countDistinct("n"), F.max("n")).first()) == (4000, 3999)


def test_row_blocks_without_an_index(spark):
    df = spark.createDataFrame([(x,) for x in (9, 100, -5, 7, 7, 20, 3)], "k long")
    got = mx.row_blocks_by(df, 3, ["k"]).orderBy("i").collect()
    assert [(r.i, r.k, r.block) for r in got] == [
        (0, -5, 0), (1, 3, 0), (2, 7, 0), (3, 7, 1), (4, 9, 1), (5, 20, 2), (6, 100, 2)]
