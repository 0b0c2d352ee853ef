"""Vectors and matrices: golden cases from recorded outputs, NumPy properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import SF001
from tessera.operators import matrix as mx
from tessera.sources import tables as tb


def _dense(df, n_rows, n_cols):
    m = np.full((n_rows, n_cols), np.nan)
    for r in df.collect():
        m[r["i"], r["j"]] = r["v"]
    return m


def test_golden_ones_times_twos(spark):
    # Recorded output: 3x3 ones times 3x3 twos = 6.00 in every cell.
    a = mx.const_matrix(spark, 3, 3, 1.0)
    b = mx.const_matrix(spark, 3, 3, 2.0)
    for prod in (mx.matmul_coo(a, b), mx.matmul_block(a, b, bs=2)):
        assert np.all(_dense(prod, 3, 3) == 6.0)


@pytest.mark.parametrize("n,bs", [(16, 16), (40, 16)])
def test_golden_all_twos_give_4n(spark, n, bs):
    a = mx.const_matrix(spark, n, n, 2.0)
    prod = mx.matmul_block(a, a, bs=bs)
    assert prod.count() == n * n
    assert np.all(_dense(prod, n, n) == 4.0 * n)


def test_formula_matrices_rectangular(spark):
    a = mx.formula_matrix(spark, 62, 15, "sum")
    b = mx.formula_matrix(spark, 15, 7, "product")
    want = np.add.outer(np.arange(62), np.arange(15)) @ np.multiply.outer(np.arange(15), np.arange(7))
    np.testing.assert_allclose(_dense(mx.matmul_coo(a, b), 62, 7), want)
    np.testing.assert_allclose(_dense(mx.matmul_block(a, b, bs=8), 62, 7), want)
    rows = mx.cells_to_rows(a)
    for limit in (mx.RIGHT_MAX_CELLS, 4):             # replicated, and by blocks
        mx_limit, mx.RIGHT_MAX_CELLS = mx.RIGHT_MAX_CELLS, limit
        try:
            got = {r["i"]: r["vec"] for r in mx.matmul_rows(rows, b).collect()}
        finally:
            mx.RIGHT_MAX_CELLS = mx_limit
        np.testing.assert_allclose([got[i] for i in range(62)], want)


def test_random_int_matrix_range_determinism_and_exact_product(spark):
    a = mx.random_int_matrix(spark, 30, 20, seed=5)
    b = mx.random_int_matrix(spark, 20, 10, seed=6)
    vals = [r["v"] for r in a.collect()]
    assert min(vals) >= 1 and max(vals) <= 10 and len(set(vals)) == 10
    assert sorted(vals) == sorted(r["v"] for r in mx.random_int_matrix(spark, 30, 20, 5).collect())
    prod = mx.matmul_coo(a, b)
    assert dict(prod.dtypes)["v"] == "bigint"
    want = _dense(a, 30, 20).astype(np.int64) @ _dense(b, 20, 10).astype(np.int64)
    got = _dense(prod, 30, 10)
    np.testing.assert_array_equal(got, want)


@pytest.mark.parametrize("n,value,total", [(100, 2.0, 4.0), (500, 1.0, 2.0)])
def test_golden_vector_add(spark, n, value, total):
    # Recorded outputs: 2+2 = 4.0 for 100 entries; 1+1 = 2.0 for 500 entries.
    a = mx.const_vector(spark, n, value)
    got = mx.vector_add(a, a).collect()
    assert len(got) == n and {r["v"] for r in got} == {total}


def test_golden_row_blocks_34_33_33(spark):
    rows = spark.range(100).withColumnRenamed("id", "i")
    ext = {r["block"]: (r["first_row"], r["n_rows"])
           for r in mx.block_extents(mx.row_blocks(rows, 3)).collect()}
    assert ext == {0: (0, 34), 1: (34, 33), 2: (67, 33)}


@pytest.mark.parametrize("n,w", [(62, 7), (10000, 64), (5, 8), (1, 1)])
def test_row_blocks_match_ntile(spark, n, w):
    rows = spark.range(n).withColumnRenamed("id", "i")
    rows.createOrReplaceTempView("rb")
    want = {r["i"]: r["b"] for r in spark.sql(
        f"select i, ntile({w}) over (order by i) - 1 b from rb").collect()}
    got = {r["i"]: r["block"] for r in mx.row_blocks(rows, w).collect()}
    assert got == want


def test_matrix_diff_exact_and_tolerance(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, None), (1, 1, 4.0)],
                              "i long, j long, v double")
    b = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0 + 1e-12), (1, 0, None), (2, 2, 5.0)],
                              "i long, j long, v double")
    diff = {(r["i"], r["j"]) for r in mx.matrix_diff(a, b).collect()}
    assert diff == {(0, 1), (1, 1), (2, 2)}
    diff_tol = {(r["i"], r["j"]) for r in mx.matrix_diff(a, b, tol=1e-9).collect()}
    assert diff_tol == {(1, 1), (2, 2)}
    s = mx.matrix_diff_summary(a, a).collect()[0]
    assert (s["n_cells"], s["n_diff"]) == (4, 0)


def test_gram_equals_numpy(spark):
    emb = tb.read_table(spark, SF001, "embeddings").toPandas()
    x = np.vstack(emb["embedding"].to_numpy()).astype(np.float64)
    rows = tb.read_table(spark, SF001, "embeddings").selectExpr(
        "vec_id i", "cast(embedding as array<double>) vec")
    got = _dense(mx.gram(rows), 64, 64)
    np.testing.assert_allclose(got, x.T @ x, rtol=1e-10, atol=1e-12)
    cells = tb.embedding_cells(spark, SF001)
    blk = _dense(mx.matmul_block(mx.transpose(cells), cells, bs=100), 64, 64)
    np.testing.assert_allclose(blk, x.T @ x, rtol=1e-10, atol=1e-12)
    # One output block, five inner blocks in groups of two: three tasks' partials.
    salted = _dense(mx.matmul_block(mx.transpose(cells), cells, bs=16, side=2), 64, 64)
    np.testing.assert_allclose(salted, x.T @ x, rtol=1e-10, atol=1e-12)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 9), k=st.integers(1, 9), m=st.integers(1, 9), bs=st.integers(1, 5),
       seed=st.integers(0, 1000))
def test_block_and_coo_match_numpy(spark, n, k, m, bs, seed):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, k))
    b = rng.normal(size=(k, m))
    da = spark.createDataFrame([(i, j, float(a[i, j])) for i in range(n) for j in range(k)],
                               "i long, j long, v double")
    db = spark.createDataFrame([(i, j, float(b[i, j])) for i in range(k) for j in range(m)],
                               "i long, j long, v double")
    want = a @ b
    np.testing.assert_allclose(_dense(mx.matmul_block(da, db, bs=bs), n, m), want, atol=1e-12)
    np.testing.assert_allclose(_dense(mx.matmul_coo(da, db), n, m), want, atol=1e-12)


def test_block_matmul_sparse_cells_match_coo(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (2, 3, 2.0), (4, 1, 3.0)], "i long, j long, v double")
    b = spark.createDataFrame([(0, 2, 5.0), (3, 0, 7.0), (2, 2, 1.0)], "i long, j long, v double")
    coo = {(r["i"], r["j"]): r["v"] for r in mx.matmul_coo(a, b).collect()}
    blk = {(r["i"], r["j"]): r["v"] for r in mx.matmul_block(a, b, bs=2).collect()}
    assert coo == blk == {(0, 2): 5.0, (2, 0): 14.0}


def test_parameter_checks(spark):
    a = mx.const_matrix(spark, 2, 2, 1.0)
    with pytest.raises(ValueError):
        mx.matmul_block(a, a, bs=0)
    with pytest.raises(ValueError):
        mx.row_blocks(a, 0)


def test_block_equals_coo_on_undefined_and_repeated_cells(spark):
    nan, inf = float("nan"), float("inf")
    a = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (0, 1, nan), (1, 2, inf), (2, 2, 0.0),
                               (3, 5, None), (4, 5, 7.0), (4, 5, None), (5, 9, 2.0)],
                              "i long, j long, v double")
    b = spark.createDataFrame([(0, 0, 4.0), (0, 3, 5.0), (1, 3, 1.0), (2, 0, 0.0), (2, 4, 3.0),
                               (5, 1, 2.0), (9, 9, -inf), (9, 2, None)], "i long, j long, v double")
    key = lambda df: {(r["i"], r["j"]): str(r["v"]) for r in df.collect()}
    for bs, side in ((1, 1), (2, 2), (64, 4)):
        assert key(mx.matmul_block(a, b, bs=bs, side=side)) == key(mx.matmul_coo(a, b))


def test_integer_block_product_is_exact(spark):
    big = 2 ** 53 + 1
    a = spark.createDataFrame([(0, 0, big), (0, 1, 1), (70, 1, 3)], "i long, j long, v long")
    b = spark.createDataFrame([(0, 0, 1), (1, 65, 2)], "i long, j long, v long")
    prod = mx.matmul_block(a, b, bs=8, side=2)
    assert dict(prod.dtypes)["v"] == "bigint"
    assert {(r["i"], r["j"]): r["v"] for r in prod.collect()} == {(0, 0): big, (0, 65): 2, (70, 65): 6}


def test_row_product_shuffles_nothing_and_keeps_null_rows(spark):
    b = spark.createDataFrame([(0, 0, 1.0), (1, 1, 2.0)], "i long, j long, v double")
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "i long, vec array<double>")
    prod = mx.matmul_rows(rows, b)
    assert "Exchange" not in prod._jdf.queryExecution().executedPlan().toString()
    assert {r["i"]: r["vec"] for r in prod.collect()} == {1: [1.0, 4.0], 2: None}


def test_matmul_rows_fills_missing_columns_either_way(spark, monkeypatch):
    rows = spark.createDataFrame([(0, [1, 2]), (1, None), (2, [3, 0]), (3, [0, 0])],
                                 "i long, vec array<long>")
    b = spark.createDataFrame([(0, 0, 5), (1, 0, 1), (1, 2, 7), (0, 4, 2)], "i long, j long, v long")
    want = [(0, [7.0, 0.0, 14.0, 0.0, 2.0]), (1, None), (2, [15.0, 0.0, 0.0, 0.0, 6.0]),
            (3, [0.0] * 5)]
    for limit in (1 << 22, 1):
        monkeypatch.setattr(mx, "RIGHT_MAX_CELLS", limit)
        got = mx.matmul_rows(rows, b)
        assert got.dtypes == [("i", "bigint"), ("vec", "array<double>")]
        assert sorted((r.i, r.vec) for r in got.collect()) == want


def test_matmul_rows_one_answer_on_both_sides_of_the_limit(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rows = spark.createDataFrame(
        [(0, [inf, 1.0]), (1, [None, 2.0]), (2, [nan, None]), (3, [1.0, 2.0, 9.0, nan]), (4, [3.0]),
         (5, []), (6, None), (7, [0.0, -inf])], "i long, vec array<double>")
    b = spark.createDataFrame([(0, 0, 1.0), (1, 1, 5.0), (1, 3, None), (0, 4, 2.0), (0, 4, 1.0)],
                              "i long, j long, v double")
    want = {0: [inf, 5.0, 0.0, 0.0, inf], 1: [0.0, 10.0, 0.0, 0.0, 0.0], 2: [nan, 0.0, 0.0, 0.0, nan],
            3: [1.0, 10.0, 0.0, 0.0, 3.0], 4: [3.0, 0.0, 0.0, 0.0, 9.0], 5: [0.0] * 5, 6: None,
            7: [0.0, -inf, 0.0, 0.0, 0.0]}
    for limit in (1 << 22, 1):
        monkeypatch.setattr(mx, "RIGHT_MAX_CELLS", limit)
        got = {r.i: r.vec for r in mx.matmul_rows(rows, b).collect()}
        assert {k: str(v) for k, v in got.items()} == {k: str(v) for k, v in want.items()}, limit


@pytest.mark.parametrize("kind", ["long", "double"])
def test_sparse_product_with_heavy_indices_equals_coo(spark, monkeypatch, kind):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(mx, "HEAVY_SPAN", 16)
    monkeypatch.setattr(mx, "HEAVY_CELLS", 40)
    cells = [(int(rng.integers(60)), 0 if rng.random() < 0.4 else int(rng.integers(1, 9)),
              int(rng.integers(-9, 9))) for _ in range(400)]
    if kind == "double":
        cells = [(i, j, None if v == 3 else float("nan") if v == 4 and i < 3 else v * 0.5) for i, j, v in cells]
    a = spark.createDataFrame(cells, f"i long, j long, v {kind}")
    b = mx.transpose(a).withColumn("j", F.col("j") % 37)
    key = lambda df: {(r.i, r.j): str(r.v if r.v is None else round(r.v, 9) + 0) for r in df.collect()}
    want = key(mx.matmul_coo(mx._summed(a), mx._summed(b)))
    for heavy in (mx.HEAVY_PAIRS, 500, 0):
        assert key(mx.matmul_sparse(a, b, heavy)) == want, heavy
    assert mx.matmul_sparse(a.where("i < 0"), b).collect() == []


def test_heavy_index_is_dealt_over_blocks(spark):
    """A third of the cells in one inner index: no block holds a quarter of its pairs."""
    cells = spark.range(9000).select((F.col("id") / 3).cast("long").alias("i"))
    rows = cells.distinct().groupBy(mx.dealt("i", -(-3000 // mx.HEAVY_SPAN)).alias("g")).count().collect()
    share = max(r["count"] for r in rows) / 3000
    assert share * share < 0.25


def test_cuboid_side_follows_shape_and_memory(spark):
    cores = spark.sparkContext.defaultParallelism
    assert mx._side(spark, 128, (100, 100, 100)) == mx.MIN_SPAN // 128
    assert mx._side(spark, 128, (10 ** 6,) * 3) == mx.MAX_SPAN // 128
    n = mx._side(spark, 128, (4096,) * 3) * 128
    assert (4096 / n) ** 3 >= 2 * cores
