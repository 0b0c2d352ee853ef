"""Vectors and matrices as coordinate tables.

A vector is ``(i, v)``; a matrix is ``(i, j, v)`` (one row per stored cell).
Position-aligned arithmetic is an equi-join on the index, matrix products
are joins on the inner index followed by aggregation, and row-block
partitioning is a closed form on the row index.

Products, by shape:

* ``matmul_coo``: join cells on the inner index, aggregate by ``(i, j)``.
  For sparse or skinny inputs; the join emits one row per multiply.
* ``matmul_sparse``: the same, but inner indices with very many cells (counted
  first) go through block products instead of the join.
* ``matmul_block``: pack ``bs x bs`` blocks (groups bounded by ``bs^2``
  cells), group them in cuboids of blocks, send each block once per cuboid that
  needs it, and multiply whole cuboids with NumPy.  For dense inputs.
* ``gram``: ``X^T X`` of a tall matrix given as rows ``(i, array)``: each
  task adds ``x x^T`` over its own rows and emits one ``d x d`` partial, so
  the only shuffle carries ``tasks * d^2`` cells.
* ``matmul_rows``: ``A B`` with ``A`` as rows and ``B`` small (size checked,
  then sent to every task): rows are multiplied where they are, no shuffle.

Products of integer cells are exact integers; NaN and infinite cells follow
floating-point rules; repeated cells add up; a NULL cell contributes nothing,
but its position counts, so a result cell that only NULLs reach is NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.colocated import colocated_join, differing_blocks, only_blocks
from tessera.plans.joins import materialise
from tessera.plans.numbering import number_rows

CELL_SCHEMA = T.StructType([
    T.StructField("i", T.LongType(), False),
    T.StructField("j", T.LongType(), False),
    T.StructField("v", T.DoubleType(), True),
])


# ---------------------------------------------------------------- generators
def _grid(spark: SparkSession, n_rows: int, n_cols: int) -> DataFrame:
    if n_rows < 0 or n_cols < 1:
        raise ValueError("matrix dimensions must be positive")
    ids = spark.range(n_rows * n_cols)
    return ids.select((F.col("id") / n_cols).cast("long").alias("i"),
                      (F.col("id") % n_cols).alias("j"))


def const_matrix(spark: SparkSession, n_rows: int, n_cols: int, value: float) -> DataFrame:
    """Matrix with every cell equal to ``value``."""
    return _grid(spark, n_rows, n_cols).withColumn("v", F.lit(value).cast("double"))


def formula_matrix(spark: SparkSession, n_rows: int, n_cols: int, kind: str) -> DataFrame:
    """``kind="sum"``: ``v = i + j``; ``kind="product"``: ``v = i * j``."""
    g = _grid(spark, n_rows, n_cols)
    if kind == "sum":
        return g.withColumn("v", (F.col("i") + F.col("j")).cast("double"))
    if kind == "product":
        return g.withColumn("v", (F.col("i") * F.col("j")).cast("double"))
    raise ValueError("kind must be 'sum' or 'product'")


def random_int_matrix(spark: SparkSession, n_rows: int, n_cols: int, seed: int,
                      lo: int = 1, hi: int = 10) -> DataFrame:
    """Integer cells uniform in ``lo..hi``, a pure function of ``(i, j, seed)``.

    A hash instead of a random generator keeps the values identical when a
    task is retried after an executor loss.
    """
    if hi < lo:
        raise ValueError("hi must be >= lo")
    g = _grid(spark, n_rows, n_cols)
    h = F.xxhash64(F.col("i"), F.col("j"), F.lit(seed))
    return g.withColumn("v", (F.pmod(h, F.lit(hi - lo + 1)) + lo).cast("long"))


def const_vector(spark: SparkSession, n: int, value: float) -> DataFrame:
    return spark.range(n).select(F.col("id").alias("i"), F.lit(value).cast("double").alias("v"))


# ------------------------------------------------------------------- vectors
def vector_add(a: DataFrame, b: DataFrame) -> DataFrame:
    """``C[i] = A[i] + B[i]`` for positions present in both (inner equi-join)."""
    return a.alias("a").join(b.alias("b"), "i").select(
        "i", (F.col("a.v") + F.col("b.v")).alias("v"))


# ---------------------------------------------------------------- row blocks
def row_blocks(df: DataFrame, n_blocks: int, index: str = "i",
               n_rows=None) -> DataFrame:
    """Assign rows with a dense 0-based index to ``n_blocks`` contiguous blocks.

    Block sizes differ by at most one and the first ``n mod w`` blocks get the
    extra row.  ``n_rows`` defaults to ``count(*)`` (one aggregation job, one
    number to the driver), so the assignment is one narrow projection with no
    window over the whole table.
    """
    if n_blocks < 1:
        raise ValueError("n_blocks must be >= 1")
    n = F.lit(int(n_rows if n_rows is not None else df.count())).cast("long")
    w = F.lit(n_blocks).cast("long")
    q = F.floor(n / w).cast("long")
    e = (n % w).cast("long")
    i = F.col(index)
    big = e * (q + 1)
    block = F.when(i < big, F.floor(i / (q + 1))).otherwise(
        e + F.floor((i - big) / F.greatest(q, F.lit(1))))
    return df.withColumn("block", block.cast("int"))


def row_blocks_by(df: DataFrame, n_blocks: int, order, index: str = "i") -> DataFrame:
    """``row_blocks`` of a table without a dense index: rows are numbered by
    the ``order`` columns first (``index`` is that number).  Rows that tie get
    consecutive numbers in any order."""
    return row_blocks(number_rows(df, order, name=index), n_blocks, index, n_rows=df.count())


def vector_add_by(a: DataFrame, b: DataFrame, order_a, order_b) -> DataFrame:
    """``C[i] = A[i] + B[i]`` of two tables with a value ``v`` and no position:
    the position of a row is its number by the order columns of its table."""
    return vector_add(number_rows(a, order_a, name="i").select("i", "v"),
                      number_rows(b, order_b, name="i").select("i", "v"))


def block_extents(blocks: DataFrame, index: str = "i") -> DataFrame:
    """``(block, first_row, n_rows)`` per block (partial + final aggregation)."""
    return blocks.groupBy("block").agg(F.min(index).alias("first_row"),
                                       F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ products
def _summed(m: DataFrame) -> DataFrame:
    """One row per position: repeated cells added."""
    return m.groupBy("i", "j").agg(F.sum("v").alias("v"))


def matmul_coo(a: DataFrame, b: DataFrame) -> DataFrame:
    """``C = A B`` on coordinate tables; ``a(i, k, v)`` given as ``(i, j, v)``."""
    left = a.select(F.col("i"), F.col("j").alias("k"), F.col("v").alias("av"))
    right = b.select(F.col("i").alias("k"), F.col("j"), F.col("v").alias("bv"))
    return (left.join(right, "k")
            .groupBy("i", "j").agg(F.sum(F.col("av") * F.col("bv")).alias("v")))


# Pairs of cells that one inner index may add to a join; beyond it goes in blocks.
HEAVY_PAIRS = 1 << 20
# Rows and columns of a block of heavy products, and cells of one of its sides.
HEAVY_SPAN, HEAVY_CELLS = 1024, 1 << 20


def inner_counts(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(k, na, nb)``: cells per inner index that both sides have, written."""
    left = a.groupBy(F.col("j").alias("k")).agg(F.count(F.lit(1)).alias("na"))
    right = b.groupBy(F.col("i").alias("k")).agg(F.count(F.lit(1)).alias("nb"))
    return materialise(left.join(right, "k"), "inner-counts")


def dealt(c: str, n: int):
    """Group of an index among ``n``, by hash."""
    return F.pmod(F.xxhash64(c), F.lit(n))


def _outer_sums(kinds: pa.Schema, dtype):
    """Product of the cells of one block: an outer product per inner index,
    added in place to the block's rows and columns."""
    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return kinds.empty_table()
        rows, r = np.unique(left.column("i").to_numpy(), return_inverse=True)
        cols, c = np.unique(right.column("j").to_numpy(), return_inverse=True)
        sums = np.zeros((len(rows), len(cols)), dtype)
        met, real = np.zeros(sums.shape, bool), np.zeros(sums.shape, bool)
        sides = []
        for t, at in ((left, r), (right, c)):
            k = t.column("k").to_numpy()
            order = np.argsort(k, kind="stable")
            v = t.column("v").combine_chunks()
            known = v.is_valid().to_numpy(zero_copy_only=False)[order]
            v = v.fill_null(0).to_numpy(zero_copy_only=False).astype(dtype)[order]
            sides.append((k[order], at[order], v, known))
        (ka, ra, va, na), (kb, cb, vb, nb) = sides
        for k in np.intersect1d(ka, kb):
            x = slice(*np.searchsorted(ka, [k, k + 1]))
            y = slice(*np.searchsorted(kb, [k, k + 1]))
            met[np.ix_(ra[x], cb[y])] = True
            at = np.ix_(ra[x][na[x]], cb[y][nb[y]])
            with np.errstate(invalid="ignore", over="ignore"):
                sums[at] += np.outer(va[x][na[x]], vb[y][nb[y]])
            real[at] = True
        i, j = np.nonzero(met)
        return pa.table([pa.array(rows[i]), pa.array(cols[j]), pa.array(sums[i, j], mask=~real[i, j])],
                        schema=kinds)
    return multiply


def matmul_sparse(a: DataFrame, b: DataFrame, heavy_pairs: int = HEAVY_PAIRS) -> DataFrame:
    """``C = A B`` of sparse cells, however unevenly the inner index is used.

    Cells are counted per inner index first.  An index with at most
    ``heavy_pairs`` pairs of cells goes through the join of :func:`matmul_coo`.
    The heavy ones go in blocks: their cells are dealt by the hashes of row,
    column and inner index, and a task adds up the outer products of its block
    in an array of about ``HEAVY_SPAN`` squared, so a pair of cells is never a
    row.  Same cells and values as :func:`matmul_coo`, exact ``bigint`` for
    integer input.
    """
    exact = _is_integer(a) and _is_integer(b)
    kind, dtype = ("long", np.int64) if exact else ("double", np.float64)
    a = materialise(_summed(a), "left-cells")
    b = materialise(_summed(b), "right-cells")
    counts = inner_counts(a, b)
    is_heavy = F.col("na") * F.col("nb") > heavy_pairs
    light = counts.where(~is_heavy).select("k")
    left = a.select("i", F.col("j").alias("k"), F.col("v").cast(kind).alias("v"))
    right = b.select(F.col("i").alias("k"), "j", F.col("v").cast(kind).alias("v"))
    # Both sides are cut to light indices before they meet: no join key is hot.
    out = matmul_coo(left.join(light, "k", "left_semi").select("i", F.col("k").alias("j"), "v"),
                     right.join(light, "k", "left_semi").select(F.col("k").alias("i"), "j", "v"))
    heavy = materialise(counts.where(is_heavy), "heavy")
    if heavy.limit(1).count() == 0:
        return out
    left = materialise(left.join(heavy.select("k"), "k", "left_semi"), "heavy-left")
    right = materialise(right.join(heavy.select("k"), "k", "left_semi"), "heavy-right")
    grid = []
    for side, c in ((left, "i"), (right, "j")):
        n = side.agg(F.count(F.lit(1)), F.countDistinct(c)).first()
        grid.append((n[0], max(1, -(-n[1] // HEAVY_SPAN))))
    (cells_a, rows), (cells_b, cols) = grid
    layers = max(1, -(-cells_a // (rows * HEAVY_CELLS)), -(-cells_b // (cols * HEAVY_CELLS)))

    def copies(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = left.select(dealt("i", rows).alias("gi"), copies(cols).alias("gj"),
                       dealt("k", layers).alias("gk"), "i", "k", "v")
    right = right.select(copies(rows).alias("gi"), dealt("j", cols).alias("gj"),
                         dealt("k", layers).alias("gk"), "k", "j", "v")
    kinds = pa.schema([("i", pa.int64()), ("j", pa.int64()), ("v", pa.int64() if exact else pa.float64())])
    keys = ["gi", "gj", "gk"]
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _outer_sums(kinds, dtype), f"i long, j long, v {kind}")
    return out.unionByName(sums).groupBy("i", "j").agg(F.sum("v").alias("v"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def _pack_blocks(m: DataFrame, bs: int, row_key: str, col_key: str, kind: str) -> DataFrame:
    """Group cells into ``bs x bs`` blocks ``(row_key, col_key, pos, val)``.

    ``pos`` holds the row-major offsets inside the block and ``val`` the
    values, as two aligned arrays that NumPy unpacks without a Python loop.
    A block holds at most ``bs^2`` distinct cells, whatever the matrix size.
    """
    cells = (_summed(m).select(
        F.floor(F.col("i") / bs).cast("long").alias(row_key),
        F.floor(F.col("j") / bs).cast("long").alias(col_key),
        F.struct(((F.col("i") % bs) * bs + F.col("j") % bs).cast("int").alias("p"),
                 F.col("v").cast(kind).alias("v")).alias("cell"))
        .groupBy(row_key, col_key).agg(F.collect_list("cell").alias("_cells")))
    return cells.select(row_key, col_key,
                        F.transform("_cells", lambda c: c["p"]).alias("pos"),
                        F.transform("_cells", lambda c: c["v"]).alias("val"))


def _cuboid_side(table: pa.Table, row: str, col: str, bs: int, dtype):
    """A side of a cuboid as one dense array with the masks of its stored and of
    its valued cells, and the first block row and column."""
    rows, cols = table.column(row).to_numpy(), table.column(col).to_numpy()
    r0, c0 = int(rows.min()), int(cols.min())
    shape = ((int(rows.max()) - r0 + 1) * bs, (int(cols.max()) - c0 + 1) * bs)
    m, stored, valued = np.zeros(shape, dtype), np.zeros(shape, bool), np.zeros(shape, bool)
    for k in range(table.num_rows):
        pos = table.column("pos")[k].values.to_numpy(zero_copy_only=False)
        val = table.column("val")[k].values
        y = (int(rows[k]) - r0) * bs + pos // bs
        x = (int(cols[k]) - c0) * bs + pos % bs
        known = ~val.is_null().to_numpy(zero_copy_only=False)
        stored[y, x] = True
        valued[y[known], x[known]] = True
        m[y[known], x[known]] = val.drop_null().to_numpy(zero_copy_only=False)
    return m, stored, valued, r0, c0


def _product(ma, va, mb, vb):
    """``ma @ mb`` over valued cells: a NaN or infinity only meets valued cells."""
    if ma.dtype != np.float64:
        return ma @ mb
    bad_a, bad_b = ~np.isfinite(ma), ~np.isfinite(mb)
    with np.errstate(invalid="ignore", over="ignore"):
        out = np.where(bad_a, 0.0, ma) @ np.where(bad_b, 0.0, mb)
        for r, k in zip(*np.nonzero(bad_a)):
            cols = np.flatnonzero(vb[k])
            out[r, cols] += ma[r, k] * mb[k, cols]
        for k, c in zip(*np.nonzero(bad_b)):
            rows = np.flatnonzero(va[:, k] & ~bad_a[:, k])
            out[rows, c] += ma[rows, k] * mb[k, c]
    return out


def _reached(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which cells of a product some pair of cells reaches."""
    if a.all() and b.all():
        return np.ones((a.shape[0], b.shape[1]), bool)
    return (a.astype(np.float32) @ b.astype(np.float32)) > 0


def _is_integer(m: DataFrame) -> bool:
    return isinstance(m.schema["v"].dataType, T.IntegralType)


# Cells along one side of a cuboid: a side holds at most 128 MB of doubles.
MIN_SPAN, MAX_SPAN = 512, 4096


def _side(spark: SparkSession, bs: int, shape) -> int:
    """Blocks along a cuboid's side: as large as memory allows, and so that
    there are some three cuboids per core."""
    cells = float(np.prod([float(n) for n in shape]))
    span = (cells / (3 * max(1, spark.sparkContext.defaultParallelism))) ** (1 / 3)
    return max(1, int(min(MAX_SPAN, max(MIN_SPAN, span))) // bs)


def matmul_block(a: DataFrame, b: DataFrame, bs: int = 128, side: int | None = None) -> DataFrame:
    """Dense ``C = A B`` by cuboids of ``side^3`` blocks of ``bs x bs`` cells.

    A block of ``A`` goes once to every cuboid column of ``B``, and the reverse:
    with ``nb`` blocks per dimension a block is sent ``nb / side`` times, not
    ``nb`` times, and no pair of blocks is ever shuffled.  A task multiplies the
    two sides of a cuboid as dense arrays (``side * bs`` squared; by default chosen
    from the shape, at most ``MAX_SPAN`` squared) and emits its partial cells; the final aggregation adds one partial per cuboid layer.
    The result has the same cells and values as :func:`matmul_coo`, exact
    ``bigint`` for integer input.
    """
    if bs < 1 or (side is not None and side < 1):
        raise ValueError("block size and side must be >= 1")
    exact = _is_integer(a) and _is_integer(b)
    kind, dtype = ("long", np.int64) if exact else ("double", np.float64)
    last = a.agg(F.max("i"), F.max("j")).first(), b.agg(F.max("i"), F.max("j")).first()
    n_rows, n_inner, n_cols = ((-1 if x is None else int(x)) + 1 for x in (
        last[0][0], last[0][1], last[1][1]))
    side = side or _side(a.sparkSession, bs, (n_rows, n_inner, n_cols))
    top = ((n_rows - 1) // (bs * side), (n_cols - 1) // (bs * side))

    def copies(n):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n, 0)).cast("long")))

    group = lambda c: F.floor(F.col(c) / side).cast("long")
    ab = _pack_blocks(a, bs, "bi", "bk", kind).select(
        group("bi").alias("gi"), copies(top[1]).alias("gj"), group("bk").alias("gk"),
        "bi", "bk", "pos", "val")
    bb = _pack_blocks(b, bs, "bk", "bj", kind).select(
        copies(top[0]).alias("gi"), group("bj").alias("gj"), group("bk").alias("gk"),
        "bk", "bj", "pos", "val")
    schema = pa.schema([("i", pa.int64()), ("j", pa.int64()),
                        ("v", pa.int64() if exact else pa.float64())])

    def multiply(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return schema.empty_table()
        ma, sa, va, i0, ka = _cuboid_side(left, "bi", "bk", bs, dtype)
        mb, sb, vb, kb, j0 = _cuboid_side(right, "bk", "bj", bs, dtype)
        lo, hi = max(ka, kb), min(ka + ma.shape[1] // bs, kb + mb.shape[0] // bs)
        if lo >= hi:
            return schema.empty_table()
        x = slice((lo - ka) * bs, (hi - ka) * bs)
        y = slice((lo - kb) * bs, (hi - kb) * bs)
        cover, real = _reached(sa[:, x], sb[y]), _reached(va[:, x], vb[y])
        prod = _product(ma[:, x], va[:, x], mb[y], vb[y])
        r, c = np.nonzero(cover)
        return pa.table([pa.array(i0 * bs + r), pa.array(j0 * bs + c),
                         pa.array(prod[r, c], mask=~real[r, c])], schema=schema)

    keys = ["gi", "gj", "gk"]
    partial = ab.groupBy(*keys).cogroup(bb.groupBy(*keys)).applyInArrow(
        multiply, f"i long, j long, v {kind}")
    return partial.groupBy("i", "j").agg(F.sum("v").alias("v"))


# A task of ``gram`` holds a d x d array of doubles: 128 MB at most.
GRAM_MAX_WIDTH = 4096


def gram(rows: DataFrame, vec: str = "vec") -> DataFrame:
    """``X^T X`` for a tall matrix given as rows ``(i, vec array<double>)``.

    Each task sums ``x x^T`` over its own rows (one BLAS call per Arrow
    batch) and emits one ``d x d`` partial; the final sum shuffles only those.
    A NULL row is a row without cells and adds nothing.  Rows wider than
    ``GRAM_MAX_WIDTH`` raise: use :func:`matmul_block`.
    """
    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        acc = None
        for pdf in batches:
            vals = [np.asarray(v, dtype=np.float64) for v in pdf[vec] if v is not None]
            if not vals:
                continue
            if len(vals[0]) > GRAM_MAX_WIDTH:
                raise ValueError(f"gram: rows wider than {GRAM_MAX_WIDTH}; use matmul_block")
            x = np.vstack(vals)
            g = x.T @ x
            acc = g if acc is None else acc + g
        if acc is not None:
            d = acc.shape[0]
            ii, jj = np.meshgrid(np.arange(d), np.arange(d), indexing="ij")
            yield pd.DataFrame({"i": ii.ravel(), "j": jj.ravel(), "v": acc.ravel()})

    return (rows.select(vec).mapInPandas(partial, CELL_SCHEMA)
            .groupBy("i", "j").agg(F.sum("v").alias("v")))


# Cells of a right factor that every task may hold (8 bytes each).
RIGHT_MAX_CELLS = 1 << 22


def _full_rows(width: int):
    """``(i, k, v)`` from ``(i, _k, _c)``: the cells of ``_c`` in a row of ``width``
    doubles, 0 where there is none.  Slices hold ``RIGHT_MAX_CELLS`` cells at most
    (one row at least)."""
    step = max(1, RIGHT_MAX_CELLS // max(width, 1))

    def run(batches):
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                lists = batch.column(2)
                count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                cells = lists.flatten()
                out = np.zeros((batch.num_rows, width))
                j, v = (x.to_numpy(zero_copy_only=False) for x in cells.flatten())
                met = cells.field(1).is_valid().to_numpy(zero_copy_only=False)
                out[np.repeat(np.arange(batch.num_rows), count), j] = np.where(met, v, 0.0)
                off = np.arange(batch.num_rows + 1, dtype=np.int32) * width
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1),
                     pa.ListArray.from_arrays(pa.array(off), pa.array(out.ravel()))],
                    names=["i", "k", "v"])

    return run


def matmul_rows(rows: DataFrame, b: DataFrame, vec: str = "vec") -> DataFrame:
    """``C = A B`` with ``A`` as rows ``(i, vec)`` and ``B`` as cells, by row blocks:
    ``(i, vec)`` with rows of ``C``.

    ``B`` is replicated to every task if it has at most ``RIGHT_MAX_CELLS``
    cells (counted first): each Arrow batch of rows is one product, nothing is
    shuffled.  A larger ``B`` goes through :func:`matmul_block` and the rows are
    put together again.  Either way the rows are doubles as wide as ``B``, 0
    where no cells meet, and a NULL row stays NULL.  Rows may differ in length:
    elements that a row lacks or that are NULL are missing cells, and elements
    beyond the rows of ``B`` meet nothing.  NaN and infinities meet stored cells
    only, as in the other products.
    """
    d = b.agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("i"), F.max("j").alias("j")).first()
    width = (d["j"] if d["j"] is not None else -1) + 1
    if d["n"] > RIGHT_MAX_CELLS or (d["n"] and (d["i"] + 1) * width > RIGHT_MAX_CELLS):
        cells = rows.select("i", F.posexplode(F.col(vec).cast("array<double>")).alias("j", "v"))
        product = matmul_block(cells.withColumn("j", F.col("j").cast("long")),
                               b.withColumn("v", F.col("v").cast("double")))
        found = product.groupBy("i").agg(F.collect_list(F.struct("j", "v")).alias("_c"))
        return rows.select(F.col("i").cast("long").alias("i"), F.col(vec).isNotNull().alias("_k")).join(
            found, "i", "left").mapInArrow(_full_rows(width), "i long, k boolean, v array<double>").select(
            "i", F.when(F.col("k"), F.col("v")).alias(vec))
    right = np.zeros(((d["i"] if d["i"] is not None else -1) + 1, width))
    stored = np.zeros(right.shape, bool)
    cells = _summed(b.select("i", "j", F.col("v").cast("double").alias("v"))).where(
        "v is not null").toArrow()
    at = cells.column("i").to_numpy(), cells.column("j").to_numpy()
    right[at], stored[at] = cells.column("v").to_numpy(), True
    ref = rows.sparkSession.sparkContext.broadcast((right, stored))
    step = max(1, RIGHT_MAX_CELLS // max(1, *right.shape))

    def multiply(batches):
        m, has = ref.value
        height, wide = m.shape
        for whole in batches:
            for lo in range(0, whole.num_rows, step):
                batch = whole.slice(lo, step)
                vecs, n = batch.column(1), batch.num_rows
                known = vecs.is_valid().to_numpy(zero_copy_only=False)
                size = vecs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = vecs.flatten()
                row = np.repeat(np.arange(n), size)
                k = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
                keep = (k < height) & flat.is_valid().to_numpy(zero_copy_only=False)
                left, valued = np.zeros((n, height)), np.zeros((n, height), bool)
                left[row[keep], k[keep]] = flat.to_numpy(zero_copy_only=False)[keep]
                valued[row[keep], k[keep]] = True
                out = _product(left, valued, m, has)[known]
                off = np.zeros(n + 1, np.int32)
                np.cumsum(known * wide, out=off[1:])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(
                        pa.array(off), pa.array(out.ravel()), mask=pa.array(~known))], names=["i", vec])

    return rows.select(F.col("i").cast("long").alias("i"),
                       F.col(vec).cast("array<double>").alias(vec)).mapInArrow(
        multiply, f"i long, {vec} array<double>")


def cells_to_rows(m: DataFrame, vec: str = "vec") -> DataFrame:
    """Coordinate cells -> ``(i, vec)`` rows in order of ``j`` (all cells stored).
    A group is one matrix row, bounded by the matrix width."""
    return (m.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "v"))).alias("_c"))
            .select("i", F.transform("_c", lambda s: s["v"]).alias(vec)))


# ---------------------------------------------------------------- comparison
def _differs(av, bv, tol: float):
    if tol == 0:
        return ~av.eqNullSafe(bv)
    return (av.isNull() != bv.isNull()) | (F.abs(av - bv) > F.lit(tol))


def matrix_diff(a: DataFrame, b: DataFrame, tol: float = 0.0,
                keys: tuple[str, ...] = ("i", "j"), value: str = "v") -> DataFrame:
    """Cells that differ: present on one side only, or ``|a - b| > tol``.

    ``tol = 0`` is exact, NULL-safe equality.  Output ``(*keys, a, b)``.
    A full outer join on the cell key (shuffled on the key, no hot group).
    """
    j = a.select(*keys, F.col(value).alias("a")).join(
        b.select(*keys, F.col(value).alias("b")), list(keys), "full_outer")
    return j.where(_differs(F.col("a"), F.col("b"), tol)).select(*keys, "a", "b")


def matrix_diff_blocks(a: DataFrame, b: DataFrame, tol: float = 0.0,
                       keys: tuple[str, ...] = ("i", "j"), value: str = "v",
                       block: int = 64) -> DataFrame:
    """The rows of :func:`matrix_diff`, by digests of blocks first.

    Each side is aggregated to one digest per block of ``block`` positions per
    axis; only cells of blocks whose digests differ are joined.  What is shuffled
    follows the blocks and the differing cells, not the matrix.
    """
    # Under a tolerance undefined cells differ from themselves.
    blocks = differing_blocks(a, b, keys, value, block, undefined_differ=tol != 0)
    return matrix_diff(only_blocks(a, blocks, keys, block), only_blocks(b, blocks, keys, block),
                       tol, keys, value)


def vector_add_colocated(a: DataFrame, b: DataFrame) -> DataFrame:
    """``vector_add`` of two tables in buckets by ``i`` (``colocated.bucketed``):
    no shuffle."""
    return colocated_join(a.withColumnRenamed("v", "av"), b.withColumnRenamed("v", "bv"), ["i"]).select(
        "i", (F.col("av") + F.col("bv")).alias("v"))


def matrix_diff_colocated(a: DataFrame, b: DataFrame, tol: float = 0.0,
                          keys: tuple[str, ...] = ("i", "j"), value: str = "v") -> DataFrame:
    """``matrix_diff`` of two tables in buckets by ``keys``: no shuffle."""
    j = colocated_join(a.select(*keys, F.col(value).alias("a")),
                       b.select(*keys, F.col(value).alias("b")), keys, "full_outer")
    return j.where(_differs(F.col("a"), F.col("b"), tol)).select(*keys, "a", "b")


def matrix_diff_summary(a: DataFrame, b: DataFrame, tol: float = 0.0,
                        keys: tuple[str, ...] = ("i", "j"), value: str = "v") -> DataFrame:
    """One row: cells compared, cells that differ, largest absolute difference."""
    j = a.select(*keys, F.col(value).alias("a")).join(
        b.select(*keys, F.col(value).alias("b")), list(keys), "full_outer")
    av, bv = F.col("a"), F.col("b")
    return j.agg(F.count(F.lit(1)).alias("n_cells"),
                 F.count(F.when(_differs(av, bv, tol), 1)).alias("n_diff"),
                 F.max(F.abs(av - bv)).alias("max_abs_diff"))
