"""k-means over vectors (Lloyd) with distance bounds kept between steps.

The points stay distributed; the model (``k`` centres) is all that reaches the
driver.  Every step is one pass without a shuffle of points: tasks read the
written state ``(id, vec, cid, upper, lower)``, move the bounds by how far the
centres went, and measure only the points whose bounds no longer prove that
their centre is the nearest.  Distances of those are block products per Arrow
batch.  New centres are sums made inside the tasks: at most ``k * dim`` cells per
task are shuffled, so a cluster that holds most points is no hot key.

Points that are NULL or hold a NULL, NaN or infinite element belong to no cluster
(``cid`` and ``dist`` NULL) and move no centre.  Ties go to the smaller centre id;
an empty cluster keeps its centre; fewer points than ``k`` give fewer centres.
Rows that repeat an id are points of their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.plans.joins import materialise

_CELLS = 1 << 20          # distances measured at once in a task
_TIE = 1e-9               # share within which block products do not decide
_STATE = "id {id}, vec {vec}, cid int, upper double, lower double, cost long"


@dataclass
class VectorModel:
    """Centres (row = centre id) and distances measured per step; a step without
    bounds measures ``points * k``."""

    centres: np.ndarray
    points: int = 0
    distances: list[int] = field(default_factory=list)


def defined_vectors(points: DataFrame, vec: str = "vec"):
    """Whether a vector is there and all its elements are finite numbers."""
    inf = float("inf")
    return F.coalesce(F.forall(vec, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(inf)), F.lit(False))), F.lit(False)) & (F.size(vec) > 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of a batch in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(-1, dim)


def first_centres(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """``k`` points in the order of the MD5 of ``id:seed``, ties by id: a
    distributed top-k that does not change when a task is retried."""
    order = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")).cast("binary"))
    rows = points.orderBy(order, "id", "vec").limit(k).select("vec").collect()
    return np.array([r["vec"] for r in rows], float)


def _direct(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - c) ** 2).sum(-1))


def two_nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(nearest centre, its distance, a lower bound of all others)`` per row."""
    near = np.empty(len(x), np.int64)
    upper, lower = np.empty(len(x)), np.full(len(x), np.inf)
    cc = (centres ** 2).sum(1)
    step = max(1, _CELLS // len(centres))
    for a in range(0, len(x), step):
        part = x[a:a + step]
        xx = (part ** 2).sum(1)
        d2 = np.maximum(xx[:, None] + cc - 2 * (part @ centres.T), 0)
        slack = _TIE * (xx + cc.max())
        best = d2.argmin(1)
        row = np.arange(len(part))
        close = d2 <= (d2[row, best] + slack)[:, None]
        for i in np.flatnonzero(close.sum(1) > 1):    # the products cannot decide
            at = np.flatnonzero(close[i])
            best[i] = at[_direct(part[i], centres[at]).argmin()]
        near[a:a + step] = best
        upper[a:a + step] = _direct(part, centres[best])
        if len(centres) > 1:
            d2[row, best] = np.inf
            lower[a:a + step] = np.sqrt(np.maximum(d2.min(1) - slack, 0))
    return near, upper, lower


def _advance(batch: pa.RecordBatch, centres: np.ndarray, drift: np.ndarray) -> pa.RecordBatch:
    """The state of a batch for centres that moved by ``drift`` since it was made."""
    n, (k, dim) = batch.num_rows, centres.shape
    x = _matrix(batch.column(1), dim)
    cid = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
    upper = batch.column(3).to_numpy(zero_copy_only=False) + drift[np.maximum(cid, 0)]
    lower = batch.column(4).to_numpy(zero_copy_only=False) - drift.max()
    half = np.full(k, np.inf)
    if k > 1:
        for a in range(k):
            d = _direct(centres, centres[a])
            d[a] = np.inf
            half[a] = d.min() / 2
    cost = np.zeros(n, np.int64)
    safe = lambda: upper * (1 + _TIE) < np.maximum(lower, half[np.maximum(cid, 0)])
    known = cid >= 0
    open_ = np.flatnonzero(known & ~safe())
    upper[open_] = _direct(x[open_], centres[cid[open_]])
    cost[open_] += 1
    todo = np.flatnonzero(~known | ~safe())
    cid, lower = cid.copy(), lower.copy()
    if len(todo):
        cid[todo], upper[todo], lower[todo] = two_nearest(x[todo], centres)
        cost[todo] += k
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(cid.astype(np.int32)), pa.array(upper),
         pa.array(lower), pa.array(cost)], names=["id", "vec", "cid", "upper", "lower", "cost"])


def _step(state: DataFrame, centres: np.ndarray, drift: np.ndarray, schema: str) -> DataFrame:
    ref = state.sparkSession.sparkContext.broadcast((centres, drift))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield _advance(batch, *ref.value)
    return state.mapInArrow(run, schema)


def _sums(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sum and number of the points of each cluster, and the distances measured."""
    def run(batches):
        total, n, cost = np.zeros((k, dim)), np.zeros(k, np.int64), 0
        for batch in batches:
            cid = batch.column(1).to_numpy(zero_copy_only=False)
            x = _matrix(batch.column(0), dim)
            order = np.argsort(cid, kind="stable")
            unit, first = np.unique(cid[order], return_index=True)
            if len(unit):
                total[unit] += np.add.reduceat(x[order], first, axis=0)
            n += np.bincount(cid, minlength=k)
            cost += int(batch.column(2).to_numpy(zero_copy_only=False).sum())
        full = np.flatnonzero(n)
        cid = np.concatenate([np.repeat(full, dim), full, [-1]])
        j = np.concatenate([np.tile(np.arange(dim), len(full)), np.full(len(full) + 1, -1)])
        v = np.concatenate([total[full].ravel(), np.zeros(len(full) + 1)])
        count = np.concatenate([np.zeros(len(full) * dim, np.int64), n[full], [cost]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(cid.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(v),
             pa.array(count.astype(np.int64))], names=["cid", "j", "v", "n"])

    got = (state.select("vec", "cid", "cost").mapInArrow(run, "cid int, j int, v double, n long")
           .groupBy("cid", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).toArrow())
    cid, j, v, n = (got.column(c).to_numpy() for c in ("cid", "j", "v", "n"))
    total, size = np.zeros((k, dim)), np.zeros(k, np.int64)
    cell, one = j >= 0, (j < 0) & (cid >= 0)
    total[cid[cell], j[cell]] = v[cell]
    size[cid[one]] = n[one]
    return total, size, int(n[cid < 0].sum())


def kmeans_vectors(points: DataFrame, k: int, iterations: int, seed: int = 42,
                   id: str = "id", vec: str = "vec") -> tuple[DataFrame, VectorModel]:
    """``(id, cid, dist)`` per row of ``points`` after ``iterations`` Lloyd steps from
    ``k`` seeded points, and the model.  Vectors must be of one length."""
    if k < 1 or iterations < 0:
        raise ValueError("k must be >= 1 and iterations >= 0")
    rows = points.select(F.col(id).alias("id"), F.col(vec).alias("vec"))
    if rows.schema["vec"].dataType.simpleString() != "array<float>":   # floats stay short
        rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))
    rows = rows.withColumn("ok", defined_vectors(rows))
    undefined = rows.where("not ok").select("id", F.lit(None).cast("int").alias("cid"),
                                            F.lit(None).cast("double").alias("dist"))
    start = rows.where("ok").select(
        "id", "vec", F.lit(-1).alias("cid"), F.lit(float("inf")).alias("upper"),
        F.lit(0.0).alias("lower"), F.lit(0).cast("long").alias("cost"))
    state = materialise(start, "vectors")
    seen = state.agg(F.min(F.size("vec")).alias("a"), F.max(F.size("vec")).alias("b"),
                     F.count(F.lit(1)).alias("n")).first()
    if seen["n"] == 0:
        return undefined, VectorModel(np.empty((0, 0)))
    if seen["a"] != seen["b"]:
        raise ValueError(f"vectors of {seen['a']} and of {seen['b']} elements")
    schema = _STATE.format(**{c: rows.schema[c].dataType.simpleString() for c in ("id", "vec")})
    centres = first_centres(state.select("id", "vec"), k, seed)
    k, dim = centres.shape
    model, drift = VectorModel(centres, seen["n"]), np.zeros(k)
    for _ in range(iterations):
        state = materialise(_step(state, centres, drift, schema), "vectors")
        total, size, cost = _sums(state, k, dim)
        new = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
        centres, drift = new, _direct(new, centres)
        model.distances.append(cost)
    model.centres = centres
    ref = state.sparkSession.sparkContext.broadcast((centres, drift))

    def final(batches):
        for batch in batches:
            if batch.num_rows:
                out = _advance(batch, *ref.value)
                x = _matrix(out.column(1), dim)
                dist = _direct(x, ref.value[0][out.column(2).to_numpy()])
                yield pa.RecordBatch.from_arrays([out.column(0), out.column(2), pa.array(dist)],
                                                 names=["id", "cid", "dist"])

    kinds = "id {id}, cid int, dist double".format(id=rows.schema["id"].dataType.simpleString())
    return state.mapInArrow(final, kinds).unionByName(undefined), model


def centre_cells(spark, model: VectorModel) -> DataFrame:
    """The centres as ``(cid, j, c)`` (``k * dim`` rows)."""
    return spark.createDataFrame([(i, j, float(x)) for (i, j), x in np.ndenumerate(model.centres)],
                                 "cid int, j int, c double")
