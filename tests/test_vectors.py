"""k-means over vectors against NumPy: bounds, undefined points, ties, skew."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from tessera.operators import vectors


def brute(points, k, iterations, seed=42):
    """Lloyd without bounds on ``[(id, vector)]``."""
    order = sorted(points, key=lambda p: (hashlib.md5(f"{p[0]}:{seed}".encode()).hexdigest(), p[0]))
    centres = np.array([v for _, v in order[:k]], float)
    x = np.array([v for _, v in points], float)
    for step in range(iterations + 1):
        d = np.sqrt(((x[:, None] - centres[None]) ** 2).sum(-1))
        cid = d.argmin(1)
        if step < iterations:
            for c in range(len(centres)):
                if (cid == c).any():
                    centres[c] = x[cid == c].mean(0)
    return centres, {p[0]: (int(c), float(r.min())) for p, c, r in zip(points, cid, d)}


def blobs(n, dim=6, hot=0.34):
    """Points around ten places, a share of them at one place."""
    g = np.random.default_rng(5)
    places = g.normal(0, 20, (10, dim))
    at = np.where(g.random(n) < hot, 0, g.integers(0, 10, n))
    return [(i, v) for i, v in enumerate((places[at] + g.normal(0, 1, (n, dim))).tolist())]


@pytest.mark.parametrize("k,iterations", [(1, 2), (7, 0), (12, 6)])
def test_equals_lloyd_without_bounds(spark, k, iterations):
    pts = blobs(1500)
    df = spark.createDataFrame(pts, "id long, vec array<double>").repartition(5)
    got, model = vectors.kmeans_vectors(df, k, iterations)
    centres, want = brute(pts, k, iterations)
    assert model.centres == pytest.approx(centres)
    rows = got.collect()
    assert len(rows) == len(pts)
    for r in rows:
        assert r.cid == want[r.id][0] and r.dist == pytest.approx(want[r.id][1])


def test_bounds_save_distances(spark):
    df = spark.createDataFrame(blobs(3000), "id long, vec array<double>")
    _, model = vectors.kmeans_vectors(df, 10, 6)
    full = model.points * 10
    assert model.distances[0] == full
    assert all(n < full for n in model.distances[1:])
    assert sum(model.distances[1:]) < 0.7 * full * 5


def test_undefined_points_ties_and_repeated_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [2.0, 0.5]),
            (4, None), (5, [nan, 0.0]), (6, [inf, 0.0]), (7, [None, 0.0]), (8, [])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    got, model = vectors.kmeans_vectors(df, 50, 0)
    rows = got.collect()
    assert len(rows) == 10 and len(model.centres) == 5    # every point is a centre
    assert {r.id for r in rows if r.cid is None} == {4, 5, 6, 7, 8}
    same = [r.cid for r in rows if r.id == 3]
    assert same[0] == same[1] == min(np.flatnonzero((model.centres == [1.0, 0.0]).all(1)))
    assert all(r.dist == 0 for r in rows if r.cid is not None)


def test_empty_clusters_keep_their_centre(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(6)], "id long, vec array<double>")
    got, model = vectors.kmeans_vectors(df, 3, 2)
    assert (model.centres == 1).all() and {r.cid for r in got.collect()} == {0}


def test_empty_table_and_bad_input(spark):
    none = spark.createDataFrame([], "id string, vec array<float>")
    got, model = vectors.kmeans_vectors(none, 3, 2)
    assert got.collect() == [] and model.points == 0
    mixed = spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], "id string, vec array<float>")
    with pytest.raises(ValueError):
        vectors.kmeans_vectors(mixed, 2, 1)
    with pytest.raises(ValueError):
        vectors.kmeans_vectors(mixed, 0, 1)


def test_no_shuffle_of_points(spark):
    emb = spark.read.parquet(f"{SF01}/embeddings.parquet")
    got, _ = vectors.kmeans_vectors(emb, 8, 1, id="vec_id", vec="embedding")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert got.where(F.col("cid").isNull()).count() == 0
