"""One-dimensional clustering of values (luminance) and k-means tone mapping.

Data stays distributed: values are first reduced to a histogram ``(v, n)``
(partial + final aggregation), the model is at most ``k`` centres on the
driver (as in any k-means), and assigning a value to its nearest centre is a
binary search over the sorted centres (``log2(k)`` comparisons per row,
JVM-side, with no join and no shuffle).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import pixel as px
from tessera.plans.joins import join_small, materialise

# Fixed values of the k-means tone map: clusters and Lloyd iterations.
KMEANS_TONE_K = 256
KMEANS_TONE_ITERATIONS = 5


def value_histogram(df: DataFrame, value: str, keys: tuple[str, ...] = (),
                    out: str = "v") -> DataFrame:
    """``(*keys, out, n)``: how many rows carry each distinct value."""
    return df.groupBy(*keys, F.col(value).alias(out)).agg(F.count(F.lit(1)).alias("n"))


def grid_centres(spark: SparkSession, values: DataFrame, k: int, value: str = "v") -> DataFrame:
    """``k`` initial centres evenly spread over ``[min, max]`` of the data:
    ``lo + (hi - lo) * (cid + 0.5) / k``.  ``min``/``max`` come from one
    aggregation (one row to the driver)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    r = defined_only(values, value).agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    lo, hi = F.lit(r["lo"]).cast("double"), F.lit(r["hi"]).cast("double")
    cid = F.col("id").cast("int")
    return spark.range(k).select(
        cid.alias("cid"), (lo + (hi - lo) * (cid + F.lit(0.5)) / F.lit(k)).alias("c"))


def defined_only(values: DataFrame, value: str = "v") -> DataFrame:
    """Rows whose value is neither NULL nor NaN: what a model is fitted on."""
    v = F.col(value)
    return values.where(v.isNotNull() & ~F.isnan(v.cast("double")))


def _sorted_unique(centres: list[tuple[int, float]]) -> list[tuple[float, int]]:
    best: dict[float, int] = {}
    for cid, c in centres:
        if c is None:
            continue
        c = float(c)
        best[c] = min(cid, best.get(c, cid))
    return sorted((c, cid) for c, cid in best.items())


def _dlit(x: float) -> str:
    """Exact SQL double literal for a finite float."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def assign_nearest(df: DataFrame, value: str, centres: list[tuple[int, float]],
                   out: str = "cid", leaf_values: dict[int, float] | None = None) -> DataFrame:
    """Add ``out``: the id of the centre nearest to ``value`` (ties: smaller id),
    or ``leaf_values[id]`` when given.

    The sorted centres are the splits of a JVM binary search (MLlib's
    ``Bucketizer``); the nearest centre is one of the two bracketing the
    value, picked by ``least(struct(distance, id))``.  The generated code does
    not depend on the centre values, so iterating with new centres reuses it.
    """
    from pyspark.ml.feature import Bucketizer

    pts = _sorted_unique(centres)
    if not pts:
        raise ValueError("no centres")
    cs = [c for c, _ in pts]
    ids = [cid for _, cid in pts]
    res = ids if leaf_values is None else [leaf_values[i] for i in ids]
    n = len(cs)
    bucket = f"__bucket_{out}"
    splits = [float("-inf")] + cs + [float("inf")]
    b = Bucketizer(splits=splits, inputCol=value, outputCol=bucket,
                   handleInvalid="keep").transform(df)
    arr_c = F.expr("array(" + ", ".join(_dlit(c) for c in cs) + ")")
    arr_id = F.expr("array(" + ", ".join(str(int(i)) for i in ids) + ")")
    k = F.col(bucket).cast("int")
    lo = F.greatest(k, F.lit(1))
    hi = F.least(k + 1, F.lit(n))
    v = F.col(value)
    best = F.least(
        F.struct(F.abs(v - F.element_at(arr_c, lo)).alias("d"), F.element_at(arr_id, lo).alias("i"),
                 lo.alias("p")),
        F.struct(F.abs(v - F.element_at(arr_c, hi)).alias("d"), F.element_at(arr_id, hi).alias("i"),
                 hi.alias("p")))
    if leaf_values is None:
        chosen = best["i"]
    else:
        arr_res = F.expr("array(" + ", ".join(_dlit(x) for x in res) + ")")
        chosen = F.element_at(arr_res, best["p"])
    return b.withColumn(out, F.when(v.isNull() | F.isnan(v), None).otherwise(chosen)).drop(bucket)


def _collect_centres(centres: DataFrame) -> list[tuple[int, float]]:
    # At most k rows: the model, not the data.
    return [(int(r[0]), r[1]) for r in centres.select("cid", "c").collect()]


def nearest_centre(values: DataFrame, centres: DataFrame, value: str = "v") -> DataFrame:
    """Add ``cid``, the nearest centre of each value."""
    return assign_nearest(values, value, _collect_centres(centres))


def cluster_weighted_mean(assigned: DataFrame, value: str = "v",
                          weight: str = "squared") -> DataFrame:
    """Mean value per cluster from a histogram ``(v, n, cid)``.

    ``weight="squared"`` weights a distinct value by ``n^2`` (each of its
    ``n`` occurrences is weighted by its count, as in the original
    tone-mapping script); ``weight="count"`` is the ordinary mean.
    """
    n = F.col("n").cast("double")
    w = n * n if weight == "squared" else n
    if weight not in ("squared", "count"):
        raise ValueError("weight must be 'squared' or 'count'")
    return assigned.where("cid is not null").groupBy("cid").agg(
        (F.sum(w * F.col(value)) / F.sum(w)).alias("mean"))


def lloyd(values: DataFrame, centres: DataFrame, iterations: int, value: str = "v",
          persist: bool = True) -> DataFrame:
    """Weighted Lloyd iterations on a histogram ``(v, n)`` from given centres.

    The histogram is written once to the checkpoint folder (``persist``) so
    that iterations re-read it instead of recomputing its lineage; each
    iteration is then one aggregation job.  An empty cluster keeps its
    centre.  Returns ``(cid, c)``.
    """
    if iterations < 0:
        raise ValueError("iterations must be >= 0")
    spark = values.sparkSession
    values = defined_only(values, value)
    if persist and iterations > 0:
        values = materialise(values.select(value, "n"), "histogram")
    cur = dict(_collect_centres(centres))
    n = F.col("n").cast("double")
    for _ in range(iterations):
        upd = (assign_nearest(values.select(F.col(value).alias("v"), n.alias("n")), "v",
                              list(cur.items()))
               .groupBy("cid").agg((F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("c"))
               .collect())
        for r in upd:
            cur[int(r["cid"])] = r["c"]
    rows = sorted(cur.items())
    return spark.createDataFrame(rows, "cid int, c double")


# ------------------------------------------------------------ k-means tone map
def kmeans_centres(hist: DataFrame, k: int, iterations: int, seed: int,
                   value: str = "v") -> list[tuple[int, float]]:
    """Fit MLlib k-means (random init) on the weighted histogram."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    feats = VectorAssembler(inputCols=[value], outputCol="features").transform(
        hist.select(F.col(value).cast("double").alias(value), F.col("n").cast("double").alias("n")))
    model = KMeans(k=k, initMode="random", maxIter=iterations, seed=seed,
                   weightCol="n", featuresCol="features").fit(feats)
    return [(cid, float(c[0])) for cid, c in enumerate(model.clusterCenters())]


# Values are hashed as integers on this grid for the random start.
HASH_GRID = float(1 << 20)


def start_order(value, seed: int):
    """Pseudo-random order of values: the MD5 of ``floor(v * 2^20):seed``, so that
    any SQL engine draws the same start."""
    grid = F.floor(value * F.lit(HASH_GRID)).cast("string")
    return F.md5(F.concat(grid, F.lit(f":{seed}")).cast("binary"))


def random_centres(values: DataFrame, k: int, seed: int, value: str = "v") -> DataFrame:
    """``k`` distinct values picked at random (seeded): the ``k`` first in
    ``start_order``, ties by value.  A distributed top-k: each task keeps ``k``
    rows, and the pick does not change when a task is retried."""
    if k < 1:
        raise ValueError("k must be >= 1")
    picked = (values.select(F.col(value).alias("c"))
              .orderBy(start_order(F.col("c"), seed), "c").limit(k).collect())
    spark = values.sparkSession
    return spark.createDataFrame([(i, r["c"]) for i, r in enumerate(picked)], "cid int, c double")


def fit_centres(hist: DataFrame, k: int, iterations: int, seed: int,
                method: str = "lloyd", value: str = "v",
                init: str = "random") -> list[tuple[int, float]]:
    """k-means centres of a weighted 1-D histogram: initial centres
    (``init="random"``: seeded pick of distinct values; ``"grid"``: evenly
    spread over the value range), then ``iterations`` Lloyd steps
    (``method="mllib"`` runs MLlib's random-init KMeans instead)."""
    if method == "mllib":
        return kmeans_centres(hist, k, iterations, seed, value)
    if method != "lloyd":
        raise ValueError("method must be 'lloyd' or 'mllib'")
    if init == "random":
        start = random_centres(hist, k, seed, value)
    elif init == "grid":
        start = grid_centres(hist.sparkSession, hist, k, value)
    else:
        raise ValueError("init must be 'random' or 'grid'")
    cents = lloyd(hist, start, iterations, value, persist=False)
    return _collect_centres(cents)


def kmeans_tonemap(hdr: DataFrame, k: int = KMEANS_TONE_K,
                   iterations: int = KMEANS_TONE_ITERATIONS, seed: int = 42,
                   weight: str = "squared", method: str = "lloyd",
                   init: str = "random") -> DataFrame:
    """Compress luminance to ``k`` levels and rescale B, G, R by new/old luminance.

    One codebook is fitted over the luminance histogram of the whole table
    (for a single image this is the per-image algorithm): random initial
    centres and ``iterations`` Lloyd steps, like MLlib's random-init k-means
    (``method="mllib"`` runs MLlib itself).  The new level of a
    cluster is the weighted mean of its values.  The final pass is one
    projection: the search returns the cluster mean directly.
    Output ``(image_id, y, x, b, g, r)``; black pixels (luminance 0) and pixels
    with an undefined sample get NULL.
    """
    lum = hdr.select("image_id", "y", "x", "b", "g", "r", px.luminance().alias("lum"))
    # Iterative fitting re-reads the histogram: write it once (lineage cut).
    hist = materialise(value_histogram(defined_only(lum, "lum"), "lum"), "lum-histogram")
    if hist.limit(1).count() == 0:                    # nothing defined to fit on
        return hdr.select("image_id", "y", "x",
                          *[F.lit(None).cast("double").alias(c) for c in ("b", "g", "r")])
    centres = fit_centres(hist, k, iterations, seed, method, init=init)
    assigned = assign_nearest(hist, "v", centres)
    means = {int(r["cid"]): r["mean"] for r in
             cluster_weighted_mean(assigned, weight=weight).collect()}  # <= k rows
    mapped = assign_nearest(lum, "lum", [(c, x) for c, x in centres if c in means],
                            out="new_lum", leaf_values=means)
    scale = px.safe_div(F.col("new_lum"), F.col("lum"))
    return mapped.select("image_id", "y", "x",
                         *[(F.col(c) * scale).alias(c) for c in ("b", "g", "r")])


# ------------------------------------------------------ per-image k-means
# Rows of one image that a task takes at once; a larger image is dealt over several.
ROWS_PER_PART = 200_000


def _parts(counts: DataFrame, rows: int) -> DataFrame:
    """``(image_id, parts)`` from ``(image_id, n)``: into how many parts an
    image's rows are dealt."""
    return counts.select("image_id", (F.floor((F.col("n") - 1) / F.lit(rows)) + 1).alias("parts"))


def _dealt(df: DataFrame, parts: DataFrame) -> DataFrame:
    """``df`` with a part number below its image's ``parts``."""
    return join_small(df, parts, "image_id", "left", written=True).withColumn(
        "part", F.pmod(F.xxhash64(*df.columns), F.coalesce("parts", F.lit(1)))).drop("parts")


def _arrays(centres: DataFrame, parts: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Per image and part the centres ``(image_id, part, cs array<struct<c, cid, ...>>)``:
    at most ``k`` per image, in order of value and id."""
    packed = centres.where("c is not null").groupBy("image_id").agg(
        F.sort_array(F.collect_list(F.struct("c", "cid", *more))).alias("cs"))
    return packed.join(parts, "image_id").select(
        "image_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        "cs")


def _nearest(values: np.ndarray, centres: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Position of the nearest of the sorted centres (ties: smaller id).  Of
    equal centres the first has the smallest id."""
    first = np.ones(len(centres), bool)
    first[1:] = centres[1:] != centres[:-1]
    at = np.flatnonzero(first)
    c, i = centres[at], ids[at]
    hi = np.clip(np.searchsorted(c, values, "right"), 1, max(len(c) - 1, 1))
    hi = np.minimum(hi, len(c) - 1)
    lo = np.maximum(hi - 1, 0)
    dl, dh = np.abs(values - c[lo]), np.abs(values - c[hi])
    low = (dl < dh) | ((dl == dh) & (i[lo] <= i[hi]))
    return at[np.where(low, lo, hi)]


def _search(left: pa.Table, right: pa.Table, value: str):
    """Values of a part as an array, and the place of each one's centre."""
    v = left.column(value).to_numpy(zero_copy_only=False).astype(float)
    cs = right.column("cs").combine_chunks().flatten()
    c = cs.field("c").to_numpy(zero_copy_only=False)
    cid = cs.field("cid").to_numpy(zero_copy_only=False)
    return v, cs, cid, _nearest(v, c, cid)


def _partial_sums(dealt: DataFrame, arrays: DataFrame, squared: bool = False) -> DataFrame:
    """``(image_id, cid, nv, n)`` summed inside each part, then over parts."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return pa.table({"image_id": pa.array([], pa.int64()), "cid": pa.array([], pa.int32()),
                             "nv": pa.array([], pa.float64()), "n": pa.array([], pa.float64())})
        v, _, cid, at = _search(left, right, "v")
        n = left.column("n").to_numpy().astype(float)
        w = n * n if squared else n
        k = len(cid)
        hit = np.flatnonzero(np.bincount(at, minlength=k))
        return pa.table({
            "image_id": pa.array([left.column("image_id")[0].as_py()] * len(hit), pa.int64()),
            "cid": pa.array(cid[hit].astype(np.int32)),
            "nv": pa.array(np.bincount(at, weights=w * v, minlength=k)[hit]),
            "n": pa.array(np.bincount(at, weights=w, minlength=k)[hit])})

    sums = dealt.groupBy("image_id", "part").cogroup(arrays.groupBy("image_id", "part")).applyInArrow(
        run, "image_id long, cid int, nv double, n double")
    return sums.groupBy("image_id", "cid").agg(F.sum("nv").alias("nv"), F.sum("n").alias("n"))


def per_image_centres(hist: DataFrame, k: int, iterations: int, seed: int = 42,
                      init: str = "grid") -> DataFrame:
    """k-means per image on a histogram ``(image_id, v, n)``: ``(image_id, cid, c)``.

    Initial centres per image are spread evenly over the image's value range
    (``init="grid"``) or are ``k`` seeded random distinct values (a per-image
    top-k with a partial limit before the shuffle).  Undefined values are left
    out.
    """
    return _fit_per_image(_prepared(hist), k, iterations, seed, init)[0]


def _prepared(hist: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per-image ranges, parts, and the dealt histogram, all written once."""
    hist = materialise(defined_only(hist).withColumn("image_id", F.col("image_id").cast("long")),
                       "histogram")
    ranges = materialise(hist.groupBy("image_id").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n")), "ranges")
    parts = materialise(_parts(ranges, ROWS_PER_PART), "parts")
    return ranges, parts, materialise(_dealt(hist, parts), "dealt-histogram")


def _fit_per_image(prepared, k: int, iterations: int, seed: int, init: str):
    """Centres, and the prepared tables.  A Lloyd step sends each image's sorted
    centres (at most ``k``) to the parts of its histogram, finds every value's
    centre by binary search there, and shuffles partial sums only."""
    if k < 1 or iterations < 0:
        raise ValueError("k must be >= 1 and iterations >= 0")
    ranges, parts, dealt = prepared
    if init == "grid":
        cid = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cid")
        cents = ranges.select("image_id", "lo", "hi", cid).select(
            "image_id", "cid",
            (F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("cid") + F.lit(0.5)) / F.lit(k))
            .alias("c"))
    elif init == "random":
        w = Window.partitionBy("image_id").orderBy(start_order(F.col("v"), seed), "v")
        cents = (dealt.select("image_id", "v", F.row_number().over(w).alias("r"))
                 .where(F.col("r") <= k)
                 .select("image_id", (F.col("r") - 1).cast("int").alias("cid"), F.col("v").alias("c")))
    else:
        raise ValueError("init must be 'grid' or 'random'")
    cents = materialise(cents, "centres")
    for _ in range(iterations):
        sums = _partial_sums(dealt, _arrays(cents, parts))
        # New centre = weighted mean of its values; an empty cluster keeps its centre.
        cents = materialise(cents.join(sums, ["image_id", "cid"], "left").select(
            "image_id", "cid", F.coalesce(F.col("nv") / F.col("n"), F.col("c")).alias("c")), "centres")
    return cents, prepared


def kmeans_tonemap_per_image(hdr: DataFrame, k: int = KMEANS_TONE_K,
                             iterations: int = KMEANS_TONE_ITERATIONS, seed: int = 42,
                             init: str = "grid", weight: str = "squared") -> DataFrame:
    """k-means luminance compression with one codebook per image.

    Pixels are dealt in parts of bounded size like the histogram; each part gets
    its image's sorted centres with their new levels and looks its pixels up by
    binary search.  Every pixel keeps its row; pixels with an undefined sample
    and black ones get NULL.
    """
    lum = hdr.select(F.col("image_id").cast("long").alias("image_id"), "y", "x", "b", "g", "r",
                     px.luminance().alias("lum"))
    hist = value_histogram(defined_only(lum, "lum"), "lum", keys=("image_id",))
    cents, prepared = _fit_per_image(_prepared(hist), k, iterations, seed, init)
    _, parts, dealt = prepared
    if weight not in ("squared", "count"):
        raise ValueError("weight must be 'squared' or 'count'")
    sums = _partial_sums(dealt, _arrays(cents, parts), weight == "squared")
    levels = materialise(cents.join(sums, ["image_id", "cid"]).select(
        "image_id", "cid", "c", (F.col("nv") / F.col("n")).alias("mean")), "levels")
    px_parts = materialise(_parts(lum.groupBy("image_id").agg(F.count(F.lit(1)).alias("n")),
                                  ROWS_PER_PART), "parts")
    arrays = _arrays(levels, px_parts, ("mean",))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        level = np.full(n, np.nan)
        v = left.column("lum").to_numpy(zero_copy_only=False).astype(float)
        ok = np.flatnonzero(~np.isnan(v))
        if right.num_rows and len(ok):
            _, cs, _, at = _search(left.take(pa.array(ok)), right, "lum")
            level[ok] = cs.field("mean").to_numpy(zero_copy_only=False)[at]
        return left.select(["image_id", "y", "x", "b", "g", "r", "lum"]).append_column(
            "level", pa.array(level, mask=np.isnan(level)))

    found = _dealt(lum, px_parts).groupBy("image_id", "part").cogroup(
        arrays.groupBy("image_id", "part")).applyInArrow(
        run, "image_id long, y int, x int, b double, g double, r double, lum double, level double")
    scale = px.safe_div(F.col("level"), F.col("lum"))
    kind = dict(hdr.dtypes)["image_id"]
    return found.select(F.col("image_id").cast(kind).alias("image_id"), "y", "x",
                        *[(F.col(c) * scale).alias(c) for c in ("b", "g", "r")])
