"""Plan shape: pruning, pushdown, number of shuffles, join strategies."""

from conftest import SF01
from tessera.operators import cluster as cl
from tessera.operators import pixels as pxo
from tessera.operators import stencil
from tessera.plans.catalog import QUERIES
from tessera.sources import tables as tb


def _plan(df) -> str:
    df.collect()                          # runs this very query execution
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in text
    return text


def _static(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_uses_a_cartesian_product(spark):
    for name, fn in QUERIES.items():
        text = _static(fn(spark, SF01))
        assert "CartesianProduct" not in text, name


def test_projection_prunes_scan_columns(spark):
    text = _static(pxo.gray(tb.pixels8(spark, SF01)))
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in \
        QUERIES["gray"](spark, SF01)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Exchange" not in text


def test_filter_reaches_the_scan(spark):
    df = pxo.gray(tb.pixels8(spark, SF01)).where("image_id = 3")
    plan = _static(df.where(df.image_id == 3))
    # The predicate on a derived column runs right above the scan, before the
    # projection computes anything else.
    assert plan.index("Project") < plan.index("Filter") < plan.index("FileScan")
    pushed = tb.read_table(spark, SF01, "events").where("event_id = 17")
    assert "EqualTo(event_id,17)" in pushed._jdf.queryExecution().executedPlan().toString()


def test_sobel_shuffles_once(spark):
    g = pxo.gray(tb.pixels8(spark, SF01))
    for method in ("bands", "tiles", "scatter"):
        text = _static(stencil.sobel_x(g, method=method))
        assert text.count("Exchange") == 1, method


def test_exposure_bracket_has_no_join(spark):
    text = _static(pxo.exposure_bracket(tb.pixels8(spark, SF01)))
    assert "Join" not in text and "Exchange" not in text and "Generate" in text


def test_per_image_stats_are_broadcast_when_small(spark):
    text = _plan(QUERIES["tone_log"](spark, SF01))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_timing_statistics_are_partial_aggregates_over_all_runs(spark):
    df = QUERIES["timing_mean"](spark, SF01)
    assert "Window" not in _static(df)
    assert df.agg({"n_runs": "sum"}).first()[0] == 10000


def test_first_runs_limit_is_pushed_below_the_shuffle(spark):
    from tessera.operators import timings as tm

    assert "WindowGroupLimit" in _static(tm.number_runs(tb.timing_runs(spark, SF01), "event_id", 20))


def test_gram_shuffles_only_partials(spark):
    text = _static(QUERIES["matmul_gram"](spark, SF01))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_centre_assignment_is_join_free(spark):
    vals = tb.values(spark, SF01)
    assigned = cl.assign_nearest(vals, "v", [(0, 1.0), (1, 100.0), (2, 300.0)])
    assert "Join" not in _static(assigned)


def test_size_checked_joins_fall_back_to_shuffle_joins(spark):
    """With broadcasting disabled the per-image joins become shuffle joins and
    the results do not change (the path taken beyond the size check)."""
    from compare import compare, duckdb_views
    from tessera.plans.oracles import ORACLES

    con = duckdb_views(SF01)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("tone_log", "histeq_tonemap", "histeq_tonemap_holes", "tone_batch_params",
                     "lum_histogram", "lum_cdf", "hdr_promote"):
            df = QUERIES[name](spark, SF01)
            assert compare(df.toPandas(), con.sql(ORACLES[name]).df()) is None, name
            text = _plan(df)
            assert "BroadcastHashJoin" not in text and "Join" in text, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
