import pytest

import corpus_pipeline
from conftest import SF001, SF01
from tessera.llm.queries import ORACLES, QUERIES
from llm_fixtures import *  # noqa: F401,F403


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    compare = pytest.importorskip("compare")
    df, rel = QUERIES[name](spark, SF01).toPandas(), compare.duckdb_views(SF01).sql(ORACLES[name]).df()
    assert compare.compare(df[list(rel.columns)], rel) is None


def test_pipeline_equals_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        rows = docs.collect()
        assert {r.doc_id for r in rows} <= ids
        ids = {r.doc_id for r in rows}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert all(r.n_chars == len(r.text) for r in rows)
            docs = spark.createDataFrame(rows, docs.schema)
    run = corpus_pipeline.run(spark, SF001).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in run) == sorted((r.doc_id, r.ids_sha256) for r in rows)


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF001).columns == docs.columns
            stage(spark, docs, SF001).collect()


def test_repeated_rows_leave_one_copy(spark, tmp_path, words):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    twice = next(r for r in docs.collect() if r.n_chars >= 1000 and r.doc_id in {
        x.doc_id for x in corpus_pipeline.run(spark, SF001).collect()})
    docs.union(spark.createDataFrame([twice], docs.schema)).write.parquet(
        str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    ids = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert ids.count(twice.doc_id) == 1


def test_every_row_is_a_node_of_the_near_duplicate_stage(spark, words):
    a, b, c = words(200), words(200), words(200)
    rows = [(1, a), (7, a), (7, b), (8, c), (8, c), (None, words(200)), (9, None)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], DOCS)
    got = corpus_pipeline.drop_near_duplicates(spark, df.repartition(3), "").collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == sorted(
        (d or 0, t or "") for d, t in [rows[0], rows[2], rows[3], rows[5], rows[6]])


def test_columns_named_like_the_stage_s_own(spark, words):
    text = words(200)
    df = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, text, "en", "s", len(text))], DOCS)
    for name in ("row_number", "row", "Row", "component_id", "o"):
        docs = df.selectExpr("*", f"0 as `{name}`")
        got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
        assert got.columns == docs.columns and [r.doc_id for r in got.collect()] == [1]
