"""A training-data pipeline over ``documents``.

``STAGES`` are applied in order; each works on all rows that the stage before
it kept.  All but the last return the columns of ``documents``.

One executor runs all stages, so what each holds adds up: every stage bounds the
batches of texts that its Python tasks get (``tuning.bound_text_batches``).
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, neardup, suffixdedup, toxicity
from tessera.llm.queries import bpe_files
from tessera.plans.joins import materialise
from tessera.plans.tuning import bound_text_batches

# Bytes of a repeated passage: at least some 50 words, of four bytes each.
PASSAGE_BYTES = 200


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _stage(fn):
    """``fn`` in a session whose batches of texts are bounded by bytes."""
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_text_batches(spark)
        return fn(spark, docs, sf_dir)

    return run


@_stage
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return toxicity.reject(docs, _read(spark, sf_dir, "labels"))


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, the one with the smallest
    id (shingles of five words, similarity 0.8 or more).  Every row is a node of
    its own: of rows that repeat an id and text one stays, and an id's other
    texts stand for themselves."""
    row_id = "row"
    while row_id in map(str.lower, docs.columns):
        row_id += "_"
    # Written, so that every read sees the same row numbers.
    rows = materialise(docs.select(F.monotonically_increasing_id().alias(row_id), "*"), "rows")
    near = materialise(neardup.near_duplicates(
        rows.select(F.col(row_id).alias("doc_id"), "text")).select(
        F.col("doc_id").alias(row_id), "component_id"), "near")
    # Of groups of one there is nothing to choose.
    groups = materialise(near.groupBy("component_id").agg(F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select("component_id"), "groups")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), row_id)
    members = materialise(near.join(groups, "component_id"), "near-members")
    members = materialise(members.join(rows.select(row_id, order.alias("o")), row_id), "near-order")
    first = members.groupBy("component_id").agg(F.min("o").alias("o")).select(f"o.{row_id}")
    gone = members.select(row_id).join(first, row_id, "left_anti")
    return rows.join(gone, row_id, "left_anti").select(*docs.columns)


@_stage
def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that repeat are cut out; a document of which nothing is left goes."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    cut = suffixdedup.suffix_dedup(docs, PASSAGE_BYTES, keep=others)
    cut = cut.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    whole = {"doc_id": F.col("doc_id"), "text": F.col("text"),
             "n_chars": F.char_length("text").cast("long")}
    return cut.select(*(whole.get(c, F.col(f"kept.`{c}`")).alias(c) for c in docs.columns))


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, _read(spark, sf_dir, "benchmark"))


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they
    decode to."""
    return bpe.encode(docs, **bpe_files())


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash_neardup", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

# The model of the first stage and the later similarity checks have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written before the next reads it."""
    docs = _read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
