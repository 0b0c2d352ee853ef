"""Merkle manifest of a document table: a content-addressed DAG and its proofs.

1. A row's leaf is the digest of its fields.  Leaves of one source ascend by
   ``doc_id``; runs of three nodes become their digest until one node, the
   subroot, remains.  The subroots, in order of their sources, give the root in
   the same way.
2. The DAG is stored as digest -> children records, packed in segments of
   ``LEVELS`` levels (at most 364 records) under the digest of their top.  A
   tree of any size is built by a few aggregations, one per ``LEVELS`` levels.
3. A request for a leaf descends from the root: the digits of its rank pick a
   child in each record, the unselected children are collected, and the
   digest reached leads to the next segment.  Requests that share a way down
   go together until their segments part.
4. The collected steps, reversed, are the proof: the siblings from the leaf up.

Ranks come from range-partitioned numbering, so a source that holds most rows is
spread over many tasks; no group is larger than a segment.  Nulls in any column
have a leaf of their own (``-``).  A null source and a null ``doc_id`` come
first in their order.  Rows that repeat a ``doc_id`` are leaves of their own,
in the order of their digests.  A text counts in full, however long; an empty
one is not null.  Extra columns are ignored.  An empty table has no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.plans.joins import join_small, materialise
from tessera.plans.numbering import number_rows

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
LEVELS = 6
WIDTH = ARITY ** LEVELS   # leaves of a segment

RECORDS = "array<struct<digest: binary, children: array<binary>>>"
PATH = "array<struct<place: int, siblings: array<string>>>"


# -------------------------------------------------------------------- leaves
def field(c: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of the fields of a row; ``changed`` replaces columns by name."""
    return F.sha2(F.concat(*(field(changed.get(c, F.col(c))) for c in FIELDS)), 256)


def _digest(children: Iterable[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


# --------------------------------------------------------------------- build
def _segment(nodes: list[bytes], levels: int | None):
    """Top of the tree over ``nodes``, its levels and its records; ``levels``
    levels, or until one node remains."""
    records, n = {}, 0
    while len(nodes) > 1 if levels is None else n < levels:
        runs = [nodes[i:i + ARITY] for i in range(0, len(nodes), ARITY)]
        nodes = [_digest(r) for r in runs]
        records.update(zip(nodes, runs))
        n += 1
    return nodes[0], n, records


SEGMENTS = f"tree long, seg long, digest binary, levels int, records {RECORDS}"
_SEGMENTS = pa.schema([
    ("tree", pa.int64()), ("seg", pa.int64()), ("digest", pa.binary()), ("levels", pa.int32()),
    ("records", pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])))])


def _packed(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            last = r["nodes"] <= WIDTH                # the only segment left of its tree
            nodes = [x["digest"] for x in sorted(r["items"], key=lambda x: x["at"])]
            top, n, records = _segment(nodes, None if last else LEVELS)
            out.append({"tree": r["tree"], "seg": r["seg"], "digest": top, "levels": n, "records": [
                {"digest": d, "children": c} for d, c in records.items()]})
        yield pa.RecordBatch.from_pylist(out, schema=_SEGMENTS)


def build(items: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Trees over ``items(tree, at, digest)``, dense in ``at`` per tree.

    Returns the written segments ``(tree, seg, digest, levels, records)`` of
    each pass from the leaves up, and the tops ``(tree, digest, level)`` with
    the pass of their segment.  A lone node is its own top, without records.
    """
    passes, tops = [], []
    sizes = materialise(items.groupBy("tree").agg(F.count(F.lit(1)).alias("nodes")), "sizes")
    while True:
        grouped = items.groupBy("tree", F.floor(F.col("at") / WIDTH).alias("seg")).agg(
            F.collect_list(F.struct("at", "digest")).alias("items"))
        segments = materialise(join_small(grouped, sizes, "tree", written=True)
                               .mapInArrow(_packed, SEGMENTS), "segments")
        passes.append(segments)
        sizes = materialise(sizes.select("tree", F.ceil(F.col("nodes") / WIDTH).alias("nodes")), "sizes")
        nodes = join_small(segments.select("tree", "seg", "digest"), sizes, "tree", written=True)
        tops.append(nodes.where("nodes = 1").select(
            "tree", "digest", F.lit(len(passes) - 1).alias("level")))
        sizes = materialise(sizes.where("nodes > 1"), "sizes")
        if sizes.limit(1).count() == 0:
            break
        items = nodes.where("nodes > 1").select("tree", F.col("seg").alias("at"), "digest")
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return passes, materialise(out, "tops")


# ------------------------------------------------------------------- descent
def _walk(records: dict, node: bytes, levels: int, rank: int):
    """Steps ``(place, siblings)`` from ``node`` down to its leaf ``rank``, by the
    digits of the rank."""
    steps = []
    for level in range(levels - 1, -1, -1):
        children = records[node]
        place = rank // ARITY ** level % ARITY
        steps.append((place, [c.hex() for i, c in enumerate(children) if i != place]))
        node = children[place]
    return steps, node


def _lists(values: pa.Array, counts: list[int]) -> pa.ListArray:
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), values)


def _descended(payload: list[str]):
    """From segments with the requests that reached them, one row per request:
    the node it reaches and its path so far, the lowest step first."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                row = one.drop_columns(["wanted"]).to_pylist()[0]
                wanted = one.column("wanted").flatten()
                records = {r["digest"]: r["children"] for r in row["records"]}
                above = [(s["place"], s["siblings"]) for s in row["path"]]
                digests, lengths, places, counts, siblings = [], [], [], [], []
                for at in wanted.field("at").to_pylist():
                    steps, node = _walk(records, row["digest"], row["levels"], at % WIDTH)
                    digests.append(node)
                    steps = steps[::-1] + above
                    lengths.append(len(steps))
                    for place, others in steps:
                        places.append(place)
                        counts.append(len(others))
                        siblings.extend(others)
                steps = pa.StructArray.from_arrays(
                    [pa.array(places, pa.int32()), _lists(pa.array(siblings, pa.string()), counts)],
                    names=["place", "siblings"])
                n = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["tree"]] * n, pa.int64()), *(wanted.field(c) for c in payload),
                     pa.array(digests, pa.binary()), _lists(steps, lengths),
                     pa.array([row["subroot"]] * n, pa.binary()),
                     pa.array([row["root"]] * n, pa.binary())],
                    names=["tree", *payload, "digest", "path", "subroot", "root"])
    return run


def descend(passes: list[DataFrame], heads: DataFrame, wanted: DataFrame) -> DataFrame:
    """Paths of the leaves ``wanted(tree, at, ...)`` below the tops ``heads(tree,
    digest, level, path, subroot, root)``.

    Returns the columns of ``wanted`` with ``digest`` (the leaf reached),
    ``path`` (steps ``place, siblings`` from the leaf up; the path of the head
    ends it), ``subroot`` and ``root`` of the head.
    """
    segment = F.floor(F.col("at") / WIDTH).alias("seg")
    asked = [wanted.select(*wanted.columns, segment)]
    for _ in passes[1:]:                              # the segments that lie on the way
        asked.append(asked[-1].select("tree", F.col("seg").alias("at")).distinct()
                     .select("tree", "at", segment))
    reached = None
    for level in range(len(passes) - 1, -1, -1):
        open_ = heads.where(F.col("level") == level).select(
            "tree", F.lit(0).cast("long").alias("seg"), "digest", "path", "subroot", "root")
        if reached is not None:
            open_ = open_.unionByName(reached.withColumnRenamed("at", "seg"))
        payload = [c for c in asked[level].columns if c not in ("tree", "seg")]
        requests = asked[level].groupBy("tree", "seg").agg(
            F.collect_list(F.struct(*payload)).alias("wanted"))
        store = passes[level].groupBy("digest").agg(  # equal segments are stored once
            F.max_by(F.struct("levels", "records"), "levels").alias("s")).select(
            "digest", "s.levels", "s.records")
        ready = open_.join(requests, ["tree", "seg"]).join(store, "digest").select(
            "tree", "digest", "levels", "records", "wanted", "path", "subroot", "root")
        kinds = dict(asked[level].dtypes)
        schema = ", ".join(["tree long", *(f"`{c}` {kinds[c]}" for c in payload),
                            f"digest binary, path {PATH}, subroot binary, root binary"])
        reached = ready.mapInArrow(_descended(payload), schema)
        if level:
            reached = materialise(reached, "reached")
    return reached


# --------------------------------------------------------------------- proofs
def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf digest and its path."""
    def step(node, s):
        others = s["siblings"]
        return F.sha2(F.concat(
            F.array_join(F.slice(others, F.lit(1), s["place"]), ""), node,
            F.array_join(F.slice(others, s["place"] + 1, F.size(others)), "")), 256)
    return F.aggregate(path, leaf, step)


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: s["siblings"])), ""), 256)


@dataclass
class Manifest:
    """``leaves(tree, at, ...)``, the segments of the trees of the sources and of
    the tree over their subroots, and the tops of both."""

    leaves: DataFrame
    passes: list[DataFrame]
    subroots: DataFrame
    top_passes: list[DataFrame]
    root: DataFrame


def manifest(docs: DataFrame, **extra: Column) -> Manifest:
    """Build the DAG over the rows of ``docs``.  ``extra`` columns are kept with
    the leaves (``source, doc_id, leaf``, and ``tree, at`` for their place)."""
    leaves = docs.select("source", "doc_id", leaf_digest().alias("leaf"),
                         *(c.alias(k) for k, c in extra.items()))
    leaves = materialise(number_rows(leaves, ["doc_id", "leaf"], ["source"], name="at", dense="tree"),
                         "leaves")
    passes, subroots = build(leaves.select("tree", "at", F.unhex("leaf").alias("digest")))
    # Written: a join on a constant would become a cross join.
    tops, root = build(materialise(subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), "digest"), "subroots"))
    return Manifest(leaves, passes, subroots, tops, root)


def prove(m: Manifest, wanted: DataFrame) -> DataFrame:
    """``wanted``, rows of ``m.leaves``, with the hex digests ``subroot`` and
    ``root`` and the ``path`` from the leaf up to the root."""
    head = m.root.select("tree", "digest", "level", F.array().cast(PATH).alias("path"),
                         F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    trees = materialise(wanted.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at")).distinct(), "trees")
    heads = descend(m.top_passes, head, trees).select(
        F.col("at").alias("tree"), "digest", "path", F.col("digest").alias("subroot"), "root")
    heads = materialise(heads.join(m.subroots.select("tree", "level"), "tree"), "heads")
    keep = wanted.select("tree", "at", *(c for c in wanted.columns if c not in ("tree", "at")))
    return descend(m.passes, heads, keep).select(
        *wanted.columns, "path", F.lower(F.hex("subroot")).alias("subroot"),
        F.lower(F.hex("root")).alias("root"))


def verify(proofs: DataFrame, leaf: str) -> DataFrame:
    """``proofs`` with ``folded_root``, recomputed from the column ``leaf`` and
    the siblings, and whether it is the ``root``."""
    folded = proofs.withColumn("folded_root", fold(F.col(leaf), F.col("path")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
