"""MinHash near-dedup with bottom-k sketches of one hash function.

1. A document's shingle set is hashed once; the ``k`` smallest values are its
   sketch.  Documents with equal sets form a class, later steps use one
   representative per class.
2. Inverted lists hold the retained values.  Similar documents share most of
   their sketch, so only the rarest values of a sketch need a list: any two
   sketches with the required overlap share one of them.  Values in one sketch
   only need no list at all.  That keeps passages shared by otherwise different
   documents out of the lists.  Documents that stay in a list get lists again
   from their whole sets, from which the loose ones fall out.
3. An entry of a list knows how many values its document can share at most with
   a partner first met in this list.  Pairs whose sizes ask for more are not
   compared.
4. Candidates of a list are compared with pivots, never all with all: first one
   pivot, then, while a list holds several components, more pivots from
   outside its largest component, more in each round.  A list ends when the
   pairs that were not compared lie in one component or cannot be links, so no
   link between different components is lost.
5. A candidate pair passes if the union sketch estimates a similarity near the
   threshold, and becomes a link if the full sets confirm it exactly.
6. Links are contracted to components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm import textops as tx
from tessera.llm.components import components
from tessera.plans.joins import materialise

SHINGLE_WORDS = 5
SIMILARITY = (80, 100)    # 100 * intersection >= 80 * union
SKETCH = 32               # values of a sketch
SIGMAS = 5                # standard deviations allowed to sketch overlaps and estimates
PIVOT_GROWTH = 8          # pivots per list and round grow by this factor
PARITY = ("p0", "p1", "p2", "p3")   # longs of a set's parity bits


def needed_overlap(similarity, k: int) -> float:
    """Share of a ``k``-value sketch that linked documents have in common, less
    ``SIGMAS`` standard deviations.  Of the ``k`` smallest values of the union a
    share of the similarity is in both sketches, whatever the sizes of the sets;
    if one set contains the other there are no more."""
    j = similarity[0] / similarity[1]
    return max(0.0, j - SIGMAS * (j * (1 - j) / k) ** 0.5)


def _shingles(part, data, off, n):
    start, end, doc = tx.word_spans(data, off)
    h, d = tx.shingle_hash(tx.span_hash(data, start, end), doc, n)
    return tx.doc_distinct(h, d)


def sketches(docs: DataFrame, n: int = SHINGLE_WORDS, k: int = SKETCH) -> DataFrame:
    """``doc_id, n_shingles, f1, f2, sketch``: set size, a 128-bit fingerprint
    of the set and its ``k`` smallest hashes in order.  No words: empty set."""
    def run(batches):
        for part, data, off in tx.pieces(batches):
            h, d = _shingles(part, data, off, n)
            size = np.bincount(d, minlength=part.num_rows)
            first = np.zeros(part.num_rows + 1, np.int64)
            np.cumsum(size, out=first[1:])
            kept = h[(np.arange(len(h)) - first[d]) < k] if len(h) else h
            prints = []
            for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                total = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(tx.mix(h ^ np.uint64(salt)), out=total[1:])
                prints.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size, pa.int64()), *map(pa.array, prints),
                 tx.lists(kept.view(np.int64), np.minimum(size, k), pa.int64())],
                names=["doc_id", "n_shingles", "f1", "f2", "sketch"])

    return _narrow(docs).mapInArrow(
        run, "doc_id long, n_shingles long, f1 long, f2 long, sketch array<long>")


def full_sets(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, hashes`` and the columns ``PARITY``: the whole shingle set in
    order, and for each of 256 cells of hashes whether it holds an odd number of
    them."""
    def run(batches):
        for part, data, off in tx.pieces(batches):
            h, d = _shingles(part, data, off, n)
            odd = np.zeros((part.num_rows, len(PARITY)), np.uint64)
            at = ((h >> np.uint64(6)) % np.uint64(len(PARITY))).astype(np.int64)
            np.bitwise_xor.at(odd, (d, at), np.uint64(1) << (h & np.uint64(63)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), tx.lists(h.view(np.int64), np.bincount(d, minlength=part.num_rows),
                                          pa.int64()),
                 *(pa.array(np.ascontiguousarray(odd[:, i]).view(np.int64))
                   for i in range(len(PARITY)))], names=["doc_id", "hashes", *PARITY])

    return _narrow(docs).mapInArrow(
        run, "doc_id long, hashes array<long>, " + ", ".join(f"{p} long" for p in PARITY))


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


_NO_CAP = 1 << 40


def inverted_lists(docs: DataFrame, similarity, k: int | None) -> DataFrame:
    """``(value, doc, size, cap)`` from ``(doc, size, sketch)`` with sketches of
    ``k`` values (None: whole sets): each sketch's rarest values that other
    sketches hold.

    Of ``m`` values the ``m - ceil(share * m) + 1`` rarest (ties by value) are
    kept.  ``share`` is the similarity itself where both sketches of any link
    are whole sets, otherwise ``needed_overlap``.  ``cap`` is the number of
    values from this one on: what the document can share with a partner whose
    first common value this is.
    """
    num, den = similarity
    # A whole set whose every possible partner is one too.
    whole = F.lit(True) if k is None else F.col("size") * den <= F.lit(num * k)
    share = 0.0 if k is None else needed_overlap(similarity, k)
    values = docs.select("doc", "size", F.size("sketch").alias("m"),
                         F.explode("sketch").alias("value"))
    # Written first: a join of two shuffled tables is one whose hot keys Spark splits.
    shared = materialise(values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                         "shared-values")
    own = (values.join(shared, "value").groupBy("doc", "size", "m")
           .agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("s")))
    alone = F.col("m") - F.size("s")                  # values that no other sketch holds
    least = F.when(whole, F.floor((F.col("m") * num + (den - 1)) / F.lit(den))).otherwise(
        F.ceil(F.col("m") * F.lit(share)))
    prefix = F.greatest(F.col("m") - least + 1 - alone, F.lit(0)).cast("int")
    own = own.select("doc", "size", whole.alias("whole"), (F.col("m") - alone).alias("left"),
                     F.slice("s", 1, prefix).alias("s"))
    own = own.select("doc", "size", "whole", "left", F.posexplode("s").alias("at", "x"))
    cap = F.when(F.col("whole"), F.col("left") - F.col("at")).otherwise(F.lit(_NO_CAP))
    return own.select(F.col("x.value").alias("value"), "doc", "size",
                      cap.cast("long").alias("cap"))


def _enough(similarity, cap, a, b):
    """Whether ``cap`` common values can make sets of sizes ``a``, ``b`` a link."""
    num, den = similarity
    return cap * (num + den) >= (a + b) * num


def _near(similarity, a, b, ours, theirs):
    """Whether sets of sizes ``a``, ``b`` whose parity bits differ in as many
    places as ``ours`` and ``theirs`` can be a link."""
    num, den = similarity
    apart = sum(F.bit_count(F.col(x).bitwiseXOR(F.col(y))) for x, y in zip(ours, theirs))
    return apart * (num + den) <= (a + b) * (den - num)


def _live(state: DataFrame, similarity, group: str) -> DataFrame:
    """Entries of lists with different ``group`` values, without entries that
    cannot link even to the smallest member."""
    by = state.groupBy("value").agg(F.min("size").alias("ms"), F.min(group).alias("lo"),
                                    F.max(group).alias("hi")).where("lo != hi")
    by = materialise(by.select("value", "ms"), "open-lists")
    return state.join(by, "value").where(
        _enough(similarity, F.col("cap"), F.col("size"), F.col("ms"))).drop("ms")


def confirm(pairs: DataFrame, sets: DataFrame, similarity=SIMILARITY, k: int = SKETCH) -> DataFrame:
    """The pairs ``(u, v)`` that are links.  Both joins are on a document id; a
    pivot of many pairs is split by the adaptive skew join."""
    a = sets.select(F.col("doc_id").alias("u"), F.col("hashes").alias("a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("hashes").alias("b"))
    num, den = similarity
    both = pairs.join(a, "u").join(b, "v")
    sa, sb = F.slice("a", 1, k), F.slice("b", 1, k)
    union = F.slice(F.sort_array(F.array_union(sa, sb)), 1, k)
    common = F.size(F.array_intersect(F.array_intersect(sa, sb), union))
    estimate = common / F.size(union)
    j = num / den
    near = both.where(estimate >= F.lit(j - SIGMAS * (j * (1 - j) / k) ** 0.5))
    inter = F.size(F.array_intersect("a", "b"))
    return near.where(den * inter >= num * (F.size("a") + F.size("b") - inter)).select("u", "v")


def link_components(lists: DataFrame, sets: DataFrame, similarity=SIMILARITY,
                    k: int = SKETCH) -> DataFrame:
    """``(node, component)`` over the links of all candidate pairs; None if there
    is no candidate."""
    parity = sets.select(F.col("doc_id").alias("doc"), *PARITY)
    rest = materialise(_live(lists, similarity, "doc").join(parity, "doc"), "live-lists")
    links, comp, pivots = None, None, 1
    while True:
        state = rest.withColumn("c", F.col("doc"))
        if comp is not None:
            state = rest.join(comp, rest["doc"] == comp["node"], "left").select(
                *rest.columns, F.coalesce("component", "doc").alias("c"))
        state = materialise(_live(state, similarity, "c"), "lists")
        if state.limit(1).count() == 0:
            return comp
        outside = state
        if links is not None:
            sizes = state.groupBy("value", "c").agg(F.count(F.lit(1)).alias("n"))
            largest = sizes.groupBy("value").agg(F.max_by("c", F.struct("n", "c")).alias("big"))
            outside = state.join(materialise(largest, "largest"), "value").where("c != big")
        # Pivots with the fewest values of their own come first: central documents.
        by = Window.partitionBy("value").orderBy((F.col("cap") / F.col("size")).desc(), "doc")
        chosen = materialise(outside.withColumn("r", F.row_number().over(by)).where(
            F.col("r") <= pivots).select("value", F.col("doc").alias("u"), F.col("c").alias("cu"),
                                         F.col("size").alias("su"), F.col("cap").alias("capu"),
                                         *(F.col(p).alias(f"u{p}") for p in PARITY)),
            "pivots")
        can = (_enough(similarity, F.least("cap", "capu"), F.col("size"), F.col("su"))
               & _near(similarity, F.col("size"), F.col("su"), PARITY, [f"u{p}" for p in PARITY]))
        pairs = (state.join(chosen, "value").where((F.col("c") != F.col("cu")) & can)
                 .select(F.least("u", "doc").alias("u"), F.greatest("u", "doc").alias("v")).distinct())
        more = confirm(pairs, sets, similarity, k)
        links = materialise(more if links is None else links.union(more), "links")
        comp = components(links)
        rest = materialise(state.drop("c").join(
            chosen.select("value", F.col("u").alias("doc")), ["value", "doc"], "left_anti"), "lists")
        pivots *= PIVOT_GROWTH


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, similarity=SIMILARITY,
                    k: int = SKETCH) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``n_shingles`` is the size of the document's set, ``component_id`` the
    smallest ``doc_id`` reachable over links, ``kept`` whether that is the
    document itself.  Null or blank texts have an empty set and stay alone.  A
    null ``doc_id`` takes no part and is its own (null) component, kept.
    Repeated ids are one node.  Extra columns are ignored.
    """
    sk = materialise(sketches(docs, n, k), "sketches")
    solid = sk.where("n_shingles > 0 and doc_id is not null")
    classes = materialise(solid.groupBy("f1", "f2", "n_shingles").agg(
        F.min("doc_id").alias("rep")), "classes")
    # Repeated ids with different texts tie their classes together.
    member = solid.select("doc_id", "f1", "f2", "n_shingles").join(
        classes, ["f1", "f2", "n_shingles"]).select("doc_id", "rep").distinct()
    member = materialise(member, "members")
    reps = solid.join(member.where("doc_id = rep").select("doc_id"), "doc_id", "left_semi").select(
        F.col("doc_id").alias("doc"), F.col("n_shingles").alias("size"), "sketch")
    rough = materialise(inverted_lists(reps, similarity, k), "rough-lists")
    wanted = _live(rough, similarity, "doc").select(F.col("doc").alias("doc_id")).distinct()
    sets = materialise(full_sets(
        docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), n), "sets")
    deeper = sets.select(F.col("doc_id").alias("doc"), F.size("hashes").cast("long").alias("size"),
                         F.col("hashes").alias("sketch"))
    lists = materialise(inverted_lists(deeper, similarity, None), "lists")
    comp = link_components(lists, sets, similarity, k)
    if comp is None:
        comp = member.where("false").select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    again = member.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = member.join(again.select("doc_id"), "doc_id", "left_semi")
    node = member.join(comp, member["rep"] == comp["node"], "left").select(
        "doc_id", F.coalesce("component", "rep").alias("c"))
    if ties.limit(1).count():                         # repeated ids with different texts
        top = components(node.select(F.col("doc_id").alias("u"), F.col("c").alias("v")))
        node = node.select("doc_id").distinct().join(
            top, F.col("doc_id") == F.col("node"), "left").select(
            "doc_id", F.coalesce("component", "doc_id").alias("c"))
    out = sk.select("doc_id", "n_shingles").join(node, "doc_id", "left")
    own = F.coalesce("c", "doc_id")
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      (F.col("doc_id").eqNullSafe(own)).alias("kept"))
