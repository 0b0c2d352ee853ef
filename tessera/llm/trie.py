"""Prefix trie of conversations, with balanced subtree sums.

1. Turns are numbered inside their conversation.  A prefix is known by the xor
   of the salted hashes of its turns (128 bits), taken over chunks of turns, so
   a conversation of any length is spread over many tasks.
2. Equal prefixes are one node; its parent is the prefix without the last turn.
3. Subtree sums come from a centroid decomposition of the parent edges.  A
   node's weight is the number of rows (conversation, prefix) in its subtree,
   which its members know without a rollup.  The centroid of a component is the
   deepest node that holds over half of its weight.  Cutting it leaves the
   subtrees of its children and the rest above, each at most half as heavy.  What
   the component holds from the centroid down is summed once and added to every
   node on the way from the centroid to the component's top.
4. Components are cut by joins, all heavy ones at once in each round, until none
   weighs over ``LIMIT``; these are decomposed inside tasks in the same way.
   The rounds grow with the logarithm of the rows, however deep the trie is.

Null roles and texts are empty; rows without a ``conv_id`` belong to no
conversation and are left out.  Rows of a conversation that tie in ``turn`` are in
the order of the digest of role and text.  Null turns come first.  Extra columns
are ignored.  No conversation gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.plans.joins import join_small, materialise
from tessera.plans.numbering import number_rows

CHUNK = 512               # turns of a conversation in one window
LIMIT = 1024              # weight, and so nodes, of a component inside a task
IDS = 4096                # ids of one piece of a list of ends

KEY, PARENT, COMP = ["a", "b"], ["pa", "pb"], ["ca", "cb"]


# --------------------------------------------------------------------- turns
def number_turns(conversations: DataFrame) -> DataFrame:
    """``conv, pos, turn_id, bytes``: place in the conversation from 0, digest of
    role and text, and UTF-8 bytes of the text."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn",
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("turn_id"),
        F.octet_length(text).cast("long").alias("bytes"))
    return number_rows(rows, ["turn", "turn_id"], ["conv"], name="pos").select(
        "conv", "pos", "turn_id", "bytes")


def prefixes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv, len, d, a, b, pa, pb, bytes``: every prefix of ``d`` turns of every
    conversation, ``d = 0`` included, as a written table.

    ``turns(conv, pos, turn_id, bytes)`` are dense in ``pos``; ``convs(conv, len)``
    has all conversations, those without a turn too.
    """
    def salted(name: str) -> Column:
        return F.xxhash64("pos", "turn_id", F.lit(name))

    chunk = F.floor(F.col("pos") / CHUNK).alias("chunk")
    t = turns.select("conv", "pos", "bytes", chunk, salted("a").alias("ha"), salted("b").alias("hb"))
    whole = t.groupBy("conv", "chunk").agg(F.bit_xor("ha").alias("xa"), F.bit_xor("hb").alias("xb"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("conv", "chunk", *(F.coalesce(F.bit_xor(f"x{k}").over(before), F.lit(0))
                                            .alias(f"x{k}") for k in "ab"))
    inside = Window.partitionBy("conv", "chunk").orderBy("pos")
    t = t.select("conv", "chunk", "pos", "bytes", "ha", "hb", *(
        F.bit_xor(f"h{k}").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias(f"i{k}")
        for k in "ab")).join(whole, ["conv", "chunk"])
    own = [F.col(f"i{k}").bitwiseXOR(F.col(f"x{k}")) for k in "ab"]
    t = t.select("conv", (F.col("pos") + 1).alias("d"), "bytes",
                 *(c.alias(k) for c, k in zip(own, KEY)),
                 *(c.bitwiseXOR(F.col(f"h{k}")).alias(f"p{k}") for c, k in zip(own, "ab")))
    t = t.join(convs.select("conv", "len"), "conv")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.select("conv", "len", zero.alias("d"), zero.alias("a"), zero.alias("b"),
                        none.alias("pa"), none.alias("pb"), zero.alias("bytes"))
    return materialise(root.unionByName(t), "prefixes")


def trie_nodes(rows: DataFrame) -> DataFrame:
    """One written row per distinct prefix: its key, parent's key, depth, smallest
    and number of members, bytes of the last text, weight, children."""
    nodes = rows.groupBy(*KEY).agg(
        F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("d").alias("depth"),
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"), F.sum(F.col("len") - F.col("d") + 1).alias("weight"))
    nodes = materialise(nodes, "nodes")
    children = nodes.where("depth > 0").groupBy(
        F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    return materialise(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "nodes")


# ---------------------------------------------------------------------- ends
def _pieces(batches):
    """Ids of each run of equal keys, joined, in order."""
    seq = 0
    for batch in batches:
        a, b, conv = (batch.column(c).to_numpy() for c in ("a", "b", "conv"))
        if not len(a):
            continue
        cut = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        first = np.concatenate(([0], cut))
        stop = np.append(cut, len(a))
        at = [x for s, e in zip(first.tolist(), stop.tolist()) for x in range(s, e, IDS)]
        ends = np.array([*at[1:], len(a)], np.int64)
        ends = np.minimum(ends, stop[np.searchsorted(stop, at, "right")])
        ids = list(map(str, conv.tolist()))
        text = [",".join(ids[s:e]) for s, e in zip(at, ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[at]), pa.array(b[at]), pa.array(batch.column("part").to_numpy()[at]),
             pa.array(np.arange(seq, seq + len(at))), pa.array(text, pa.string())],
            names=["a", "b", "part", "seq", "ids"])
        seq += len(at)


def _digests(batches):
    """SHA-256 over the pieces of each key, read in order."""
    key, h = None, None
    for batch in batches:
        out = []
        for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
            if (a, b) != key:
                if key is not None:
                    out.append((*key, h.hexdigest()))
                key, h = (a, b), hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield _columns(out, (pa.int64(), pa.int64(), pa.string()), ("a", "b", "ends_sha256"))
    if key is not None:
        yield _columns([(*key, h.hexdigest())], (pa.int64(), pa.int64(), pa.string()),
                       ("a", "b", "ends_sha256"))


def _columns(rows, kinds, names) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=list(names))


def end_digests(rows: DataFrame) -> DataFrame:
    """``a, b, ends_sha256`` per prefix at which conversations end: digest of their
    ids, ascending and joined by commas.  Ids are sorted and joined by range over
    all tasks; only the pieces of a prefix are read one after the other."""
    by = [*KEY, "conv"]
    ends = rows.where("d = len").select(*by).repartitionByRange(*by).sortWithinPartitions(*by)
    pieces = ends.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(
        _pieces, "a long, b long, part long, seq long, ids string")
    dealt = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "part", "seq")
    return dealt.mapInArrow(_digests, "a long, b long, ends_sha256 string")


# -------------------------------------------------------------------- rollup
def _decompose(parent: list[int], values: list[tuple]) -> list[list]:
    """Subtree sums of ``values`` over a tree or forest whose parents (-1: none)
    come before their children, by centroid decomposition."""
    n, k = len(parent), len(values[0]) if values else 0
    sums = [list(v) for v in values]
    children = [[] for _ in range(n)]
    for v, p in enumerate(parent):
        if p >= 0:
            children[p].append(v)
    alive = [True] * n
    size = [0] * n

    def below(v):                                     # what is left of a subtree, top first
        out = [v]
        for x in out:
            out.extend(c for c in children[x] if alive[c])
        return out
    todo = [v for v, p in enumerate(parent) if p < 0]
    while todo:
        top = todo.pop()
        part = below(top)
        for v in part:
            size[v] = 1
        for v in reversed(part[1:]):
            size[parent[v]] += size[v]
        c = top
        while True:
            heavy = [x for x in children[c] if alive[x] and 2 * size[x] > len(part)]
            if not heavy:
                break
            c = heavy[0]
        under = below(c)[1:]
        total = [values[c][i] + sum(values[v][i] for v in under) for i in range(k)]
        for i in range(k):                            # the centroid, cut before, keeps its own value
            sums[c][i] += total[i] - values[c][i]
        v = c
        while v != top:                               # and the way to the top
            v = parent[v]
            for i in range(k):
                sums[v][i] += total[i]
        alive[c] = False
        todo.extend(x for x in children[c] if alive[x])
        if c != top:
            todo.append(top)
    return sums


def _sums_in_tasks(values: list[str]):
    """Rows sorted by component and depth; a component is whole in its partition."""
    def run(batches):
        kept = None
        for batch in chain(batches, [None]):
            table = kept if batch is None else batch if kept is None else pa.concat_batches([kept, batch])
            if table is None or table.num_rows == 0:
                continue
            ca, cb = (table.column(c).to_numpy() for c in COMP)
            cut = np.flatnonzero((ca[1:] != ca[:-1]) | (cb[1:] != cb[:-1])) + 1
            stop = table.num_rows if batch is None else int(cut[-1]) if len(cut) else 0
            kept, table = table.slice(stop), table.slice(0, stop)
            keys = list(zip(*(table.column(c).to_pylist() for c in KEY)))
            ups = list(zip(*(table.column(c).to_pylist() for c in PARENT)))
            vals = list(zip(*(table.column(c).to_pylist() for c in values)))
            out = []
            edges = [0, *cut[cut < stop].tolist(), stop]
            for s, e in zip(edges, edges[1:]):
                at = {k: i for i, k in enumerate(keys[s:e])}
                out.extend(_decompose([at.get(p, -1) for p in ups[s:e]], vals[s:e]))
            sums = list(zip(*out)) or [()] * len(values)
            extra = [np.array(x, np.int64) + table.column(f"add_{c}").to_numpy()
                     for x, c in zip(sums, values)]
            yield pa.RecordBatch.from_arrays(
                [table.column("a"), table.column("b"), *map(pa.array, extra)], names=[*KEY, *values])
    return run


def subtree_sums(nodes: DataFrame, rows: DataFrame, values: list[str], limit: int = LIMIT) -> DataFrame:
    """``a, b`` and the sums of the ``values`` columns (long) over the subtree of
    each node.  ``nodes`` as from ``trie_nodes``, ``rows`` as from ``prefixes``."""
    added = [f"add_{c}" for c in values]
    zero = F.lit(0).cast("long")
    state = nodes.select(*KEY, *PARENT, "conv", F.col("depth").alias("d"), F.col("weight").alias("w"),
                         *values, *(zero.alias(c) for c in added),
                         zero.alias("ca"), zero.alias("cb"))
    state = materialise(state, "state")               # a join on a constant would be a cross join
    done, small = [], []
    while True:
        heavy = materialise(state.groupBy(*COMP).agg(F.max("w").alias("total"), F.min("d").alias("top_d"))
                            .where(F.col("total") > limit), "heavy")
        if heavy.limit(1).count() == 0:
            small.append(state)
            break
        tagged = join_small(state, heavy, COMP, how="left", written=True)
        tagged = materialise(tagged, "components")
        small.append(tagged.where("total is null").select(*state.columns))
        big = tagged.where("total is not null")
        cut = big.where(2 * F.col("w") > F.col("total")).groupBy(*COMP).agg(
            F.max_by(F.struct("a", "b", "conv", "d", "w", "top_d"), "d").alias("c"))
        cut = materialise(cut.select(*COMP, *(F.col(f"c.{x}").alias(f"c_{x}") for x in
                                              ("a", "b", "conv", "d", "w", "top_d"))), "centroids")
        # Conversations that pass a centroid, and the child by which they go on.
        under = join_small(rows.select("conv", "a", "b", *PARENT), cut.select(
            *COMP, F.col("c_a").alias("pa"), F.col("c_b").alias("pb"), F.col("c_d").alias("under_d")),
            PARENT).select(*COMP, "conv", F.col("a").alias("na"), F.col("b").alias("nb"), "under_d")
        # A component may meet a conversation at one centroid only.
        big = big.join(under, [*COMP, "conv"], "left")
        big = join_small(big, cut.select(*COMP, "c_a", "c_b"), COMP)
        is_cut = (F.col("a") == F.col("c_a")) & (F.col("b") == F.col("c_b"))
        is_under = F.coalesce(F.col("d") > F.col("under_d"), F.lit(False))
        big = materialise(big.select(*state.columns, is_cut.alias("is_cut"), is_under.alias("is_under"),
                                     "na", "nb"), "cut")
        totals = materialise(big.where("is_cut or is_under").groupBy(*COMP).agg(
            *(F.sum(c).alias(f"t_{c}") for c in values)), "totals")
        cut = materialise(cut.join(totals, COMP), "centroids")
        # The way from each centroid to the top of its component.
        way = join_small(rows.select("conv", "d", *KEY), cut.select(
            F.col("c_conv").alias("conv"), "c_d", "c_top_d", F.col("c_w").alias("less"),
            *(f"t_{c}" for c in values)), "conv")
        way = way.where((F.col("d") < F.col("c_d")) & (F.col("d") >= F.col("c_top_d"))).select(
            *KEY, "less", *(f"t_{c}" for c in values))
        kept = big.where("not is_cut").join(way, KEY, "left")
        whole = join_small(big.where("is_cut"), cut.select(*COMP, *(f"t_{c}" for c in values)), COMP)
        done.append(materialise(whole.select(*KEY, *(
            (F.col(f"add_{c}") + F.col(f"t_{c}")).alias(c) for c in values)), "sums"))
        state = materialise(kept.select(
            *KEY, *PARENT, "conv", "d", (F.col("w") - F.coalesce("less", zero)).alias("w"), *values,
            *((F.col(f"add_{c}") + F.coalesce(f"t_{c}", zero)).alias(f"add_{c}") for c in values),
            F.when(F.col("is_under"), F.col("na")).otherwise(F.col("ca")).alias("ca"),
            F.when(F.col("is_under"), F.col("nb")).otherwise(F.col("cb")).alias("cb")), "state")
    flat = small[0]
    for s in small[1:]:
        flat = flat.unionByName(s)
    flat = flat.repartition(*COMP).sortWithinPartitions(*COMP, "d")
    schema = "a long, b long, " + ", ".join(f"`{c}` long" for c in values)
    out = flat.select(*COMP, *KEY, *PARENT, *values, *added).mapInArrow(_sums_in_tasks(values), schema)
    for d in done:
        out = out.unionByName(d)
    return out


def prefix_trie(turns: DataFrame, convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie over ``turns(conv, pos, turn_id, bytes)`` of the
    conversations ``convs(conv, len)``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves`` (childless nodes in the subtree), ``saved_tokens``
    (over the subtree, bytes of the last text times members but one) and
    ``ends_sha256`` (ids of the conversations that end here).
    """
    rows = prefixes(turns, convs)
    nodes = trie_nodes(rows)
    valued = nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes")})
    sums = materialise(subtree_sums(valued, rows, ["n_leaves", "saved_tokens"], limit), "sums")
    parents = nodes.where("n_children > 0").select(
        F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv").alias("parent_conv_id"))
    out = nodes.join(sums, KEY).join(materialise(end_digests(rows), "ends"), KEY, "left").join(
        parents, PARENT, "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
                      "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def regroup(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: the first ``h`` turns of conversation
    ``c - c % group``, then the own turns of ``c`` after its first ``h``, where ``h``
    is the unsigned CRC-32 of ``c`` modulo ``most``.  Returns ``(turns, convs)``."""
    turns = materialise(turns, "turns")
    lens = materialise(turns.groupBy("conv").agg((F.max("pos") + 1).alias("n")), "lengths")
    convs = lens.select("conv", "n", (F.col("conv") - F.col("conv") % group).alias("base"),
                        (F.crc32(F.col("conv").cast("string")) % most).alias("h"))
    of = lens.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    shared = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = materialise(convs.join(of, "base", "left").select(
        "conv", "base", "h", shared.alias("m"),
        (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "convs")
    first = turns.where(F.col("pos") < most).select(
        F.col("conv").alias("base"), "pos", "turn_id", "bytes")
    head = first.join(convs.select("conv", "base", "m"), "base").where("pos < m").select(
        "conv", "pos", "turn_id", "bytes")
    tail = turns.join(convs.select("conv", "h", "m"), "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "turn_id", "bytes")
    return head.unionByName(tail), convs.select("conv", "len")
