"""SimHash near-dedup by a grid join over segment bit counts.

1. A document's fingerprint has a bit for each bit that is set in over half of
   its shingle hashes (shingles with repeats; XXH64, seed 42).
2. Equal fingerprints are one node.  Each fingerprint is mapped to the bit
   counts of its 32 segments of two bits.  The Manhattan distance of two count
   vectors is never more than the number of bits that differ.
3. Grid join: of two vectors within distance 3, the parts of one half are within
   distance 1.  So each half is a grid whose cells are the 16 counts of that
   half; a fingerprint stands in its own cell and visits the cells in which one
   count is larger by one.  Of any two with distance 1 in a half, one visits the
   cell of the other.
4. A crowded cell is split: its members meet again by the counts of the other
   half's quarters, of which one is within distance 1.  What is crowded still is
   compared block against block, each pair of blocks in a task of its own.
5. In a cell every member is compared with all others by the Manhattan
   distance, then by the bits themselves.  Found links are contracted to a
   forest before they leave the task, so a group of thousands of close
   fingerprints gives fewer rows than it has members.
6. The forests are contracted to components.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.plans.joins import materialise

SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 3              # the grid's pigeonhole bounds hold for three bits
CROWDED = 1024            # members of a cell that are compared in one task

_ODD = 0x5555555555555555


# -------------------------------------------------------------- fingerprints
def _hashes(text: str, n: int) -> np.ndarray:
    """XXH64 of every shingle of a text, in order."""
    words = text.encode().lower().split()             # ASCII letters, ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    k = max(len(words) - n + 1, 1)
    spans = zip(start[:k].tolist(), end[-k:].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, k)


def _majority(h: np.ndarray) -> int:
    """Bits that are set in over half of the values."""
    votes = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):               # bounded memory for any text
        raw = h[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(raw, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` per row: the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for batch in batches:
            prints = np.fromiter((_majority(_hashes(t or "", n)) for t in
                                  batch.column("text").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, fp long")


def fingerprint_text(fp: Column) -> Column:
    """Sixteen lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# ---------------------------------------------------------------------- grid
def unary_counts(fp: Column) -> Column:
    """Bit counts of the two-bit segments in unary: 0, 1, 2 as 00, 01, 11.  Bits
    that differ between two of these are their Manhattan distance."""
    odd, high = F.lit(_ODD), F.shiftrightunsigned(fp, 1)
    return fp.bitwiseOR(high).bitwiseAND(odd).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(high).bitwiseAND(odd), 1))


def visits(counts: Column, segments: int) -> Column:
    """The cell ``counts`` (unary, of so many segments) and those in which one
    count is larger by one."""
    more = []
    for i in range(segments):
        low, high = F.lit(1 << 2 * i), F.lit(2 << 2 * i)
        more.append(F.when(counts.bitwiseAND(low) == 0, counts.bitwiseOR(low)).when(
            counts.bitwiseAND(high) == 0, counts.bitwiseOR(high)))
    return F.filter(F.array(counts, *more), lambda c: c.isNotNull())


def _cut(counts: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(counts, shift).bitwiseAND(F.lit((1 << bits) - 1))


def cells(prints: DataFrame) -> DataFrame:
    """``half, cell, home, fp``: each fingerprint in its own cell of both halves
    (``home``) and in those that it visits."""
    counts = unary_counts(F.col("fp"))
    out = None
    for half in (0, 1):
        own = prints.select("fp", F.posexplode(visits(_cut(counts, 32 * half, 32), 16)).alias("i", "cell"))
        own = own.select(F.lit(half).alias("half"), "cell", (F.col("i") == 0).alias("home"), "fp")
        out = own if out is None else out.unionByName(own)
    return out


def finer_cells(entries: DataFrame) -> DataFrame:
    """Entries of crowded cells by the quarters of the other half as well: ``half,
    cell, quarter, sub, home, fp``."""
    counts = unary_counts(F.col("fp"))
    other = F.when(F.col("half") == 0, _cut(counts, 32, 32)).otherwise(_cut(counts, 0, 32))
    out = None
    for quarter in (0, 1):
        part = entries.select("half", "cell", "fp", F.posexplode(
            visits(_cut(other, 16 * quarter, 16), 8)).alias("i", "sub"))
        part = part.select("half", "cell", F.lit(quarter).alias("quarter"), "sub",
                           (F.col("i") == 0).alias("home"), "fp")
        out = part if out is None else out.unionByName(part)
    return out


# --------------------------------------------------------------------- links
def _unary(fp: np.ndarray) -> np.ndarray:
    odd, high = np.uint64(_ODD), fp >> np.uint64(1)
    return ((fp | high) & odd) | ((fp & high & odd) << np.uint64(1))


def _linked(fp: np.ndarray, unary: np.ndarray, i: np.ndarray, j: np.ndarray, distance: int):
    """Of the pairs ``(i, j)`` those that are links: lower bound, then exact."""
    near = np.bitwise_count(unary[i] ^ unary[j]) <= distance
    i, j = i[near], j[near]
    exact = np.bitwise_count(fp[i] ^ fp[j]) <= distance
    return i[exact], j[exact]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(node, smallest node of its component)`` of the links ``a - b``."""
    node, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(node))
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)           # hook the roots, then shorten
        np.minimum.at(label, label[v], low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
        open_ = label[u] != label[v]
        u, v = u[open_], v[open_]
    moved = label != np.arange(len(node))
    return node[moved], node[label[moved]]


def _meet(fp: np.ndarray, cell: np.ndarray, distance: int):
    """Links inside runs of equal ``cell``."""
    unary = _unary(fp)
    i = np.arange(len(fp) - 1)
    d, found = 1, []
    while len(i):                                     # each with the d-th after it
        i = i[i + d < len(fp)]
        i = i[cell[i] == cell[i + d]]
        found.append(_linked(fp, unary, i, i + d, distance))
        d += 1
    if not found:
        return fp[:0], fp[:0]
    a, b = (np.concatenate(x) for x in zip(*found))
    return _forest(fp[a], fp[b])


def _links_in_cells(keys: list[str], distance: int):
    """Rows sorted by cell; a cell is whole in its partition."""
    def run(batches):
        kept = None
        for batch in chain(batches, [None]):
            table = kept if batch is None else batch if kept is None else pa.concat_batches([kept, batch])
            if table is None or table.num_rows == 0:
                continue
            cols = [table.column(k).to_numpy(zero_copy_only=False) for k in keys]
            new = np.zeros(table.num_rows, bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            last = int(np.flatnonzero(new)[-1]) if new.any() else 0
            # The last cell may go on in the next batch.
            stop = table.num_rows if batch is None else last
            kept = table.slice(stop)
            fp = table.column("fp").to_numpy()[:stop].view(np.uint64)
            u, v = _meet(fp, np.cumsum(new)[:stop], distance)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])
    return run


def _links_of_blocks(distance: int):
    """Rows ``a, b``: the members of two blocks of a cell (equal for one block)."""
    def run(batches):
        for batch in batches:
            for a, b in zip(batch.column("a"), batch.column("b")):
                x, y = (np.array(s.values, np.int64).view(np.uint64) for s in (a, b))
                both, ux, uy = np.concatenate((x, y)), np.arange(len(x)), len(x) + np.arange(len(y))
                unary, found = _unary(both), []
                for i in range(0, len(x), 256):
                    left = ux[i:i + 256]
                    found.append(_linked(both, unary, np.repeat(left, len(y)),
                                         np.tile(uy, len(left)), distance))
                i, j = (np.concatenate(z) for z in zip(*found))
                u, v = _forest(both[i], both[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])
    return run


def _sorted_links(entries: DataFrame, keys: list[str], distance: int) -> DataFrame:
    dealt = entries.select(*keys, "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_links_in_cells(keys, distance), "u long, v long")


def _crowded(entries: DataFrame, keys: list[str], limit: int) -> DataFrame:
    return materialise(entries.groupBy(*keys).agg(F.count(F.lit(1)).alias("members"))
                       .where(F.col("members") > limit), "crowded")


def _block_links(entries: DataFrame, full: DataFrame, keys: list[str], limit: int,
                 distance: int) -> DataFrame:
    """Members of crowded cells, dealt in blocks by hash; every pair of blocks once."""
    some = entries.join(full, keys).withColumn("n", F.ceil(F.col("members") * 2 / F.lit(limit)))
    block = F.pmod(F.xxhash64("fp"), F.col("n")).alias("block")
    blocks = materialise(some.select(*keys, "n", block, "fp").groupBy(*keys, "n", "block").agg(
        F.collect_set("fp").alias("fps")), "blocks")
    left = blocks.select(*keys, F.col("fps").alias("a"),
                         F.explode(F.sequence("block", F.col("n") - 1)).alias("block"))
    pairs = left.join(blocks.select(*keys, "block", F.col("fps").alias("b")), [*keys, "block"])
    return pairs.select("a", "b").mapInArrow(_links_of_blocks(distance), "u long, v long")


def links(prints: DataFrame, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """Forest of links ``(u, v)`` among distinct fingerprints ``fp``: two are
    connected exactly if links of at most ``distance`` bits lead from one to
    the other."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("the grid serves distances of 0 to 3 bits")
    keys, sub = ["half", "cell"], ["half", "cell", "quarter", "sub"]
    entries = cells(prints)
    full = _crowded(entries, keys, crowded)
    found = [_sorted_links(entries.join(full.select(*keys), keys, "left_anti"), keys, distance)]
    if full.limit(1).count():
        finer = materialise(finer_cells(entries.join(full.select(*keys), keys, "left_semi")), "finer")
        dense = _crowded(finer, sub, crowded)
        found.append(_sorted_links(finer.join(dense.select(*sub), sub, "left_anti"), sub, distance))
        if dense.limit(1).count():
            found.append(_block_links(finer, dense, sub, crowded, distance))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return materialise(out, "simhash-links")


def near_duplicates(docs: DataFrame, n: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest ``doc_id`` among the rows that links lead
    to, the row itself included.  Null, empty and blank texts have fingerprint
    zero and link like any other; a text with fewer than ``n`` words is one
    shingle.  A null ``doc_id`` is never the smallest, its row links like any
    other; a component of such rows alone has a null id.  Rows that repeat an
    id are rows of their own.  Extra columns are ignored.
    """
    own = materialise(fingerprints(docs, n), "fingerprints")
    nodes = materialise(own.groupBy("fp").agg(F.min("doc_id").alias("low")), "nodes")
    comp = components(links(nodes.select("fp"), distance))
    label = F.coalesce("component", "fp").alias("c")
    nodes = materialise(nodes.join(comp, nodes["fp"] == comp["node"], "left").select("fp", "low", label),
                        "labels")
    lows = nodes.groupBy("c").agg(F.min("low").alias("component_id"))
    nodes = materialise(nodes.join(lows, "c").select("fp", "component_id"), "components")
    return own.join(nodes, "fp").select("doc_id", "fp", "component_id")
