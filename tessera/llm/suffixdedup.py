"""Removal of long repeated byte strings, with suffix arrays over shards.

A window is a string of ``length`` bytes inside one text.  A byte is removed
if it is covered by a window that also starts anywhere else.  Deciding this
needs a suffix array only where texts begin to differ, so the corpus is first
cut into shards in which equal windows always meet:

1. The smallest gram hash inside a window (leftmost on ties) is its anchor.
   Anchor and offset follow from the window's bytes alone.  Consecutive windows
   with the same anchor and the same block of offsets form a unit; all its
   windows contain the unit's core bytes, so equal windows have equal cores.
2. Units are counted by core (map-side combined).  A core held once repeats
   nothing.  If all units of a core are equal, all their windows repeat.
3. Where units of a core differ, one text of each distinct unit goes to the
   shard of its core, and the shard's suffix array and permuted common
   prefixes (``suffix_array``) tell which windows repeat.
4. Cores with very many distinct units (the edge of a passage that a large
   share of all texts hold) are halved: half the offsets, a longer core, counted
   again, down to single windows.  So no shard grows with the hottest passage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textops as tx
from tessera.llm.suffix_array import repeated
from tessera.plans.joins import materialise

LENGTH = 400
GRAM = 32
HOT_UNITS = 256           # distinct units of a core that one shard may hold
SHARD_BYTES = 1 << 20     # text per suffix array
TASK_BYTES = 1 << 25      # text per task of the shard stage
SEGMENT = 1 << 24         # longer texts are cut for anchors, with overlap
_POS = np.uint64((1 << 26) - 1)

UNIT = "rid long, core long, whole long, a int, n int, q int"


def block_size(length: int) -> int:
    """Offsets per block: the power of two at or under a third of the length."""
    return 1 << max(0, (length // 3).bit_length() - 1)


def _window_min(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive keys (two running minima)."""
    n = len(key)
    pad = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    pad[:n] = key
    rows = pad.reshape(-1, width)
    fwd = np.minimum.accumulate(rows, axis=1).ravel()
    bwd = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(bwd[:n - width + 1], fwd[width - 1:n])


def _hashes(one, two, cs, a, n, q, length, block):
    """Core and whole hash of units: nominal core of a block of offsets."""
    core = tx.range_hash(one, cs, cs - (block - 1) + length)
    whole = tx.range_hash(two, a, a + n - 1 + length)
    return core.view(np.int64), tx.mix(whole ^ tx.mix(q.astype(np.uint64))).view(np.int64)


def _units(data: np.ndarray, off: np.ndarray, length: int, gram: int):
    """``(doc, core, whole, a, n, q)`` of all units; ``a`` is the first window's
    start in its text, ``n`` the number of windows, ``q`` the distance from
    ``a`` to the core."""
    size = np.diff(off)
    block = block_size(length)
    if len(data) < length or not (size >= length).any():
        return None
    key = (tx.window_hash(data, gram) & ~_POS) | np.arange(len(data) - gram + 1, dtype=np.uint64)
    low = _window_min(key, length - gram + 1)
    mark = np.zeros(len(data) + 1, np.int32)
    long = np.flatnonzero(size >= length)
    mark[off[long]] += 1
    mark[off[long + 1] - length + 1] -= 1
    at = np.flatnonzero(np.cumsum(mark[:len(low)]) > 0)
    p = (low[at] & _POS).astype(np.int64)
    b = (p - at) // block
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (p[1:] != p[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    a = at[first]
    n = np.diff(np.append(first, len(at)))
    cs = p[first] - b[first] * block
    one, two = tx.prefix_hash(data), tx.prefix_hash(data, second=True)
    core, whole = _hashes(one, two, cs, a, n, cs - a, length, block)
    core = tx.mix(core.view(np.uint64) + b[first].astype(np.uint64)).view(np.int64)
    doc = np.searchsorted(off, a, "right") - 1
    return doc, core, whole, a - off[doc], n, cs - a


def _parts(data, off, length):
    """The piece itself, or segments of one very long text: ``(data, off, shift)``."""
    if len(data) <= SEGMENT:
        yield data, off, 0
        return
    for s in range(0, len(data) - length + 1, SEGMENT):
        cut = data[s:s + SEGMENT + length - 1]
        yield cut, np.array([0, len(cut)]), s


def keyed(docs: DataFrame, keep: tuple = ()) -> DataFrame:
    """``rid, doc_id, text``: rows with equal id and text share ``rid`` (and
    hence spans); equal ids with other texts do not."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return docs.select(F.xxhash64(doc_id, text).alias("rid"), doc_id.alias("doc_id"),
                       text.alias("text"), *keep)


def units(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Units of all rows ``(rid, doc_id, text)``."""
    def run(batches):
        for part, data, off in tx.pieces(batches):
            rid = part.column(0).to_numpy()
            for d, o, shift in _parts(data, off, length):
                got = _units(d, o, length, gram)
                if got is None:
                    continue
                doc, core, whole, a, n, q = got
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[doc]), pa.array(core), pa.array(whole),
                     pa.array((a + shift).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(q.astype(np.int32))],
                    names=["rid", "core", "whole", "a", "n", "q"])

    return rows.select("rid", "doc_id", "text").mapInArrow(run, UNIT)


def _spans(df: DataFrame, length: int) -> DataFrame:
    return df.select("rid", F.col("a").alias("s"),
                     (F.col("a") + F.col("n") - 1 + F.lit(length)).alias("e"))


def _classify(unit: DataFrame, name: str, extra: tuple[str, ...] = ()):
    """Units of repeated cores: ``(all, one of each distinct mixed unit)``.

    The first has a column ``sure``: every window of the unit repeats.  The
    second, for cores whose units differ, one row of each distinct unit with
    the number ``distinct`` of its core.
    """
    cores = unit.groupBy("core").agg(F.count(F.lit(1)).alias("c"), F.min("whole").alias("lo"),
                                     F.max("whole").alias("hi")).where("c > 1")
    # Written first: a join of two shuffled tables is one whose hot keys Spark splits.
    cores = materialise(cores, name + "-counts")
    both = materialise(unit.join(cores.drop("c"), "core").withColumn(
        "mixed", F.col("lo") != F.col("hi")).drop("lo", "hi"), name)
    mixed = both.where("mixed")
    groups = mixed.groupBy("core", "whole").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("rid", "a", "n", "q", *extra)).alias("r"))
    groups = materialise(groups, name + "-distinct")
    size = materialise(groups.groupBy("core").agg(F.count(F.lit(1)).alias("distinct")),
                       name + "-sizes")
    twice = materialise(groups.where("copies > 1").select("core", "whole"), name + "-copies")
    sure = both.where("not mixed").drop("mixed").unionByName(
        mixed.drop("mixed").join(twice, ["core", "whole"], "left_semi"))
    reps = groups.join(size, "core").select("core", "whole", "distinct", "copies", "r.*")
    return sure, reps


def _with_text(reps: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """The units' bytes, cut from the texts of ``rows``.  A unit without copies
    belongs to one row; that of a repeated row may come twice, it has copies."""
    want = reps.groupBy("rid").agg(F.collect_list(
        F.struct("core", "whole", "distinct", "copies", "a", "n", "q")).alias("u"))
    text = rows.select("rid", "text")

    def run(batches):
        for batch in batches:
            out = []
            for rid, text, cut in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = text.encode()
                out += [{"rid": rid, **u, "body": raw[u["a"]:u["a"] + u["n"] - 1 + length]}
                        for u in cut]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("rid", pa.int64()), ("core", pa.int64()), ("whole", pa.int64()),
                ("distinct", pa.int64()), ("copies", pa.int64()), ("a", pa.int32()),
                ("n", pa.int32()), ("q", pa.int32()), ("body", pa.binary())]))

    return text.join(want, "rid").select("rid", "text", "u").mapInArrow(
        run, "rid long, core long, whole long, distinct long, copies long, a int, n int, q int, "
             "body binary")


def _halve(hot: DataFrame, length: int, block: int) -> DataFrame:
    """Units of half the offsets from units with their bytes."""
    half = block // 2

    def run(batches):
        for part, data, off in tx.pieces(batches, column="body"):
            cols = {c: part.column(i).to_numpy() for i, c in enumerate(("rid", "a", "n", "q"))}
            body = part.column(4).to_pylist()
            one, two = tx.prefix_hash(data), tx.prefix_hash(data, second=True)
            base = off[:-1]
            out = []
            for s in (0, 1):
                # Windows whose distance to the old core lies in this half.
                lo = np.maximum(0, cols["q"] - (s * half + half - 1))
                hi = np.minimum(cols["n"] - 1, cols["q"] - s * half)
                ok = np.flatnonzero(lo <= hi)
                if len(ok) == 0:
                    continue
                x, n = lo[ok].astype(np.int64), (hi - lo + 1)[ok].astype(np.int64)
                q = cols["q"][ok] - s * half - x
                core, whole = _hashes(one, two, base[ok] + x + q, base[ok] + x, n, q, length, half)
                core = tx.mix(core.view(np.uint64) + np.uint64(s + 1)).view(np.int64)
                out.append(pa.RecordBatch.from_arrays(
                    [pa.array(cols["rid"][ok]), pa.array(core), pa.array(whole),
                     pa.array((cols["a"][ok] + x).astype(np.int32)), pa.array(n.astype(np.int32)),
                     pa.array(q.astype(np.int32)),
                     pa.array([body[i][f:f + m - 1 + length] for i, f, m in
                               zip(ok.tolist(), x.tolist(), n.tolist())], pa.binary())],
                    names=["rid", "core", "whole", "a", "n", "q", "body"]))
            yield from out

    return hot.select("rid", "a", "n", "q", "body").mapInArrow(run, UNIT + ", body binary")


def _shard_spans(cold: DataFrame, length: int) -> DataFrame:
    """Spans from the suffix arrays of the shards.  Units of a core lie next to
    each other, and a suffix array holds whole cores."""
    def flush(rows):
        starts = repeated([r[3] for r in rows], length)
        rid, s, e = [], [], []
        for (_, key, a, _, copies), at in zip(rows, starts):
            if copies > 1 or len(at) == 0:            # copies count as repeats already
                continue
            cut = np.flatnonzero(np.diff(at) > 1)
            first = at[np.concatenate(([0], cut + 1))]
            last = at[np.concatenate((cut, [len(at) - 1]))]
            rid += [key] * len(first)
            s += (a + first).tolist()
            e += (a + last + length).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(rid, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())],
            names=["rid", "s", "e"])

    def run(batches):
        rows, size, core = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[0] != core and size >= SHARD_BYTES:
                    yield flush(rows)
                    rows, size = [], 0
                core = row[0]
                rows.append(row)
                size += len(row[3])
        if rows:
            yield flush(rows)

    # A fixed number of partitions: merging small ones by size would put much
    # more work in a task than its bytes show.
    total = cold.agg(F.coalesce(F.sum(F.col("n") + F.lit(length)), F.lit(0)).alias("b")).first()["b"]
    parts = max(int(cold.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                total // TASK_BYTES)
    return (cold.select("core", "rid", "a", "body", "copies").repartition(parts, "core")
            .sortWithinPartitions("core").mapInArrow(run, "rid long, s int, e int"))


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int | None = None) -> DataFrame:
    """``(rid, s, e)``: byte ranges covered by repeated windows (ranges of one
    text may overlap).  ``rows`` is the output of ``keyed``."""
    gram = max(1, min(GRAM, length // 4)) if gram is None else gram
    block = block_size(length)
    sure, reps = _classify(materialise(units(rows, length, gram), "units"), "unit-cores")
    found = _spans(sure, length)
    todo = materialise(_with_text(reps, rows, length), "unit-texts")
    found = found.union(_shard_spans(todo.where(F.col("distinct") <= HOT_UNITS), length))
    hot = todo.where(F.col("distinct") > HOT_UNITS)
    while block > 1 and hot.limit(1).count():
        # A unit that stands for several copies keeps that in the next count:
        # its windows are settled, but others must still meet them.
        parts = materialise(_halve(hot, length, block), "units-halved")
        block //= 2
        sure, reps = _classify(parts, "half-cores", ("body",))
        found = found.union(_spans(sure, length))
        found = found.union(_shard_spans(reps.where(F.col("distinct") <= HOT_UNITS), length))
        hot = reps.where(F.col("distinct") > HOT_UNITS)
    return found


def suffix_dedup(docs: DataFrame, length: int = LENGTH, with_text: bool = True,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, with
    ``with_text``, ``text`` (what is left; parts of a cut character are left
    out) and ``spans``.

    Null texts are empty.  Repeated rows repeat each other's windows.  Texts
    under ``length`` bytes stay whole.  The columns of ``keep`` come back as a
    struct ``kept``; other columns are ignored.
    """
    carried = F.struct(*keep).alias("kept") if keep else F.lit(None).cast("int").alias("kept")
    rows = keyed(docs, (carried,))
    spans = repeated_spans(rows, length).groupBy("rid").agg(
        F.collect_set(F.struct("s", "e")).alias("u"))

    def run(batches):
        for part, data, off in tx.pieces(batches):
            out = {"n_bytes": np.diff(off), "n_removed": [], "n_spans": [], "kept_sha256": [],
                   "text": [], "spans": []}
            for i, cut in enumerate(part.column(2).to_pylist()):
                raw = data[off[i]:off[i + 1]]
                runs = []
                for s, e in sorted((u["s"], u["e"]) for u in cut or ()):
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
                left, at = [], 0
                for s, e in runs:
                    left.append(raw[at:s].tobytes())
                    at = e
                left = b"".join([*left, raw[at:].tobytes()])
                out["n_removed"].append(len(raw) - len(left))
                out["n_spans"].append(len(runs))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                if with_text:
                    out["text"].append(left.decode("utf-8", "ignore"))
                    out["spans"].append([{"s": s, "e": e} for s, e in runs])
            cols = [part.column(0), pa.array(out["n_bytes"], pa.int64()),
                    pa.array(out["n_removed"], pa.int64()), pa.array(out["n_spans"], pa.int64()),
                    pa.array(out["kept_sha256"], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols += [pa.array(out["text"], pa.string()), pa.array(out["spans"], pa.list_(
                    pa.struct([("s", pa.int32()), ("e", pa.int32())])))]
                names += ["text", "spans"]
            if keep:
                cols.append(part.column(3))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        schema += ", text string, spans array<struct<s:int,e:int>>"
    if keep:
        schema += f", kept {rows.schema['kept'].dataType.simpleString()}"
    cols = ["doc_id", "text", "u", *(["kept"] if keep else [])]
    return rows.join(spans, "rid", "left").select(*cols).mapInArrow(run, schema)
