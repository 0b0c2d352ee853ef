"""Language-model scoring with class-based bigrams (exchange clustering).

Tokens are the words of a text (A-Z lowered) and one end token.  Training
counts every word of every training text.  Words with ``MIN_COUNT`` occurrences
or more are symbols of their own; all rarer ones share the symbol of their
ending ("shape").  Exchange clustering gives every symbol a class:

1. The ``SEED_WORDS`` most frequent words and the shapes are clustered on one
   matrix of fixed size; every other word starts in the class of its shape.
2. In each sweep Spark gathers how often each symbol follows and precedes every
   class, tasks find the class with the largest gain in likelihood against the
   class matrix, and half of the symbols move at once.  A sweep that does not
   raise the likelihood is undone and ends the search.
3. Classed words that do not fit the table sent to every task get their symbols by
   a join.  Classes take one byte a word and are sent to every task; beyond
   ``SENT_CLASSES`` they are a table that each sweep joins to the pairs they are
   in.  The results do not depend on which words fit.  Only where a caller names a
   ``limit`` of context words do the words beyond it stand for their shape as the
   word before; their own class then comes from what they follow.

    P(w | v) = P(class(w) | class(v)) * P(symbol(w) | class(w)) * P(w | symbol(w))

The last factor is 1 for words that are symbols and an add-one estimate over the
shape's words for the others.

Null and empty texts hold the end token only; without training rows every
probability comes from the pseudo counts.  Repeated rows count each time, ties
between classes go to the class held, then to the first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm import textops as tx
from tessera.plans.joins import discard, materialise
from tessera.plans.numbering import number_rows

MIN_COUNT = 5             # occurrences of a word with a class of its own
SEED_WORDS = 768          # words of the first clustering
SHAPES = 128              # symbols of all other words, by their last bytes
CLASSES = 64
SEED_SWEEPS = 8
SWEEPS = 4                # over the table; each moves half of the symbols
KNOWN_WORDS = 1 << 20     # word counts sent to every task at most (16 bytes each)
RARE_FILL = 1 << 19       # words under MIN_COUNT only fill the table up to this size
SENT_CLASSES = 1 << 24    # classes of words sent to every task at most (a byte each)
_MAYBE_BITS = 22          # of the bitmap that finds words which may be beyond the table
BACKOFF = 5.0             # pseudo count of the class unigram in a transition
ROW_TOKENS = 256          # tokens of a row of the written sequences
_BUFFER = 1 << 21         # tokens counted at once in a task
_SLICE = 1 << 16          # rows of a batch that a task hands back


def _shape(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Shape of each word: a bucket of its last three bytes (A-Z lowered)."""
    low = tx.LOWER[data].astype(np.uint32)
    h = np.zeros(len(start), np.uint32)
    for k in (1, 2, 3):
        at = end - k
        byte = np.where(at >= start, low[np.maximum(at, 0)], 0)
        h = (h ^ byte) * np.uint32(0x01000193)
    h ^= h >> np.uint32(13)
    return (h * np.uint32(0x2C1B3C6D) >> np.uint32(8)) % np.uint32(SHAPES)


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether ``crc32`` of the id's text falls in the held-out fold (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def _slices(batch: pa.RecordBatch):
    """A batch in parts of bounded size, so that little waits on either side."""
    for a in range(0, batch.num_rows, _SLICE):
        yield batch.slice(a, _SLICE)


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, shape, c)`` over all rows ``(text)``; ``word`` is a 64-bit hash."""
    def run(batches):
        words, shapes, held = [], [], 0

        def flush():
            w = np.concatenate(words)
            words.clear()
            unit, first, count = np.unique(w, return_index=True, return_counts=True)
            del w
            s = np.concatenate(shapes)[first]
            shapes.clear()
            return _slices(pa.RecordBatch.from_arrays(
                [pa.array(unit.view(np.int64)), pa.array(s.astype(np.int32)),
                 pa.array(count.astype(np.int64))], names=["word", "shape", "c"]))

        for _, data, off in tx.pieces(batches):
            start, end, _ = tx.word_spans(data, off)
            if len(start) == 0:
                continue
            words.append(tx.span_hash(data, start, end))
            shapes.append(_shape(data, start, end))
            held += len(start)
            if held >= _BUFFER:
                yield from flush()
                held = 0
        if held:
            yield from flush()

    return (texts.select("text").mapInArrow(run, "word long, shape int, c long")
            .groupBy("word", "shape").agg(F.sum("c").alias("c")))


@dataclass
class Known:
    """Counts of the most frequent words, and the symbols: the words of the table,
    the shapes, the end, then the classed words beyond the table."""

    words: np.ndarray         # sorted hashes
    counts: np.ndarray
    symbol: np.ndarray        # symbol of each by falling count, -1: its shape
    shape_of: np.ndarray      # shape of each word symbol
    seeds: int                # symbols of the first clustering
    cut: tuple[int, int] | None   # count and hash prefix of the first words outside
    linked: bool              # whether classed words outside are symbols as well
    beyond: int = 0           # how many of them
    maybe: np.ndarray | None = None   # bits: leading bits of their hashes

    def look_up(self, h: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(count, symbol)`` per word; count 0: not among the known words."""
        if len(self.words) == 0:
            return np.zeros(len(h), np.int64), self.top + shape.astype(np.int64)
        unit, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, unit), len(self.words) - 1)
        hit = self.words[at] == unit
        count = np.where(hit, self.counts[at], 0)[back].astype(np.int64)
        sym = np.where(hit, self.symbol[at], -1)[back]
        return count, np.where(sym >= 0, sym, self.top + shape.astype(np.int64))

    @property
    def top(self) -> int:
        """Word symbols; the shapes and the end follow."""
        return len(self.shape_of)

    @property
    def end(self) -> int:
        return self.top + SHAPES

    @property
    def symbols(self) -> int:
        return self.top + SHAPES + 1

    @property
    def open(self) -> bool:
        """Whether classed words lie outside the table."""
        return self.cut is not None and self.cut[0] >= MIN_COUNT

    def outside(self) -> Column:
        """Whether a row of the word counts lies outside the table."""
        if self.cut is None:
            return F.lit(False)
        c, prefix = self.cut
        return (F.col("c") < c) | ((F.col("c") == c) & (_prefix() >= prefix))

    def half(self, sym, where=np.where):
        """The half that a symbol moves with: the parity of its number if all words
        came first.  ``sym`` is an array, or a column with ``where`` for columns."""
        if not self.beyond:
            return sym % 2
        return where(sym < self.top, sym, where(sym < self.symbols, sym + self.beyond,
                                                sym - SHAPES - 1)) % 2

    def may_be_beyond(self, h: np.ndarray) -> np.ndarray:
        """Whether words outside the table may have symbols."""
        if self.maybe is None:
            return np.full(len(h), self.open)
        at = h >> np.uint64(64 - _MAYBE_BITS)
        return (self.maybe[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _column_where(test, a, b) -> Column:
    return F.when(test, a).otherwise(b)


def _count_bin() -> Column:
    return F.floor(F.log2("c") * 16)


def _prefix() -> Column:
    return F.shiftrightunsigned("word", 48)


def _table_end(counts: DataFrame, limit: int) -> tuple[int, int] | None:
    """Count and hash prefix of the first words that do not fit among ``limit``, by
    falling count and then hash; None if all fit.  Found from histograms: over
    logarithmic bins, the counts of one bin and the prefixes of one count."""
    total = 0

    def first_outside(rows: DataFrame, key: Column, falling: bool):
        nonlocal total
        hist = sorted(((r["k"], r["n"]) for r in rows.groupBy(key.alias("k")).agg(
            F.count(F.lit(1)).alias("n")).collect()), reverse=falling)
        for k, n in hist:
            if total + n > limit:
                return k
            total += n
        return None

    b = first_outside(counts, _count_bin(), True)
    if b is None:
        return None
    c = first_outside(counts.where(_count_bin() == F.lit(b)), F.col("c"), True)
    return c, first_outside(counts.where(F.col("c") == c), _prefix(), False)


def known_words(counts: DataFrame, limit: int | None = None, seeds: int = SEED_WORDS) -> Known:
    """The table of the most frequent words: the classed ones, at most ``KNOWN_WORDS``,
    and others up to ``RARE_FILL``.  A ``limit`` is another size of it, and words
    beyond are then no context by themselves."""
    most, linked = limit, limit is None
    if linked:
        most = min(KNOWN_WORDS, max(RARE_FILL, counts.where(F.col("c") >= MIN_COUNT).count()))
    known = Known(*[np.empty(0, np.int64)] * 4, 0, _table_end(counts, most), linked)
    got = counts.where(~known.outside()).select("word", "shape", "c").toArrow()
    word = got.column("word").to_numpy().view(np.uint64)
    c, shape = got.column("c").to_numpy(), got.column("shape").to_numpy()
    order = np.argsort(word)
    word, c, shape = word[order], c[order], shape[order]
    best = np.lexsort((word, -c))
    best = best[c[best] >= MIN_COUNT]
    symbol = np.full(len(word), -1, np.int32)
    symbol[best] = np.arange(len(best))
    small = np.int32 if c.max(initial=0) < 1 << 31 else np.int64
    known.words, known.counts, known.symbol = word, c.astype(small), symbol
    known.shape_of, known.seeds = shape[best].astype(np.int64), min(seeds, len(best))
    return known


def beyond_table(counts: DataFrame, known: Known) -> DataFrame | None:
    """``(word, shape, c, sym)``: the classed words outside the table, numbered like
    those inside, by falling count and then hash.  Their number and a bitmap of them go to ``known``."""
    if not known.open:
        return None
    rest = counts.where(known.outside() & (F.col("c") >= MIN_COUNT)).select(
        (-F.col("c")).alias("order_c"), F.col("word").bitwiseXOR(F.lit(-1 << 63)).alias("order_w"),
        "word", "shape", "c")
    rest = materialise(number_rows(rest, ["order_c", "order_w"], name="at").select(
        "word", "shape", "c", (F.col("at") + known.symbols).cast("int").alias("sym")), "lm-beyond")
    known.beyond = rest.count()
    bit = F.shiftrightunsigned("word", 64 - _MAYBE_BITS).cast("int")
    at = rest.select(bit.alias("at")).distinct().toArrow().column("at").to_numpy()
    seen = np.zeros(1 << _MAYBE_BITS, bool)
    seen[at] = True
    known.maybe = np.packbits(seen, bitorder="little")
    return rest


def _sequence(data, off, known: Known):
    """Tokens of a piece in order, an end after each text:
    ``(hash, shape, count, symbol, doc)``; ends have symbol ``known.end``."""
    start, end, doc = tx.word_spans(data, off)
    h, shape = tx.span_hash(data, start, end), _shape(data, start, end)
    count, sym = known.look_up(h, shape)
    n_docs = len(off) - 1
    place = np.arange(len(start)) + doc               # one end per earlier text
    total = len(start) + n_docs
    full = np.full(total, known.end, np.int64)
    full[place] = sym
    owner = np.repeat(np.arange(n_docs), np.bincount(doc, minlength=n_docs) + 1)
    return h, count, sym, doc, place, full, owner


def sequences(texts: DataFrame, known_ref) -> DataFrame:
    """The training rows as symbols: ``(seq, word, at)``, rows of at most
    ``ROW_TOKENS`` tokens.  ``seq`` is the symbol before the first token and the
    tokens, as 32-bit integers.  If classed words lie outside the known table, the
    others are the words that may be such and their places in ``seq``."""
    def run(batches):
        known = known_ref.value
        for _, data, off in tx.pieces(batches):
            h, count, _, _, place, full, _ = _sequence(data, off, known)
            chain = np.concatenate(([known.end], full)).astype("<i4")
            starts = range(0, len(full), ROW_TOKENS)
            tail = np.flatnonzero(count == 0) if known.open else np.empty(0, np.int64)
            tail = tail[known.may_be_beyond(h[tail])]
            # The last token of a row is the one before the next row too.
            again = tail[((place[tail] + 1) % ROW_TOKENS == 0) & (place[tail] + 1 < len(full))]
            row = np.concatenate((place[tail], place[again] + 1)) // ROW_TOKENS
            at = np.concatenate((place[tail] % ROW_TOKENS + 1, np.zeros(len(again), np.int64)))
            order = np.argsort(row, kind="stable")
            per_row = np.bincount(row, minlength=len(starts))
            yield pa.RecordBatch.from_arrays(
                [pa.array([chain[a:a + ROW_TOKENS + 1].tobytes() for a in starts], pa.binary()),
                 tx.lists(h[np.concatenate((tail, again))[order]].view(np.int64), per_row, pa.int64()),
                 tx.lists(at[order].astype(np.int32), per_row, pa.int32())],
                names=["seq", "word", "at"])

    return texts.select("text").mapInArrow(run, "seq binary, word array<long>, at array<int>")


def _symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of a batch of sequences, and where each row starts."""
    data, off = tx.text_bytes(batch.column(batch.schema.get_field_index("seq")))
    flat = data.view("<i4") if data.ctypes.data % 4 == 0 else np.frombuffer(data.tobytes(), "<i4")
    return flat, off // 4


def _parts(batches, rows: int = 1 << 10):
    """Batches of bounded size."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def _pairs(batches):
    """``(previous, symbol)`` arrays of every batch of sequences."""
    for batch in _parts(batches):
        flat, off = _symbols(batch)
        first = np.zeros(len(flat), bool)             # a row's symbol before
        first[off[:-1]] = True
        at = np.flatnonzero(~first)
        yield flat[at - 1], flat[at]


def _table_pairs(batches, symbols: int):
    """The pairs of which both are below ``symbols``."""
    for before, seq in _pairs(batches):
        ok = (before < symbols) & (seq < symbols)
        yield (before, seq) if ok.all() else (before[ok], seq[ok])


def link(seqs: DataFrame, beyond: DataFrame) -> DataFrame:
    """``(seq)`` of ``seqs (row, seq, word, at)``, with the symbols of the words of
    ``beyond`` in place of their shapes."""
    hits = (seqs.select("row", F.explode(F.arrays_zip("word", "at")).alias("t"))
            .select("row", "t.word", "t.at").join(beyond.select("word", "sym"), "word")
            .groupBy("row").agg(F.collect_list(F.struct("at", "sym")).alias("hits")))

    def run(batches):
        for batch in _parts(batches):
            flat, off = _symbols(batch)
            flat, hits = flat.copy(), batch.column(batch.schema.get_field_index("hits"))
            size = hits.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            hit = hits.flatten()
            flat[np.repeat(off[:-1], size) + hit.field("at").to_numpy(zero_copy_only=False)] = (
                hit.field("sym").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array([flat[a:b].tobytes() for a, b in zip(off[:-1], off[1:])], pa.binary())],
                names=["seq"])

    return seqs.select("row", "seq").join(hits, "row", "left").select("seq", "hits").mapInArrow(
        run, "seq binary")


def beyond_pairs(seqs: DataFrame, symbols: int) -> DataFrame:
    """``(b, w, n)``: counts of the neighbours of which one is not below ``symbols``."""
    def run(batches):
        for before, seq in _pairs(batches):
            at = np.flatnonzero((before >= symbols) | (seq >= symbols))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(before[at]), pa.array(seq[at])],
                                                 names=["b", "w"])

    return (seqs.select("seq").mapInArrow(run, "b int, w int")
            .groupBy("b", "w").agg(F.count(F.lit(1)).alias("n")))


def with_groups(pairs: DataFrame, of_beyond: DataFrame, group_ref, symbols: int) -> DataFrame:
    """``pairs`` with the groups ``cb`` and ``cw`` of their symbols: by ``group`` (an
    array) below ``symbols``, else from ``of_beyond (sym, cls)``.  Only rare words
    are keys of these joins."""
    of_b = of_beyond.select(F.col("sym").alias("b"), F.col("cls").alias("cb"))
    of_w = of_beyond.select(F.col("sym").alias("w"), F.col("cls").alias("cw"))
    b, w, none = F.col("b") >= symbols, F.col("w") >= symbols, F.lit(None).cast("int")
    cols = ["b", "w", "n", "cb", "cw"]
    parts = [pairs.where(b & ~w).join(of_b, "b").withColumn("cw", none),
             pairs.where(~b & w).join(of_w, "w").withColumn("cb", none),
             pairs.where(b & w).join(of_b, "b").join(of_w, "w")]
    found = parts[0].select(cols).union(parts[1].select(cols)).union(parts[2].select(cols))

    def run(batches):
        group = group_ref.value
        for batch in batches:
            out = [batch.column(i) for i in range(3)]
            for sym, got in ((0, 3), (1, 4)):
                s = batch.column(sym).to_numpy()
                c = batch.column(got).fill_null(0).to_numpy()
                out.append(pa.array(np.where(s < symbols, group[np.minimum(s, symbols - 1)], c)
                                    .astype(np.int32)))
            yield pa.RecordBatch.from_arrays(out, names=cols)

    return found.mapInArrow(run, "b int, w int, n long, cb int, cw int")


def pair_counts(seqs: DataFrame, group_ref, size: int, symbols: int,
                beyond: DataFrame | None = None) -> np.ndarray:
    """``size x size`` counts of neighbouring symbols under ``group`` (an array of
    symbol -> group), ``beyond`` being the result of :func:`with_groups`.  Each
    task sends a cell at most once."""
    def run(batches):
        group, total = group_ref.value, np.zeros(size * size, np.int64)
        for before, seq in _table_pairs(batches, symbols):
            total += np.bincount(group[before].astype(np.int64) * size + group[seq],
                                 minlength=size * size)
        at = np.flatnonzero(total)
        yield from _slices(pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"]))

    cells = seqs.select("seq").mapInArrow(run, "cell int, n long")
    if beyond is not None:
        cells = cells.union(beyond.select((F.col("cb") * size + F.col("cw")).alias("cell"), "n"))
    got = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(size, size)


def _packed(key: np.ndarray, n: np.ndarray, width: int, held: np.ndarray | None = None
            ) -> pa.RecordBatch:
    """``(sym, held, cells)`` of the sorted cells ``key`` (symbol times ``width`` plus
    cell) with their counts: a row per symbol and class held, its cells one after the
    other as pairs of number and count.  Counts over 255 take several pairs."""
    kind = np.uint8 if width <= 256 else np.uint16
    times = (n + 254) // 255
    key, last = np.repeat(key, times), np.cumsum(times) - 1
    pairs = np.full((len(key), 2), 255, kind)
    pairs[last, 1] = n - (times - 1) * 255
    pairs[:, 0] = key % width
    sym = key // width
    first = np.flatnonzero(np.diff(sym, prepend=-1))
    ends = np.append(first, len(key)).astype(np.int64) * (2 * pairs.itemsize)
    cells = pa.Array.from_buffers(pa.large_binary(), len(first), [
        None, pa.py_buffer(ends), pa.py_buffer(pairs)]).cast(pa.binary())
    sym = sym[first].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(sym), pa.array(held[sym].astype(np.int32)), cells], names=["sym", "held", "cells"])


def context_counts(seqs: DataFrame, cls_ref, classes: int, half: int, known: Known,
                   symbols: int, beyond: DataFrame | None = None) -> DataFrame:
    """``(sym, held, cells)``: how often the symbols of one half precede a class (cells
    from 0), follow it (cells from ``classes``) or themselves (the last cell), and
    the class held.  ``cls`` has the classes of ``symbols`` symbols, ``beyond`` are the
    pairs with others.  Tasks add up before the shuffle and send the cells of a symbol
    as one value (:func:`_packed`); rows are sorted by symbol in partitions by symbol."""
    width = 2 * classes + 1
    mine = Known(*[np.empty(0)] * 3, np.empty(known.top), 0, None, True, known.beyond).half
    kind = np.uint32 if symbols * width < 1 << 32 else np.int64
    schema = "sym int, held int, cells binary"

    def run(batches):
        cls, held, size = cls_ref.value, [], 0

        def flush():
            key, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return _slices(_packed(key.astype(np.int64), n, width, cls))

        for before, seq in _table_pairs(batches, symbols):
            same = before == seq
            first = (mine(before) == half) & ~same
            second = mine(seq) == half
            held.append((before[first].astype(np.int64) * width + cls[seq[first]]).astype(kind))
            held.append((seq[second].astype(np.int64) * width
                         + np.where(same[second], 2 * classes,
                                    cls[before[second]].astype(np.int64) + classes)).astype(kind))
            size += len(seq)
            if size >= _BUFFER:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    cells = seqs.select("seq").mapInArrow(run, schema)
    if beyond is not None:
        same = F.col("b") == F.col("w")
        first = beyond.where((mine(F.col("b"), _column_where) == half) & ~same).select(
            F.col("b").alias("sym"), F.col("cb").alias("held"), F.col("cw").alias("cell"), "n")
        second = beyond.where(mine(F.col("w"), _column_where) == half).select(
            F.col("w").alias("sym"), F.col("cw").alias("held"),
            F.when(same, 2 * classes).otherwise(F.col("cb") + classes).alias("cell"), "n")

        def pack(batches):
            for batch in batches:
                sym, held, cell, n = (c.to_numpy() for c in batch.columns)
                unit, at, back = np.unique(sym, return_index=True, return_inverse=True)
                key, place = np.unique(back * width + cell, return_inverse=True)
                rows = _packed(key, np.bincount(place, weights=n).astype(np.int64), width, held[at])
                yield rows.set_column(0, "sym", pa.array(unit.astype(np.int32)))

        cells = cells.union(first.union(second).mapInArrow(pack, schema))
    return cells.repartition("sym").sortWithinPartitions("sym")


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SEED_SWEEPS) -> np.ndarray:
    """Class of each symbol by exchange clustering.

    ``bigrams`` is a symbols x symbols count matrix (its size is fixed by the
    symbol parameters).  Symbols are visited by falling count; each goes to the
    class with the largest gain in log likelihood of the class bigrams.
    """
    n = len(bigrams)
    classes = max(1, min(classes, n))
    weight = bigrams.sum(0)
    by_count = np.argsort(-weight, kind="stable")
    cls = np.empty(n, np.int64)
    cls[by_count] = np.arange(n) % classes
    joint = np.zeros((classes, classes))
    np.add.at(joint, (cls[:, None], cls[None, :]), bigrams)
    out, inn = joint.sum(1), joint.sum(0)
    rows, cols = bigrams.sum(1), bigrams.sum(0)
    for _ in range(sweeps):
        moved = 0
        for w in by_count.tolist():
            if rows[w] + cols[w] == 0:
                continue
            own = float(bigrams[w, w])
            right = np.bincount(cls, weights=bigrams[w], minlength=classes)
            left = np.bincount(cls, weights=bigrams[:, w], minlength=classes)
            a = cls[w]
            right[a] -= own
            left[a] -= own
            joint[a] -= right
            joint[:, a] -= left
            joint[a, a] -= own
            out[a] -= rows[w]
            inn[a] -= cols[w]
            up = _xlogx(joint + right[None, :]) - _xlogx(joint)
            down = _xlogx(joint + left[:, None]) - _xlogx(joint)
            diag = np.diagonal(joint)
            gain = (up.sum(1) - np.diagonal(up) + down.sum(0) - np.diagonal(down)
                    + _xlogx(diag + right + left + own) - _xlogx(diag)
                    - (_xlogx(out + rows[w]) - _xlogx(out))
                    - (_xlogx(inn + cols[w]) - _xlogx(inn)))
            b = int(gain.argmax())
            if gain[b] <= gain[a] + 1e-9:
                b = int(a)
            moved += b != a
            cls[w] = b
            joint[b] += right
            joint[:, b] += left
            joint[b, b] += own
            out[b] += rows[w]
            inn[b] += cols[w]
        if not moved:
            break
    return cls


def best_classes(unit: np.ndarray, cell: np.ndarray, n: np.ndarray, held: np.ndarray,
                 joint: np.ndarray) -> np.ndarray:
    """Best class of each symbol against a class matrix that counts it in ``held``.

    ``(unit, cell, n)`` are the counts of :func:`context_counts`, ``unit`` numbering
    the symbols; a cell may come several times.  The gain in likelihood is exact for one symbol moved alone.
    Only classes that a symbol meets cost anything.
    """
    k, m = len(joint), len(held)
    table = np.bincount(unit * (2 * k + 1) + cell, weights=n,
                        minlength=m * (2 * k + 1)).reshape(m, 2 * k + 1)
    right, left, own = table[:, :k], table[:, k:2 * k], table[:, 2 * k]
    row = np.arange(m)
    gain = np.zeros((m, k))
    for side, other, matrix in ((right, left, joint.T), (left, right, joint)):
        w, c = np.nonzero(side)
        add = side[w, c][:, None]
        base = matrix[c].copy()                       # per class, without the symbol
        base[np.arange(len(w)), held[w]] -= add[:, 0]
        inside = c == held[w]
        base[inside] -= other[w[inside]]
        base[np.arange(len(w)), c] = 0                # the diagonal follows
        np.maximum(base, 0, out=base)
        change = _xlogx(base + add) - _xlogx(base)
        change[np.arange(len(w)), c] = 0
        if len(w):
            start = np.flatnonzero(np.diff(w, prepend=-1))
            gain[w[start]] += np.add.reduceat(change, start, axis=0)
    both = right + left + own[:, None]
    diag = np.repeat(np.diagonal(joint)[None], m, 0)
    diag[row, held] -= both[row, held]
    np.maximum(diag, 0, out=diag)
    gain += _xlogx(diag + both) - _xlogx(diag)
    for total, size in ((joint.sum(1), right.sum(1) + own), (joint.sum(0), left.sum(1) + own)):
        rest = np.repeat(total[None], m, 0)
        rest[row, held] -= size
        np.maximum(rest, 0, out=rest)
        gain -= _xlogx(rest + size[:, None]) - _xlogx(rest)
    best = gain.argmax(1)
    return np.where(gain[row, best] > gain[row, held] + 1e-9, best, held)


def _word_cells(rows: pa.Table, first: np.ndarray, unit: np.ndarray, width: int):
    """``(held, unit, cell, n)`` of rows ``(word, cell, n)``, whose ``cell`` has the class
    held times ``width`` added."""
    cell = rows.column("cell").to_numpy()
    return cell[first] // width, unit, cell % width, rows.column("n").to_numpy()


def _symbol_cells(rows: pa.Table, first: np.ndarray, unit: np.ndarray, width: int):
    """``(held, unit, cell, n)`` of rows of :func:`context_counts`."""
    data, off = tx.text_bytes(rows.column("cells").combine_chunks())
    pairs = np.frombuffer(data.tobytes(), np.uint8 if width <= 256 else np.uint16).reshape(-1, 2)
    return (rows.column("held").to_numpy()[first], np.repeat(unit, np.diff(off) // (2 * pairs.itemsize)),
            pairs[:, 0].astype(np.int64), pairs[:, 1])


def _moves(key: str, joint_ref, cells_of):
    """``mapInArrow`` function over rows sorted by ``key``: the best class of every
    key against the class matrix.  ``cells_of`` reads the counts and the class held."""
    def run(batches):
        joint, last = joint_ref.value, None
        width = 2 * len(joint) + 1

        def answer(rows):
            k = rows.column(key).to_numpy()
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            unit = np.cumsum(np.concatenate(([False], k[1:] != k[:-1])))
            held, unit, cell, n = cells_of(rows, first, unit, width)
            held = held.astype(np.int64)
            best = np.empty(len(held), np.int64)
            for a in range(0, len(first), 2048):      # bounded memory
                b = min(a + 2048, len(first))
                lo, hi = np.searchsorted(unit, (a, b))
                best[a:b] = best_classes(unit[lo:hi] - a, cell[lo:hi], n[lo:hi], held[a:b], joint)
            return pa.RecordBatch.from_arrays(
                [pa.array(k[first]), pa.array(held.astype(np.int32)),
                 pa.array(best.astype(np.int32))], names=[key, "held", "cls"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if last is not None:
                rows = pa.concat_tables([last, rows])
            k = rows.column(key).to_numpy()
            if len(k) == 0:
                continue
            cut = int(np.flatnonzero(k != k[-1])[-1]) + 1 if k[0] != k[-1] else 0
            if cut:
                yield answer(rows.slice(0, cut).combine_chunks())
            last = rows.slice(cut).combine_chunks()
        if last is not None and last.num_rows:
            yield answer(last)
    return run


def likelihood(joint: np.ndarray) -> float:
    """Log likelihood of the class bigrams, but for a constant."""
    return float(_xlogx(joint).sum() - _xlogx(joint.sum(0)).sum() - _xlogx(joint.sum(1)).sum())


def cluster(seqs: DataFrame, known: Known, sweeps: int = SWEEPS, words: DataFrame | None = None
            ) -> tuple[np.ndarray, np.ndarray, DataFrame | None]:
    """Class of every symbol, the class matrix and, with ``words`` (the result of
    :func:`beyond_table`, their symbols being in ``seqs``), ``(sym, cls)`` of these."""
    sc = seqs.sparkSession.sparkContext
    top, seeds, symbols = known.top, known.seeds, known.symbols
    seed_of = np.concatenate([np.arange(seeds), seeds + known.shape_of[seeds:],
                              seeds + np.arange(SHAPES + 1)]).astype(np.uint16)
    sent = words is not None and symbols + known.beyond <= SENT_CLASSES
    if sent:
        got = words.select("sym", F.col("shape").cast("short").alias("shape")).toArrow()
        seed_of = np.concatenate([seed_of, np.empty(known.beyond, np.uint16)])
        seed_of[got.column("sym").to_numpy()] = got.column("shape").to_numpy() + seeds
        symbols += known.beyond
    size = seeds + SHAPES + 1
    pairs = near = others = None
    ref = sc.broadcast(seed_of)
    if words is not None and not sent:
        pairs = materialise(beyond_pairs(seqs, symbols), "lm-beyond-pairs")
        others = words.select("sym", (F.col("shape") + seeds).cast("int").alias("cls"))
        near = materialise(with_groups(pairs, others, ref, symbols), "lm-beyond-groups")
    seed_cls = exchange(pair_counts(seqs, ref, size, symbols, near))
    cls = seed_cls.astype(np.uint8)[seed_of]
    k = int(seed_cls.max()) + 1
    if others is not None:
        class_of = lambda g: F.element_at(
            F.array(*[F.lit(int(x)) for x in seed_cls]), F.col(g) + 1)
        others = materialise(others.select("sym", class_of("cls").alias("cls")), "lm-beyond-classes")
        near = materialise(near.select("b", "w", "n", class_of("cb").alias("cb"),
                                       class_of("cw").alias("cw")), "lm-beyond-groups")
    joint = pair_counts(seqs, sc.broadcast(cls), k, symbols, near)
    for sweep in range(sweeps if top + known.beyond > seeds else 0):
        cells = context_counts(seqs, sc.broadcast(cls), k, sweep % 2, known, symbols, near)
        moved = cells.mapInArrow(_moves("sym", sc.broadcast(joint), _symbol_cells),
                                 "sym int, held int, cls int").where("held <> cls")
        if others is not None:
            moved = materialise(moved, "lm-moved")
        inside = moved.where(F.col("sym") < symbols).select("sym", "cls").toArrow()
        new = cls.copy()
        new[inside.column("sym").to_numpy()] = inside.column("cls").to_numpy()
        ref, near_new, others_new = sc.broadcast(new), None, None
        if others is not None:
            to = moved.where(F.col("sym") >= symbols).select("sym", F.col("cls").alias("to"))
            others_new = materialise(others.join(to, "sym", "left").select(
                "sym", F.coalesce("to", "cls").alias("cls")), "lm-beyond-classes")
            near_new = materialise(with_groups(pairs, others_new, ref, symbols), "lm-beyond-groups")
        after = pair_counts(seqs, ref, k, symbols, near_new)
        if likelihood(after) <= likelihood(joint):
            break
        cls, joint, near, others = new, after, near_new, others_new
    if sent:
        cls, rest = cls[:known.symbols], sc.broadcast(cls[known.symbols:])

        def classes(batches):
            for batch in batches:
                sym = batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(rest.value[sym - known_symbols].astype(np.int32))],
                    names=["sym", "cls"])

        known_symbols = known.symbols
        others = words.select("sym").mapInArrow(classes, "sym int, cls int")
    return cls, joint, others


def place_rest(seqs: DataFrame, rest: DataFrame, known: Known, cls: np.ndarray,
               joint: np.ndarray) -> tuple[DataFrame, np.ndarray]:
    """``(word, c, cls)`` of the words ``rest (word, c)`` outside the known table, by
    the classes they follow, and the class matrix with them in their classes."""
    sc, k = seqs.sparkSession.sparkContext, len(joint)
    state = sc.broadcast(cls)

    def run(batches):
        group = state.value
        for batch in _parts(batches):
            flat, off = _symbols(batch)
            at = batch.column(batch.schema.get_field_index("at"))
            size = at.value_lengths().to_numpy(zero_copy_only=False)
            place = at.flatten().to_numpy(zero_copy_only=False)
            word = batch.column(batch.schema.get_field_index("word")).flatten().to_numpy(
                zero_copy_only=False)
            own = place > 0                           # else a token of the row before
            place, word = (np.repeat(off[:-1], size) + place)[own], word[own]
            unit, first, back = np.unique(word, return_index=True, return_inverse=True)
            key, n = np.unique(back * k + group[flat[place - 1]], return_counts=True)
            held = group[flat[place[first]]].astype(np.int64) * (2 * k + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(unit[key // k]), pa.array((held[key // k] + k + key % k).astype(np.int32)),
                 pa.array(n.astype(np.int64))], names=["word", "cell", "n"])

    cells = materialise(
        seqs.select("seq", "word", "at")
        .mapInArrow(run, "word long, cell int, n long")
        .join(rest.select("word"), "word", "left_semi")
        .groupBy("word", "cell").agg(F.sum("n").alias("n")), "lm-rest-cells")
    placed = materialise(
        cells.repartition("word").sortWithinPartitions("word", "cell")
        .mapInArrow(_moves("word", sc.broadcast(joint), _word_cells), "word long, held int, cls int"), "lm-rest")
    gone = (cells.join(placed.where("held <> cls"), "word")
            .groupBy((F.col("cell") % (2 * k + 1) - k).alias("ctx"), "held", "cls").agg(F.sum("n").alias("n"))
            .toArrow())
    joint = joint.copy()
    ctx, n = gone.column("ctx").to_numpy(), gone.column("n").to_numpy()
    np.subtract.at(joint, (ctx, gone.column("held").to_numpy()), n)
    np.add.at(joint, (ctx, gone.column("cls").to_numpy()), n)
    return materialise(rest.join(placed.select("word", "cls"), "word"), "lm-rest-classes"), joint


@dataclass
class Model:
    """What scoring needs besides the table of the other words."""

    known: Known
    cls: np.ndarray
    transition: np.ndarray    # log10 P(class | previous class)
    emission: np.ndarray      # log10 P(symbol | class) less the shape's denominator
    size: np.ndarray          # log10 of the classes' denominators
    train_tokens: int
    distinct: int
    train_docs: int
    classed_tokens: int       # training words with a class of their own


def fit(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model over training rows ``(text)`` and the table ``(word, c, cls)`` of the
    words outside the known ones; the class is null for words that go by their
    shape."""
    counts = materialise(word_counts(texts), "word-counts")
    known = known_words(counts)
    sc = texts.sparkSession.sparkContext
    beyond = beyond_table(counts, known) if known.linked else None
    seqs = sequences(texts, sc.broadcast(known))
    if beyond is None:
        seqs = materialise(seqs, "lm-sequences")
    else:
        whole = materialise(seqs.withColumn("row", F.monotonically_increasing_id()), "lm-sequences")
        seqs = materialise(link(whole, beyond), "lm-linked")
        discard(whole)
    cls, joint, placed = cluster(seqs, known, words=beyond)
    k = len(joint)
    others = counts.where(known.outside()).select("word", "c")
    rare = F.col("c") < MIN_COUNT
    stats = counts.groupBy("shape").agg(
        F.sum(rare.cast("long")).alias("v"), F.sum(F.when(rare, F.col("c")).otherwise(0)).alias("n"),
        F.count(F.lit(1)).alias("words"), F.sum("c").alias("tokens")).collect()
    v, n = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in stats:
        v[r["shape"]], n[r["shape"]] = r["v"], r["n"]
    members = np.bincount(cls, minlength=k)
    if beyond is not None:
        placed = materialise(beyond.join(placed, "sym").select("word", "c", "cls"),
                             "lm-beyond-placed")
    elif known.open:
        placed, joint = place_rest(seqs, others.where(F.col("c") >= MIN_COUNT), known, cls, joint)
    discard(seqs)
    if placed is not None:
        for r in placed.groupBy("cls").agg(F.count(F.lit(1)).alias("n")).collect():
            members[r["cls"]] += r["n"]
    unigram = (joint.sum(0) + 1) / (joint.sum() + k)
    transition = np.log10((joint + BACKOFF * unigram) / (joint.sum(1, keepdims=True) + BACKOFF))
    words = sum(r["tokens"] for r in stats)
    docs = int(joint.sum()) - words
    seen = np.empty(known.symbols)
    own = known.symbol >= 0
    seen[known.symbol[own]] = known.counts[own]
    seen[known.top:known.end], seen[known.end] = n, docs
    size = np.log10(np.maximum(joint.sum(0) + 0.5 * members, 0.5))
    emission = np.log10(seen + 0.5) - size[cls]
    emission[known.top:known.end] -= np.log10(n + v + 1)
    if placed is None:
        others = others.select("word", "c", F.lit(None).cast("int").alias("cls"))
    else:
        others = materialise(others.join(placed.select("word", "cls"), "word", "left"), "lm-others")
        discard(counts)
    distinct = sum(r["words"] for r in stats) + (docs > 0)
    return Model(known, cls, transition, emission, size, words + docs, distinct, docs,
                 words - int(n.sum())), others


def score(docs: DataFrame, model: Model, others: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Words outside the known table are looked up by a join on the word; only
    they are shuffled.  Where they are symbols, the word after them is scored
    anew as well.  Null texts are empty: their one token is the end.
    """
    ref = docs.sparkSession.sparkContext.broadcast(model)
    linked, k = model.known.linked and model.known.open, len(model.transition)
    denominator = float(np.log10(model.train_tokens + model.distinct + 1))

    def run(batches):
        m = ref.value
        end_log = np.log10(m.train_docs + 1)
        for part, data, off in tx.pieces(batches):
            n = part.num_rows
            h, count, sym, doc, place, full, owner = _sequence(data, off, m.known)
            before = np.concatenate(([m.known.end], full[:-1]))
            step = m.transition[m.cls[before], m.cls[full]] + m.emission[full]
            own = np.where(count > 0, np.log10(count + 1.0), 0.0)
            rare = sym >= m.known.top
            tail = np.flatnonzero(count == 0)
            at = place[tail]
            near = (m.cls[before[at]].astype(np.int32) * SHAPES
                    + (full[at] - m.known.top).astype(np.int32)) * k + m.cls[full[at + 1]]
            tokens = np.bincount(owner, minlength=n)
            total = lambda d, w: np.bincount(d, weights=w, minlength=n)
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.array(tokens, pa.int64()),
                pa.array(np.bincount(doc[count > 0], minlength=n) + (m.train_docs > 0), pa.int64()),
                pa.array(total(doc, own) + end_log - tokens * denominator),
                pa.array(total(owner, step) + total(doc[rare], own[rare])),
                pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(doc[tail], np.arange(n + 1)), pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(h[tail].view(np.int64)), pa.array(near),
                         pa.array(at.astype(np.int32))], names=["word", "near", "at"])),
            ], names=["uid", "doc_id", "n_tokens", "known", "base", "model", "tail"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    part = materialise(rows.mapInArrow(
        run, "uid long, doc_id long, n_tokens long, known long, base double, model double, "
             "tail array<struct<word: long, near: int, at: int>>"), "lm-parts")
    top, end = model.known.top, model.known.end
    shape_cls = model.cls[top:end].astype(int)
    frame = docs.sparkSession.createDataFrame
    # Tables of fixed size: a step between classes, and one to or from a shape.
    step = frame([(i, j, float(x)) for (i, j), x in np.ndenumerate(model.transition)],
                 "ctx int, cls int, move double")
    to_shape = frame([(i, j, float(x)) for (i, j), x in np.ndenumerate(
        model.transition[:, shape_cls] + model.emission[top:end])], "ctx int, shape int, step double")
    by_shape = F.log10(F.col("c") + 1)
    found = (part.select("uid", F.explode("tail").alias("t")).select("uid", "t.*")
             .join(others, "word").drop("word"))
    ctx = F.floor(F.col("near") / (SHAPES * k)).cast("int")
    again = F.lit(0.0)
    if linked:
        # A class found here is the context of the next word; if that one is found
        # as well, its own step tells, else the step after changes.
        row = Window.partitionBy("uid").orderBy("at")
        before, after = F.lag("at").over(row), F.lead("at").over(row)
        found = found.withColumns({
            "ctx": F.when(before == F.col("at") - 1, F.lag("cls").over(row)),
            "told": F.coalesce((after == F.col("at") + 1) & F.lead("cls").over(row).isNotNull(),
                               F.lit(False))})
        ctx = F.coalesce("ctx", ctx)
    found = found.select("uid", "c", "cls", *(["told"] if linked else []), ctx.alias("ctx"),
                         (F.floor(F.col("near") / k) % SHAPES).cast("int").alias("shape"),
                         (F.col("near") % k).alias("next"),
                         F.floor(F.col("near") / (SHAPES * k)).cast("int").alias("was"))
    if linked:
        after = frame([(i, j, float(x)) for (i, j), x in np.ndenumerate(model.transition[shape_cls])],
                      "shape int, next int, after double")
        found = (found.join(F.broadcast(after), ["shape", "next"])
                 .join(F.broadcast(step.toDF("cls", "next", "then")), ["cls", "next"], "left"))
        again = F.when(F.col("told"), 0.0).otherwise(
            F.coalesce(F.col("then") - F.col("after"), again))
    size_of = F.element_at(F.array(*[F.lit(float(x)) for x in model.size]), F.col("cls") + 1)
    emission = F.log10(F.col("c") + 0.5) - size_of
    tail = (found.join(F.broadcast(to_shape.withColumnRenamed("ctx", "was")), ["was", "shape"])
            .join(F.broadcast(step), ["ctx", "cls"], "left")
            .groupBy("uid").agg(
                F.sum(by_shape).alias("more"),
                F.sum(again + F.coalesce(F.col("move") + emission - F.col("step"),
                                         by_shape)).alias("change"),
                F.count(F.lit(1)).alias("found")))
    none = F.lit(0.0)
    return part.join(tail, "uid", "left").select(
        "doc_id", "n_tokens",
        (F.col("known") + F.coalesce("found", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", none)).alias("base_score"),
        (F.col("model") + F.coalesce("change", none)).alias("score"))


def score_held_out(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold and score every row."""
    out = held_out(F.col("doc_id"), folds, fold)
    texts = docs.where(~out).select(F.col("text").cast("string").alias("text"))
    model, others = fit(texts)
    return score(docs, model, others).withColumn("held_out", out)
