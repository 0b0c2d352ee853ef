"""Quality rules with cross-document line frequency.

Lines are normalised (trimmed, ASCII letters lowered, digits folded to ``0``,
white space runs collapsed) and hashed.  A line's frequency on a host is the
number of distinct documents of that host that hold it.  Lines above the limit
are removed, and a document that keeps too little of its words is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textops as tx
from tessera.plans.joins import materialise

MIN_WORDS = 20            # base rule: fewer words fail
MAX_REPEAT_PERCENT = 30   # base rule: share of words in repeated 8-word windows
WINDOW_WORDS = 8
LINE_MIN_DOCS = 10        # a line is common on a host from this many documents ...
LINE_SHARE = 0.005        # ... that are also more than this share of the host's
MIN_KEPT_SHARE = 0.5      # a document must keep this share of its word characters

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_FOLD = tx.LOWER.copy()
_FOLD[48:58] = 48

BASE_SCHEMA = ("uid long, doc_id long, host string, n_words long, word_chars long, n_symbols long, "
               "n_dup_lines long, n_repeat_words long, lines array<long>, "
               "line_chars array<long>")


def _sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _repeat_words(words: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> np.ndarray:
    """Words covered by a ``width``-word window that occurs twice in the text."""
    k = len(words)
    out = np.zeros(n_docs, np.int64)
    if k < width:
        return out
    mult = [np.uint64(pow(0x2545F4914F6CDD1D, i + 1, 1 << 64)) for i in range(width)]
    h = np.zeros(k - width + 1, np.uint64)
    for i in range(width):
        h += words[i:k - width + 1 + i] * mult[i]
    at = np.flatnonzero(doc[:k - width + 1] == doc[width - 1:])
    if len(at) == 0:
        return out
    key = tx.mix(h[at] + doc[at].astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = at[order[twice]]
    cover = np.zeros(k + 1, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + width, -1)
    covered = np.cumsum(cover)[:k] > 0
    return np.bincount(doc[covered], minlength=n_docs)


def _measure(batches):
    for part, data, off in tx.pieces(batches):
        n_docs = part.num_rows
        start, end, doc = tx.word_spans(data, off)
        lead = (data & 0xC0) != 0x80                        # first byte of a code point
        raw = tx.span_hash(data, start, end, lower=False)
        word_chars = _sums(lead & ~tx.WHITE[data], off)
        # Lines: cut at \n and at text ends; only lines with a word count.
        brk = np.flatnonzero(data == 10)
        l_start = np.unique(np.concatenate([off[:-1], brk + 1]))
        l_start = l_start[l_start < len(data)]
        l_first = np.searchsorted(start, l_start)
        has = np.zeros(len(l_start), bool)
        l_doc = np.searchsorted(off, l_start, "right") - 1
        l_end = np.append(l_start[1:], len(data))
        l_end = np.minimum(l_end, off[l_doc + 1])
        last = np.searchsorted(start, l_end)
        has = last > l_first
        l_start, l_end, l_doc = l_start[has], l_end[has], l_doc[has]
        l_first, last = l_first[has], last[has]
        stop = l_end - ((l_end > l_start) & (data[l_end - 1] == 10))
        exact = tx.span_hash(data, l_start, stop, lower=False) if len(l_start) else np.empty(0, np.uint64)
        key = tx.mix(exact + (l_doc + 1).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        seen = np.zeros(len(key), bool)
        if len(key):
            order = np.argsort(key, kind="stable")
            seen[order[1:]] = key[order][1:] == key[order][:-1]
        dup_lines = np.bincount(l_doc[seen], minlength=n_docs)
        # Normalised line: the sequence of folded words.
        if len(l_start):
            folded = tx.span_hash(_FOLD[data], start, end, lower=False)
            place = (np.arange(len(start)) - np.repeat(l_first, last - l_first)).astype(np.uint64)
            up, _ = tx._Powers.get(len(start) + 2)
            line_hash = tx.mix(np.add.reduceat(folded * up[place + np.uint64(1)], l_first))
            chars = np.zeros(len(data) + 1, np.int64)
            np.cumsum(lead & ~tx.WHITE[data], out=chars[1:])
            line_chars = chars[l_end] - chars[l_start]
            # Distinct lines of a document with the characters of all their copies.
            order = np.lexsort((line_hash, l_doc))
            h, d, c = line_hash[order], l_doc[order], line_chars[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
            at = np.flatnonzero(new)
            h, d, c = h[at], d[at], np.add.reduceat(c, at)
        else:
            h, d, c = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        per_doc = np.bincount(d, minlength=n_docs)
        yield pa.RecordBatch.from_arrays([
            part.column(3), part.column(0), part.column(2),
            pa.array(np.bincount(doc, minlength=n_docs), pa.int64()),
            pa.array(word_chars, pa.int64()),
            pa.array(_sums(_SYMBOL[data], off), pa.int64()),
            pa.array(dup_lines, pa.int64()),
            pa.array(_repeat_words(raw, doc, n_docs, WINDOW_WORDS), pa.int64()),
            tx.lists(h.view(np.int64), per_doc, pa.int64()),
            tx.lists(c, per_doc, pa.int64()),
        ], names=["uid", "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                  "n_repeat_words", "lines", "line_chars"])


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per row the base counts and its distinct normalised lines; ``uid`` is the
    row's own key (fixed once the result is written).

    Columns other than ``doc_id``, ``text`` and ``host`` are ignored.  A null
    or blank text has no words and no lines.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"),
                         F.col(host).cast("string").alias("host"),
                         F.monotonically_increasing_id().alias("uid"))
    return narrow.mapInArrow(_measure, BASE_SCHEMA)


def common_lines(measured: DataFrame, min_docs: int = LINE_MIN_DOCS,
                 share: float = LINE_SHARE) -> DataFrame:
    """``(host, line)`` held by at least ``min_docs`` distinct documents of the
    host and by more than ``share`` of its rows.

    Each row lists a line once, so counting rows counts documents, less the
    further rows of ids that repeat; all counts combine on the map side, so a hot
    line or host costs one row per task.  Rows without id add to no line.
    """
    host_docs = measured.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"))
    each = measured.select("doc_id", F.coalesce("host", F.lit("")).alias("host"),
                           F.explode("lines").alias("line"))
    lines = each.groupBy("host", "line").agg(F.count("doc_id").alias("n")).where(
        F.col("n") >= min_docs)
    again = materialise(measured.groupBy("doc_id").agg(F.count("doc_id").alias("c")).where("c > 1")
                        .select("doc_id"), "repeated-ids")
    if again.limit(1).count():
        more = (each.join(again, "doc_id", "left_semi").groupBy("host", "line")
                .agg((F.count("doc_id") - F.count_distinct("doc_id")).alias("more")))
        lines = lines.join(more, ["host", "line"], "left").select(
            "host", "line", (F.col("n") - F.coalesce("more", F.lit(0))).alias("n")).where(
            F.col("n") >= min_docs)
    return (lines.join(host_docs, "host")
            .where(F.col("n") > F.col("host_docs") * F.lit(share)).select("host", "line"))


def quality(docs: DataFrame, host: str = "source", min_docs: int = LINE_MIN_DOCS,
            share: float = LINE_SHARE, min_kept: float = MIN_KEPT_SHARE) -> DataFrame:
    """One row per row of ``docs`` with base counts, ``base_failed`` and ``kept``.

    Null text or no words: all counts 0, fails the base rule.  A null host is a
    host of its own.  Rows that repeat a ``doc_id`` are measured one by one, but
    count as one document of a line.
    ``removed_chars`` are word characters of common lines; ``kept`` is false if
    the base rule fails or less than ``min_kept`` of the characters remain.
    """
    measured = materialise(measure(docs, host), "quality-lines")
    common = materialise(common_lines(measured, min_docs, share), "common-lines")
    rows = (measured.select("uid", F.coalesce("host", F.lit("")).alias("host"),
                            F.explode(F.arrays_zip("lines", "line_chars")).alias("l"))
            .select("uid", "host", F.col("l.lines").alias("line"),
                    F.col("l.line_chars").alias("chars")))
    removed = (rows.join(common, ["host", "line"])
               .groupBy("uid").agg(F.sum("chars").alias("removed_chars"),
                                   F.count(F.lit(1)).alias("removed_lines")))
    base = measured.drop("lines", "line_chars", "host")
    out = base.join(removed, "uid", "left").drop("uid").fillna(0, ["removed_chars", "removed_lines"])
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    enough = (F.col("word_chars") - F.col("removed_chars")) >= F.col("word_chars") * F.lit(min_kept)
    return (out.withColumn("base_failed", failed)
            .withColumn("kept", ~failed & enough))
