"""Toxicity scores from gradient-boosted trees over dense features.

Labelled rows are split in three by a hash of their id.  On the first part a
lexicon is learned: words and word beginnings that occur in far more toxic than
other documents.  On the second, boosted trees are fitted over dense features
(lexicon densities, proximity to second-person words, capitals, punctuation and
obfuscation rates).  On the third, isotonic regression calibrates the trees'
scores.  Parts are disjoint, so no step sees its own training error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textops as tx
from tessera.plans.joins import materialise

SAMPLE_PER_CLASS = 6000   # labelled rows per class at most that models are fitted on
LEXICON_SIZE = 4000       # learned entries at most, best first
MIN_TOXIC_DOCS = 3        # an entry must occur in this many toxic sample documents
MIN_LOG_ODDS = 1.5
PREFIXES = (4, 5, 6, 7)   # bytes of a word beginning
NEAR = 5                  # words around a second-person word
TREES, DEPTH = 20, 4

# Second-person words, and common insults as a starting lexicon.
SECOND_PERSON = ("you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir "
                 "dein deine ihr euch euer sie tú ti tus usted ustedes vosotros os").split()
INSULTS = ("idiot idiots stupid moron morons loser losers scum trash clown pathetic worthless "
           "disgusting dumb fool ugly hate bastard bitch shit fuck fucking asshole crap jerk "
           "idiote imbécile crétin connard salope merde débile ordure dummkopf arschloch "
           "scheiße schwein abschaum trottel idiota estúpido imbécil basura mierda cabrón "
           "payaso patético asqueroso").split()

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = True
_MASKING = np.zeros(256, bool)   # symbols and digits that hide a letter inside a word
_MASKING[[ord(c) for c in "*@$#!0134578|+%&"]] = True

FEATURES = ("word_hits", "prefix_hits", "seed_hits", "word_weight", "prefix_weight",
            "max_weight", "distinct_hits", "hit_count", "near_second", "second_rate",
            "upper_rate", "caps_word_rate", "exclaim_rate", "question_rate", "punct_rate",
            "obfuscation_rate", "word_length", "log_words")


@dataclass
class Lexicon:
    """Sorted hashes with their log odds, for words and for word beginnings."""

    words: np.ndarray
    word_odds: np.ndarray
    prefixes: np.ndarray
    prefix_odds: np.ndarray


def _known(words) -> np.ndarray:
    joined = [w.encode() for w in words]
    data = np.frombuffer(b" ".join(joined), np.uint8)
    start, end, _ = _letter_words(data, np.array([0, len(data)]))
    return np.unique(tx.span_hash(data, start, end))


def _letter_words(data: np.ndarray, off: np.ndarray):
    """Runs of letters (bytes of non-ASCII characters count as letters)."""
    n = len(data)
    if n == 0:
        z = np.empty(0, np.int64)
        return z, z, z
    inside = _LETTER[data]
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(off, start, "right") - 1


def _prefix_hashes(data, start, end):
    """``(hash, word index)`` of every word beginning of the given lengths."""
    hashes, at = [], []
    for n in PREFIXES:
        long = np.flatnonzero(end - start > n)
        hashes.append(tx.span_hash(data, start[long], start[long] + n) ^ np.uint64(n))
        at.append(long)
    return np.concatenate(hashes), np.concatenate(at)


def _lookup(table: np.ndarray, odds: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Log odds of each hash, 0 if it is not in the table."""
    if len(table) == 0 or len(h) == 0:
        return np.zeros(len(h))
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return np.where(table[at] == h, odds[at], 0.0)


def _features(data, off, lex: Lexicon, second: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    n = len(off) - 1
    start, end, doc = _letter_words(data, off)
    h = tx.span_hash(data, start, end) if len(start) else np.empty(0, np.uint64)
    total = lambda x: np.bincount(doc, weights=x, minlength=n)

    def per_text(mask):
        acc = np.zeros(len(data) + 1, np.int64)
        np.cumsum(mask, out=acc[1:])
        return (acc[off[1:]] - acc[off[:-1]]).astype(float)

    word_odds = _lookup(lex.words, lex.word_odds, h)
    prefix_odds = np.zeros(len(h))
    if len(h):
        ph, at = _prefix_hashes(data, start, end)
        np.maximum.at(prefix_odds, at, _lookup(lex.prefixes, lex.prefix_odds, ph))
    seed = np.isin(h, seeds).astype(float)
    odds = np.maximum(word_odds, prefix_odds)
    hit = (odds > 0) | (seed > 0)
    you = np.isin(h, second)
    # A hit is near a second-person word of the same text within NEAR words.
    near = np.zeros(len(h))
    at_you = np.flatnonzero(you)
    at_hit = np.flatnonzero(hit)
    if len(at_you) and len(at_hit):
        right = np.searchsorted(at_you, at_hit)
        for side in (right - 1, np.minimum(right, len(at_you) - 1)):
            ok = side >= 0
            to = at_you[np.maximum(side, 0)]
            near[at_hit[ok & (np.abs(to - at_hit) <= NEAR) & (doc[to] == doc[at_hit])]] = 1
    words = np.maximum(total(np.ones(len(h))), 1)
    best = np.zeros(n)
    np.maximum.at(best, doc, odds)
    # Distinct hits: one per (text, word).
    pair = np.unique(np.stack([doc[at_hit], h[at_hit].view(np.int64)]), axis=1)[0]
    upper = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_UPPER[data], out=upper[1:])
    caps = ((upper[end] - upper[start]) == (end - start)) & (end - start > 2)
    inner = np.zeros(len(data), bool)
    if len(data) > 2:
        inner[1:-1] = _MASKING[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
    size = np.maximum(np.diff(off), 1).astype(float)
    return np.stack([
        total(word_odds > 0) / words, total(prefix_odds > 0) / words, total(seed) / words,
        total(word_odds) / words, total(prefix_odds) / words, best,
        np.bincount(pair, minlength=n).astype(float), total(hit), total(near),
        total(you) / words, per_text(_UPPER[data]) / size, total(caps) / words,
        per_text(data == 33) / size, per_text(data == 63) / size, per_text(_PUNCT[data]) / size,
        per_text(inner) / words, total(end - start) / words, np.log(words)], axis=1)


def features(docs: DataFrame, lex: Lexicon, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and ``features array<double>``."""
    second, seeds = _known(SECOND_PERSON), _known(INSULTS)
    more = [c for c in keep if c not in ("doc_id", "text")]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"), *(F.col(f"`{c}`") for c in more))
    out = ["doc_id", *(["text"] if "text" in keep else []), *more]
    fields = [narrow.schema[c] for c in out]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def run(batches):
        for part, data, off in tx.pieces(batches):
            x = _features(data, off, lex, second, seeds)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.get_field_index(c)) for c in out),
                 tx.lists(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())],
                names=[*out, "features"])

    return narrow.mapInArrow(run, schema + ", features array<double>")


def _unit_counts(rows: DataFrame) -> DataFrame:
    """``(kind, unit, toxic, n)``: sample documents with each word or beginning."""
    def run(batches):
        for part, data, off in tx.pieces(batches):
            start, end, doc = _letter_words(data, off)
            if len(start) == 0:
                continue
            toxic = np.array(part.column(0).to_pylist(), np.int64)
            ph, at = _prefix_hashes(data, start, end)
            for kind, h, d in ((0, tx.span_hash(data, start, end), doc), (1, ph, doc[at])):
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                h, t = h[new], toxic[d[new]]
                unit, first = np.unique(h, return_index=True)
                count = np.diff(np.append(first, len(h)))
                bad = np.add.reduceat(t, first) if len(h) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unit), kind, np.int32)), pa.array(unit.view(np.int64)),
                     pa.array(bad.astype(np.int64)), pa.array((count - bad).astype(np.int64))],
                    names=["kind", "unit", "bad", "good"])

    return (rows.select(F.col("toxic").cast("int").alias("toxic"), "text")
            .mapInArrow(run, "kind int, unit long, bad long, good long")
            .groupBy("kind", "unit").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))


def learn_lexicon(rows: DataFrame, n_bad: int, n_good: int) -> Lexicon:
    """The ``LEXICON_SIZE`` units with the strongest evidence, from the bounded
    sample ``(toxic, text)``."""
    log_odds = (F.log((F.col("bad") + 0.5) / F.lit(n_bad + 1.0))
                - F.log((F.col("good") + 0.5) / F.lit(n_good + 1.0)))
    top = (_unit_counts(rows).where(F.col("bad") >= MIN_TOXIC_DOCS)
           .withColumn("odds", log_odds).where(F.col("odds") >= MIN_LOG_ODDS)
           .orderBy((F.col("odds") * F.col("bad")).desc(), "kind", "unit").limit(LEXICON_SIZE)
           .toArrow())
    kind = top.column("kind").to_numpy()
    unit = top.column("unit").to_numpy().astype(np.int64).view(np.uint64)
    odds = top.column("odds").to_numpy()
    out = []
    for k in (0, 1):
        mine = np.flatnonzero(kind == k)
        mine = mine[np.argsort(unit[mine])]
        out += [unit[mine], odds[mine]]
    return Lexicon(*out)


def score(docs: DataFrame, labelled: DataFrame, per_class: int = SAMPLE_PER_CLASS,
          keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and ``score`` for every row of
    ``docs``, learned from ``labelled`` ``(doc_id, toxic)`` whose texts are
    looked up in ``docs``.

    At most ``per_class`` rows of each class are used, chosen by id hash and
    weighted back to the class sizes; this bound is what allows broadcasting
    them.  Null ids or labels are skipped; an id labelled twice counts as toxic
    if either label is.  With one class only, every score is that class.  Null
    and empty texts are scored from their (zero) features.
    """
    labels = (labelled.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.col("toxic").cast("int").alias("toxic"))
              .where("doc_id is not null and toxic in (0, 1)")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    size = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    def constant(classes):
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep,
                           F.lit(float(max(classes, default=0))).alias("score"))

    if len(size) < 2:
        return constant(size)
    order = F.xxhash64("doc_id", F.lit(17))
    picked = [labels.where(F.col("toxic") == t).orderBy(order, "doc_id").limit(per_class)
              for t in (0, 1)]
    weight = {t: size[t] / min(size[t], per_class) for t in (0, 1)}
    sample = picked[0].union(picked[1]).withColumn(
        "weight", F.when(F.col("toxic") == 1, weight[1]).otherwise(weight[0]))
    sample = sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(10)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
    rows = materialise(texts.join(F.broadcast(sample), "doc_id"), "tox-sample")
    present = {r["toxic"] for r in rows.select("toxic").distinct().collect()}
    if len(present) < 2:                              # labels of other documents
        return constant(present)
    first = rows.where("part < 4")
    have = {r["toxic"]: r["n"] for r in first.groupBy("toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    lex = learn_lexicon(first, have.get(1, 0), have.get(0, 0))
    x = materialise(features(rows, lex, ("toxic", "weight", "part")), "tox-features")
    # The sample is bounded: in one sorted partition sums have one order, so that
    # runs agree to the last bit.
    x = x.repartition(1).sortWithinPartitions("doc_id", "features")
    x = x.withColumn("x", array_to_vector("features")).withColumn("y", F.col("toxic").cast("double"))
    fit, tune = x.where("part >= 4 and part < 8"), x.where("part >= 8")
    if fit.select("y").distinct().count() < 2:        # too few labels to hold parts out
        fit = x
    if tune.select("y").distinct().count() < 2:
        tune = x
    trees = GBTClassifier(featuresCol="x", labelCol="y", weightCol="weight", maxIter=TREES,
                          maxDepth=DEPTH, seed=11).fit(fit)
    raw = lambda df: trees.transform(df).withColumn("p", vector_to_array("probability")[1])
    iso = IsotonicRegression(featuresCol="p", labelCol="y", weightCol="weight",
                             predictionCol="score").fit(raw(tune))
    every = features(docs, lex, keep).withColumn("x", array_to_vector("features"))
    return iso.transform(raw(every)).select(
        "doc_id", *keep, F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether ``crc32`` of the id's text falls in the held-out fold (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def classify(docs: DataFrame, labelled: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` with labels of the held-out fold
    never used."""
    out = held_out(F.col("doc_id"), folds, fold)
    return score(docs, labelled.where(~out)).select(
        "doc_id", out.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def reject(docs: DataFrame, labelled: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns, that are not predicted toxic.  The
    columns pass through the scoring, so no join brings them back.  Columns
    named like the model's own (``features``, ``x``, ``p``, ``score`` and the
    trees' outputs) are carried under other names meanwhile."""
    out = held_out(F.col("doc_id"), folds, fold)
    names = docs.columns
    inner = ["doc_id" if c == "doc_id" else "text" if c == "text" else f"_c{i}"
             for i, c in enumerate(names)]
    plain = docs.toDF(*inner)
    keep = tuple(c for c in inner if c != "doc_id")
    good = score(plain, labelled.where(~out), keep=keep).where("score < 0.5")
    return good.select(*(F.col(i).alias(c) for i, c in zip(inner, names)))
