"""Language identification with error-correcting output codes.

Every learned language gets a codeword.  One binary classifier per code bit, a
log-odds model over hashed byte n-grams, separates the languages with bit 1
from those with bit 0.  A text's margins are compared with all codewords under
a logistic loss, weighted by how well each bit separates its training
languages; the nearest codeword wins, and a small gap to the second flags the
prediction as ambiguous.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import textops as tx

BUCKETS = 4096            # per n-gram length
GRAMS = (2, 3, 4)
MIN_BITS = 7
SHARPNESS = 20.0          # scales mean log-odds per n-gram to a margin
AMBIGUOUS_GAP = 0.05      # of the normalised loss
UNKNOWN = "und"


def _cells(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat ``(cell, doc)`` of all n-grams that lie inside one text."""
    low = tx.LOWER[data].astype(np.uint32)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    cells, docs = [], []
    for i, n in enumerate(GRAMS):
        k = len(low) - n + 1
        if k <= 0:
            continue
        h = np.zeros(k, np.uint32)
        for j in range(n):
            h = h * np.uint32(0x01000193) ^ low[j:k + j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(12)
        inside = doc[:k] == doc[n - 1:]
        cells.append((h[inside] & np.uint32(BUCKETS - 1)).astype(np.int64) + i * BUCKETS)
        docs.append(doc[:k][inside])
    if not cells:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(cells), np.concatenate(docs)


WIDTH = BUCKETS * len(GRAMS)
_PIECE_ROWS = 256         # bounds the rows x cells matrix of a piece


def count_cells(rows: DataFrame) -> DataFrame:
    """``(lang, cell, n)`` over rows ``(lang, text)``; each task sends one row
    per language and cell at most."""
    def run(batches):
        total: dict[str, np.ndarray] = {}
        for part, data, off in tx.pieces(batches, rows=_PIECE_ROWS):
            names = np.array(part.column(0).to_pylist(), object)
            cell, doc = _cells(data, off)
            for lang in set(names.tolist()):
                mine = np.flatnonzero(names == lang)
                take = np.zeros(len(names), bool)
                take[mine] = True
                got = np.bincount(cell[take[doc]], minlength=WIDTH)
                total[lang] = total[lang] + got if lang in total else got
        for lang, got in total.items():
            at = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(got[at].astype(np.int64))], names=["lang", "cell", "n"])

    out = rows.select(F.col("lang").cast("string").alias("lang"),
                      F.col("text").cast("string").alias("text"))
    return (out.mapInArrow(run, "lang string, cell int, n long")
            .groupBy("lang", "cell").agg(F.sum("n").alias("n")))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """``n`` distinct codewords of -1/+1.  Up to five languages get the
    exhaustive code, more a random one of ``10 * log2(n)`` bits."""
    if n == 1:
        return np.ones((1, 1))
    if n <= 5:
        cols = [c for c in itertools.product((-1, 1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(cols, float).T
    bits = max(MIN_BITS, int(np.ceil(10 * np.log2(n))))
    rng, best, far = np.random.default_rng(seed), None, -1
    for _ in range(50):
        code = rng.choice((-1.0, 1.0), size=(n, bits))
        code = code[:, np.abs(code.sum(0)) < n]       # a bit must split the languages
        gap = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if gap > far:
            best, far = code, gap
    return best


class Model:
    """Languages, codewords, and per bit the cell weights, bias and weight."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.langs = sorted(counts)
        freq = np.array([counts[x] for x in self.langs], float)
        prob = np.empty_like(freq)
        for i in range(len(GRAMS)):                    # each n-gram length sums to one
            block = slice(i * BUCKETS, (i + 1) * BUCKETS)
            prob[:, block] = freq[:, block] + 0.5
            prob[:, block] /= prob[:, block].sum(1, keepdims=True)
        self.code = codewords(len(self.langs))
        # A bit's class is the even mixture of its languages, so that a common
        # language does not outvote a rare one.
        bits = self.code.shape[1]
        self.weights = np.zeros((WIDTH, bits))
        self.bit_weight = np.ones(bits)
        for b in range(bits):
            one, zero = self.code[:, b] > 0, self.code[:, b] < 0
            if not zero.any():
                continue
            odds = np.log(prob[one].mean(0)) - np.log(prob[zero].mean(0))
            self.weights[:, b] = odds
            # Expected margin of each language on this bit: weak bits count less.
            sep = (prob @ odds) / len(GRAMS) * self.code[:, b]
            self.bit_weight[b] = max(float(np.tanh(SHARPNESS * sep.mean())), 0.05)

    def predict(self, cell: np.ndarray, doc: np.ndarray, n_docs: int):
        """``(language index, score, ambiguous)`` per document."""
        counts = np.bincount(doc * WIDTH + cell, minlength=n_docs * WIDTH).reshape(n_docs, WIDTH)
        total = np.maximum(counts.sum(1, keepdims=True), 1)
        margin = SHARPNESS * (counts @ self.weights) / total
        loss = np.logaddexp(0.0, -margin[:, None, :] * self.code[None])
        loss = (loss * self.bit_weight).sum(2) / self.bit_weight.sum()
        best = loss.argmin(1)
        like = np.exp(-self.code.shape[1] * (loss - loss.min(1, keepdims=True)))
        score = 1.0 / like.sum(1)
        if loss.shape[1] > 1:
            two = np.partition(loss, 1, axis=1)
            ambiguous = two[:, 1] - two[:, 0] < AMBIGUOUS_GAP
        else:
            ambiguous = np.zeros(n_docs, bool)
        return best, score, ambiguous


def fit(rows: DataFrame) -> Model | None:
    """Learn from all rows ``(lang, text)`` with a language.  What reaches the
    driver is one count per language and cell (``WIDTH`` cells).  No rows: None."""
    counts: dict[str, np.ndarray] = {}
    got = count_cells(rows.where("lang is not null")).toArrow()
    langs = np.array(got.column("lang").to_pylist(), object)
    cells, n = got.column("cell").to_numpy(), got.column("n").to_numpy()
    for lang in sorted(set(langs.tolist())):
        mine = langs == lang
        counts[lang] = np.bincount(cells[mine], weights=n[mine], minlength=WIDTH)
    return Model(counts) if counts else None


def _letters(part, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each text holds a letter."""
    low = tx.LOWER[data]
    ascii_letter = np.zeros(len(data) + 1, np.int64)
    np.cumsum((low >= 97) & (low <= 122), out=ascii_letter[1:])
    has = (ascii_letter[off[1:]] - ascii_letter[off[:-1]]) > 0
    rest = np.flatnonzero(~has & (np.diff(off) > 0))
    texts = part.column(part.schema.get_field_index("text"))
    for i in rest.tolist():
        has[i] = any(c.isalpha() for c in texts[i].as_py())
    return has


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score, ambiguous)`` for every row.

    ``und`` with score 0 if the text is null or holds no letter, or nothing was
    learned.  One narrow pass; the model (cells x bits) travels in the closure.
    """
    def run(batches):
        for part, data, off in tx.pieces(batches, rows=_PIECE_ROWS):
            n = part.num_rows
            has = _letters(part, data, off)
            if model is None:
                names, score, amb = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
            else:
                cell, doc = _cells(data, off)
                best, score, amb = model.predict(cell, doc, n)
                names = [model.langs[b] if h else UNKNOWN for b, h in zip(best, has)]
                score, amb = np.where(has, score, 0.0), amb | ~has
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(amb)],
                names=["doc_id", "lang_pred", "score", "ambiguous"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(
        run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    """Whether ``crc32`` of the id's text falls in the held-out fold (null: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict every row."""
    out = held_out(F.col("doc_id"), folds, fold)
    model = fit(docs.where(~out).select("lang", "text"))
    return predict(docs, model).withColumn("held_out", out)
