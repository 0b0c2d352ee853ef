import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import brown
from tessera.llm import textops as tx
from tessera.plans import joins
from llm_fixtures import *  # noqa: F401,F403


def tokens(text):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall("[^\x20\x09-\x0D]+", (text or "").translate(up)) + [None]


@pytest.mark.parametrize("known", [1 << 19, 60])
def test_base_score_equals_brute_force(spark, words, monkeypatch, known):
    monkeypatch.setattr(brown.known_words, "__defaults__", (known, 30))
    rows = [(i, words(i % 50) + (" Rare%d" % i)) for i in range(150)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in brown.score_held_out(df).collect()}
    c = Counter()
    for d, t in rows:
        if zlib.crc32(str(d).encode()) % 7 != 2:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    for d, t in rows:
        w, r = tokens(t), got[d]
        assert r.held_out == (zlib.crc32(str(d).encode()) % 7 == 2)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w))
        assert r.score < 0


def test_exchange_never_lowers_the_likelihood(rng):
    m = np.array([[rng.choice((0, 0, 1, 5, 20)) for _ in range(24)] for _ in range(24)], float)

    def fit(cls, k):
        joint = np.zeros((k, k))
        np.add.at(joint, (cls[:, None], cls[None, :]), m)
        f = lambda x: float(brown._xlogx(x).sum())
        return f(joint) - f(joint.sum(0)) - f(joint.sum(1))
    last = -np.inf
    for sweeps in range(5):
        cls = brown.exchange(m, 5, sweeps)
        now = fit(cls, 5)
        assert now >= last - 1e-6
        last = now


def test_class_model_beats_the_unigram_on_held_out_text(spark):
    from conftest import SF01

    rows = brown.score_held_out(spark.read.parquet(f"{SF01}/documents.parquet")).where("held_out")
    got = rows.groupBy().sum("score", "base_score").first()
    assert got[0] > got[1]


def test_odd_rows(odd_docs, no_docs):
    rows = brown.score_held_out(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {1}
    assert brown.score_held_out(no_docs).collect() == []


def brute_scores(rows, model, cls_of, shape_of):
    """Scores of a class bigram model, all counts taken anew from the texts.
    ``cls_of`` gives the class of a word with one of its own, ``shape_of`` the
    class and shape of any other."""
    k = len(model.transition)
    train = [tokens(t) for d, t in rows if zlib.crc32(str(d).encode()) % 7 != 2]
    c = Counter(w for t in train for w in t)
    kept = {w for w, n in c.items() if w is not None and n >= brown.MIN_COUNT}
    small = set(brown_words(model))                    # words that are context by themselves
    end = int(model.cls[model.known.end])

    def out(w):
        return end if w is None else cls_of[w] if w in kept else shape_of(w)[0]

    def ctx(w):
        return end if w is None else cls_of[w] if w in kept and hashed(w) in small else shape_of(w)[0]
    joint = np.zeros((k, k))
    for t in train:
        for v, w in zip([None, *t[:-1]], t):
            joint[ctx(v), out(w)] += 1
    members = Counter(cls_of[w] for w in kept)
    members.update(int(x) for x in model.cls[model.known.top:])
    rare = Counter()
    kinds = Counter()
    for w, n in c.items():
        if w is not None and w not in kept:
            rare[shape_of(w)[1]] += n
            kinds[shape_of(w)[1]] += 1
    uni = (joint.sum(0) + 1) / (joint.sum() + k)
    trans = (joint + brown.BACKOFF * uni) / (joint.sum(1, keepdims=True) + brown.BACKOFF)

    def emit(w):
        size = joint[:, out(w)].sum() + 0.5 * members[out(w)]
        if w is None or w in kept:
            return (c[w] + 0.5) / size
        s = shape_of(w)[1]
        return (rare[s] + 0.5) / size * (c[w] + 1) / (rare[s] + kinds[s] + 1)
    return {d: sum(math.log10(trans[ctx(v), out(w)] * emit(w))
                   for v, w in zip([None, *tokens(t)[:-1]], tokens(t))) for d, t in rows}


def hashed(w):
    data = np.frombuffer(w.encode(), np.uint8)
    return int(tx.span_hash(data, np.array([0]), np.array([len(data)]))[0])


def brown_words(model):
    return [int(x) for x in model.known.words]


@pytest.mark.parametrize("known", [1 << 19, 60])
def test_score_equals_brute_force(spark, words, monkeypatch, known):
    monkeypatch.setattr(brown.known_words, "__defaults__", (known, 30))
    rows = [(i, words(i % 50) + (" Rare%d" % (i % 40))) for i in range(150)] + [(500, None), (501, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model, others = brown.fit(df.where(~brown.held_out(F.col("doc_id"))).select("text"))
    got = {r.doc_id: r.score for r in brown.score(df, model, others).collect()}
    table = dict(zip(brown_words(model), model.known.symbol.tolist()))
    rest = {r.word % (1 << 64): r["cls"] for r in others.collect()}
    cls_of = {}
    for w in {w for _, t in rows for w in tokens(t) if w is not None}:
        s = table.get(hashed(w), -1)
        own = int(model.cls[s]) if s >= 0 else rest.get(hashed(w))
        if own is not None:
            cls_of[w] = own

    def shape_of(w):
        data = np.frombuffer(w.encode(), np.uint8)
        s = int(brown._shape(data, np.array([0]), np.array([len(data)]))[0])
        return int(model.cls[model.known.top + s]), s
    assert (known > 60) == all(v is None for v in rest.values())
    want = brute_scores(rows, model, cls_of, shape_of)
    for d, _ in rows:
        assert got[d] == pytest.approx(want[d])


def test_gains_equal_the_change_in_likelihood(rng):
    n, k = 30, 5
    m = np.array([[rng.choice((0, 0, 0, 1, 4, 9)) for _ in range(n)] for _ in range(n)], float)
    cls = np.array([rng.randrange(k) for _ in range(n)])

    def joint_of(cls):
        joint = np.zeros((k, k))
        np.add.at(joint, (cls[:, None], cls[None, :]), m)
        return joint
    unit, cell, count = [], [], []
    for w in range(n):
        row = np.zeros(2 * k + 1)
        for v in range(n):
            if v != w:
                row[cls[v]] += m[w, v]
                row[k + cls[v]] += m[v, w]
        row[2 * k] = m[w, w]
        at = np.flatnonzero(row)
        unit += [w] * len(at)
        cell += at.tolist()
        count += row[at].tolist()
    got = brown.best_classes(np.array(unit), np.array(cell), np.array(count), cls, joint_of(cls))
    for w in range(n):
        value = [brown.likelihood(joint_of(np.where(np.arange(n) == w, b, cls))) for b in range(k)]
        assert value[got[w]] == pytest.approx(max(value))


def test_sweeps_never_lower_the_likelihood_and_raise_it_on_documents(spark):
    from conftest import SF01

    texts = spark.read.parquet(f"{SF01}/documents.parquet").select("text")
    known = brown.known_words(brown.word_counts(texts))
    seqs = brown.materialise(brown.sequences(texts, spark.sparkContext.broadcast(known)), "seqs")
    a, b = (brown.likelihood(brown.cluster(seqs, known, s)[1]) for s in (0, 2))
    assert b > a


@pytest.mark.parametrize("sent", [1 << 24, 0])
def test_scores_do_not_depend_on_the_size_of_the_table(spark, words, monkeypatch, sent):
    monkeypatch.setattr(brown, "SENT_CLASSES", sent)
    monkeypatch.setattr(brown.known_words, "__defaults__", (None, 30))
    monkeypatch.setattr(brown, "ROW_TOKENS", 16)
    rows = [(i, words(i % 50) + (" Rare%d" % (i % 40))) for i in range(150)] + [(500, None), (501, "")]
    rows += [(600, "twice twice " * 30 + "ab\tcab " * 9), (601, rows[7][1]), (601, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def run(table):
        monkeypatch.setattr(brown, "KNOWN_WORDS", table)
        model, others = brown.fit(df.where(~brown.held_out(F.col("doc_id"))).select("text"))
        assert len(model.known.words) <= table
        score = sorted((r.doc_id, r.score, r.base_score, r.n_known)
                       for r in brown.score(df, model, others).collect())
        return model, others.where("cls is not null").count(), score
    whole, none, want = run(1 << 19)
    small, beyond, got = run(60)
    assert none == 0 and beyond > 60 and small.known.beyond == beyond
    assert np.array_equal(whole.transition, small.transition)
    for a, b in zip(want, got):
        assert a == pytest.approx(b)


def test_table_is_cut_inside_a_count(spark):
    counts = spark.createDataFrame([(w << 48, w % 7, 6) for w in range(100)] + [(-5, 1, 9)],
                                   "word long, shape int, c long")
    known = brown.known_words(counts, 40)
    assert len(known.words) == 40 and known.cut == (6, 39)
    assert counts.where(known.outside()).count() == 61


def test_context_counts_send_one_exact_row_per_symbol(spark, rng):
    k, symbols = 5, 40
    rows = [[rng.randrange(symbols) for _ in range(200)] + [3, 4] * 400 + [7] * 300 for _ in range(4)]
    cls = np.array([rng.randrange(k) for _ in range(symbols)], np.uint8)
    seqs = spark.createDataFrame([(bytearray(np.array(r, "<i4").tobytes()),) for r in rows],
                                 "seq binary").coalesce(1)
    known = brown.Known(*[np.empty(0, np.int64)] * 3, np.empty(symbols, np.int64), 0, None, True)
    want = Counter()
    for r in rows:
        for b, w in zip(r, r[1:]):
            want[w, 2 * k if b == w else k + cls[b]] += 1
            if b != w:
                want[b, cls[w]] += 1
    got, per_half = Counter(), []
    for half in (0, 1):
        out = brown.context_counts(seqs, spark.sparkContext.broadcast(cls), k, half, known, symbols)
        out = out.collect()
        per_half.append(sorted(r.sym for r in out))
        for r in out:
            assert r.held == cls[r.sym] and r.sym % 2 == half
            for cell, n in zip(r.cells[::2], r.cells[1::2]):
                got[r.sym, cell] += n
    assert got == want and max(want.values()) > 255
    assert all(len(set(x)) == len(x) for x in per_half)


def test_best_classes_add_up_repeated_cells(rng):
    k, m = 4, 6
    joint = np.array([[rng.randrange(50, 90) for _ in range(k)] for _ in range(k)], float)
    unit = np.repeat(np.arange(m), 2 * k)
    cell = np.tile(np.arange(2 * k), m)
    n = np.array([rng.randrange(2, 9) for _ in unit])
    held = np.array([rng.randrange(k) for _ in range(m)])
    want = brown.best_classes(unit, cell, n, held, joint)
    got = brown.best_classes(np.repeat(unit, 2), np.repeat(cell, 2),
                             np.stack((n - 1, np.ones_like(n)), 1).ravel(), held, joint)
    assert np.array_equal(got, want)


@pytest.mark.parametrize("classed, size", [(10, 20), (30, 30), (70, 50)])
def test_rare_words_do_not_fill_the_table(spark, monkeypatch, classed, size):
    monkeypatch.setattr(brown, "KNOWN_WORDS", 50)
    monkeypatch.setattr(brown, "RARE_FILL", 20)
    counts = spark.createDataFrame([(w << 48, w % 7, 9 if w < classed else 1) for w in range(200)],
                                   "word long, shape int, c long")
    known = brown.known_words(counts)
    assert len(known.words) == size and known.open == (classed > size)


@pytest.mark.parametrize("table", [1 << 19, 60])
def test_fit_leaves_no_sequences_on_disk(spark, words, monkeypatch, table):
    monkeypatch.setattr(brown, "KNOWN_WORDS", table)
    texts = spark.createDataFrame([(words(i % 50),) for i in range(100)], "text string")
    before = set(joins._WRITTEN)
    brown.fit(texts)
    left = {p.rsplit("/", 1)[-1][:-33]: p for p in joins._WRITTEN if p not in before}
    assert not {"lm-sequences", "lm-linked"} & set(left)
    assert ("lm-others" in left) == (table == 60) and ("word-counts" in left) == (table > 60)
