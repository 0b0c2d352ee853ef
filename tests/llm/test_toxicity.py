import math
import re
from collections import Counter

import numpy as np
from conftest import SF01

from tessera.llm import toxicity as t
from tessera.llm.queries import op6_toxicity
from llm_fixtures import *  # noqa: F401,F403


def test_held_out_accuracy(spark):
    rows = op6_toxicity(spark, SF01).join(
        spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    flipped = labels.withColumn("toxic", t.F.when(t.held_out(t.F.col("doc_id")), 1 - t.F.col("toxic"))
                                .otherwise(t.F.col("toxic")))
    a, b = (sorted(map(tuple, t.classify(docs, x).collect())) for x in (labels, flipped))
    assert a == b


def test_features_have_names_and_see_what_they_are_named_after(spark, words):
    rows = [(1, words(40)), (2, "YOU are an IDIOT and st*pid! why? " + words(10)), (3, None)]
    lex = t.Lexicon(*(t.np.empty(0, k) for k in ("u8", "f8", "u8", "f8")))
    got = {r.doc_id: dict(zip(t.FEATURES, r.features, strict=True)) for r in t.features(
        spark.createDataFrame(rows, "doc_id long, text string"), lex).collect()}
    assert got[2]["seed_hits"] > 0 and got[2]["near_second"] == 1 and got[2]["obfuscation_rate"] > 0
    assert got[2]["caps_word_rate"] > got[1]["caps_word_rate"] and got[2]["exclaim_rate"] > 0
    assert got[1]["seed_hits"] == got[1]["obfuscation_rate"] == 0
    assert got[3]["hit_count"] == got[3]["log_words"] == 0


def test_odd_rows(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in t.score(odd_docs, none).collect()} == {0.0}
    one = spark.createDataFrame([(1, 1), (1, 0), (None, 0), (2, None)], "doc_id long, toxic int")
    assert {r.score for r in t.score(odd_docs, one).collect()} == {1.0}
    both = spark.createDataFrame([(1, 1), (2, 0), (5, 0), (6, 1)], "doc_id long, toxic int")
    assert t.score(odd_docs, both).count() == odd_docs.count()
    assert t.score(no_docs, both).collect() == []
    kept = t.reject(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def letter_words(raw):
    return [m.group() for m in re.finditer(rb"[A-Za-z\x80-\xff]+", raw)]


def beginnings(w):
    return [w.lower()[:n] for n in t.PREFIXES if len(w) > n]


def plain_lexicon(rows, n_bad, n_good):
    """``({word: odds}, {beginning: odds})`` from ``(toxic, bytes)``."""
    out = []
    for units in (lambda w: [w.lower()], beginnings):
        bad, good = Counter(), Counter()
        for toxic, raw in rows:
            (bad if toxic else good).update({u for w in letter_words(raw) for u in units(w)})
        odds = {u: math.log((b + 0.5) / (n_bad + 1)) - math.log((good[u] + 0.5) / (n_good + 1))
                for u, b in bad.items() if b >= t.MIN_TOXIC_DOCS}
        out.append({u: o for u, o in odds.items() if o >= t.MIN_LOG_ODDS})
    assert sum(map(len, out)) <= t.LEXICON_SIZE
    return out


def plain_features(raw, word_odds, prefix_odds):
    words = letter_words(raw)
    low = [w.lower() for w in words]
    a = [word_odds.get(w, 0) for w in low]
    b = [max((prefix_odds.get(p, 0) for p in beginnings(w)), default=0) for w in words]
    seed = [w.decode("utf8", "replace") in t.INSULTS for w in low]
    you = [i for i, w in enumerate(low) if w.decode("utf8", "replace") in t.SECOND_PERSON]
    hits = [i for i in range(len(words)) if max(a[i], b[i]) > 0 or seed[i]]
    near = sum(any(abs(i - j) <= t.NEAR for j in you) for i in hits)
    n, size = max(len(words), 1), max(len(raw), 1)
    masked = sum(bool(re.match(rb"[A-Za-z\x80-\xff][*@$#!0134578|+%&][A-Za-z\x80-\xff]", raw[i:i + 3]))
                 for i in range(len(raw)))
    punct = sum(raw.count(c) for c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    return [sum(x > 0 for x in a) / n, sum(x > 0 for x in b) / n, sum(seed) / n, sum(a) / n, sum(b) / n,
            max([0, *a, *b]), len({low[i] for i in hits}), len(hits), near, len(you) / n,
            sum(65 <= c <= 90 for c in raw) / size,
            sum(len(w) > 2 and all(65 <= c <= 90 for c in w) for w in words) / n,
            raw.count(b"!") / size, raw.count(b"?") / size, punct / size, masked / n,
            sum(map(len, words)) / n, math.log(n)]


def test_lexicon_and_features_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = docs.join(labels, "doc_id").select("doc_id", "toxic", "text")
    raw = {r.doc_id: (r.toxic, (r.text or "").encode()) for r in rows.collect()}
    bad = sum(x for x, _ in raw.values())
    lex = t.learn_lexicon(rows.select("toxic", "text"), bad, len(raw) - bad)
    word_odds, prefix_odds = plain_lexicon(raw.values(), bad, len(raw) - bad)
    assert len(word_odds) > 20 and len(prefix_odds) > 20
    for table, odds, got in ((word_odds, lex.word_odds, lex.words),
                             (prefix_odds, lex.prefix_odds, lex.prefixes)):
        assert len(got) == len(table)
        assert np.allclose(np.sort(odds), np.sort(list(table.values())))
    more = [(-1, "YOU ST*PID idiot!! you... you're an 1d10t, IDIOT? " * 3), (-2, ""), (-3, "é" * 50 + " a*b")]
    raw.update({d: (0, x.encode()) for d, x in more})
    every = rows.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    for r in t.features(every, lex).collect():
        want = plain_features(raw[r.doc_id][1], word_odds, prefix_odds)
        assert np.allclose(r.features, want), (r.doc_id, dict(zip(t.FEATURES, zip(r.features, want))))
