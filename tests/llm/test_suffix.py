import hashlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import suffix_array as sa
from tessera.llm import suffixdedup as sd
from llm_fixtures import *  # noqa: F401,F403


def brute(rows, length):
    count = Counter()
    raw = [(d, (t or "").encode()) for d, t in rows]
    for _, b in raw:
        count.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("scan", [False, True])
def test_suffix_array_and_prefixes(rng, monkeypatch, scan):
    if scan:
        monkeypatch.setattr(sa, "BUCKET_ALPHABET", 1)
    for _ in range(150):
        s = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(1, 60))] + [0]
        order = sa.suffix_array(np.array(s)).tolist()
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        plcp = sa.common_prefixes(np.array(s), np.array(order), 100)
        for a, b in zip(order, order[1:]):
            k = 0
            while a + k < len(s) and b + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            assert plcp[b] == k


def test_short_periods_and_equal_units(rng):
    base = "".join(rng.choice("ab") for _ in range(30))
    for period in (1, 2, 7, 45):
        line = "".join(rng.choice("abcd") for _ in range(period))
        units = [(line * 300)[:n].encode() for n in (200, 90, 200, 41)]
        units += [(base + line * 200)[:180].encode(), b"x" + units[0][:150], units[0], b""]
        rng.shuffle(units)
        for length in (20, 40, 100):
            count = Counter(u[i:i + length] for u in units for i in range(len(u) - length + 1))
            got = sa.repeated(units, length)
            for u, at in zip(units, got):
                assert at.tolist() == [i for i in range(len(u) - length + 1)
                                       if count[u[i:i + length]] > 1]


def test_texts_of_a_short_period(spark, rng):
    line = "".join(rng.choice("abcdefgh ") for _ in range(37))
    rows = [(i, "".join(rng.choice("xyz") for _ in range(rng.randrange(90)))
             + (line * 60)[:rng.randrange(30, 1500)]) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(tuple(r) for r in sd.suffix_dedup(df, 60, with_text=False).collect()) == brute(rows, 60)


@pytest.mark.parametrize("hot", [256, 3])
def test_equals_brute_force(spark, rng, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT_UNITS", hot)
    base = ["".join(rng.choice("abcdé ") for _ in range(300)) for _ in range(4)]
    rows = []
    for i in range(60):
        a = rng.randrange(200)
        rows.append((i, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(60)))
                     + base[rng.randrange(4)][a:a + rng.randrange(20, 150)]
                     + "".join(rng.choice("xyz") for _ in range(rng.randrange(50)))))
    rows += [(100, "a" * 500), (101, "ab" * 200), (102, None), (103, ""), (5, rows[5][1]),
             (5, "zz"), (None, base[0]), (None, base[0][:100])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in sd.suffix_dedup(df, 40, with_text=False).collect())
    assert got == brute(rows, 40)


def test_very_long_text_is_cut_into_segments(spark, monkeypatch, rng):
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    rows = [(1, text + text[500:600]), (2, text[2000:2200])]
    monkeypatch.setattr(sd, "SEGMENT", 700)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in sd.suffix_dedup(df, 50, with_text=False).collect()) == brute(rows, 50)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = sd.suffix_dedup(odd_docs, keep=("score", "lang")).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.kept.score == 0.5 for r in rows)
    assert {r.n_bytes for r in rows if r.doc_id in (2, 3)} == {0}
    assert [r.n_removed for r in rows if r.doc_id == 5] == [100000]
    assert sd.suffix_dedup(no_docs).collect() == []
