import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from conftest import SF01
from tessera.llm import simhash as sh
from tessera.llm.queries import QUERIES
from llm_fixtures import *  # noqa: F401,F403

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = WORDS.findall((text or "").translate(LOWER))
    s = [" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, distance=3):
    """Component of each fingerprint, by comparing all with all."""
    label = list(range(len(fps)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= distance:
                label[top(i)] = top(j)
    return [top(i) for i in range(len(fps))]


def brute(rows):
    fps = [fingerprint(t) for _, t in rows]
    comp, low = roots(fps), {}
    for (d, _), c in zip(rows, comp):
        if d is not None:
            low[c] = min(low.get(c, d), d)
    return Counter((d, f"{fp:016x}", low.get(c)) for (d, _), fp, c in zip(rows, fps, comp))


def got(df):
    return Counter((r.doc_id, r.fingerprint, r.component_id) for r in df.select(
        "doc_id", sh.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id").collect())


def test_query_equals_brute_force_on_a_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    rows = QUERIES["op12_simhash_neardup"](spark, SF01).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == brute(docs)
    assert len({r.component_id for r in rows}) <= len({r.fingerprint for r in rows}) < len(rows)


def test_near_copies_odd_rows_and_clashing_columns(spark, rng, words, odd_docs, no_docs):
    rows = []
    for _ in range(40):
        w = words(rng.randrange(1, 60)).split()
        for _ in range(4):
            rows.append((len(rows), " ".join(w)))
            w[rng.randrange(len(w))] = "X" + words(1)
    rows += [(r.doc_id, r.text) for r in odd_docs.collect()] + [(None, rows[7][1]), (3, rows[9][1])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    clash = df.withColumns({c: F.lit("x") for c in ("fp", "cell", "u", "component_id", "low")})
    assert got(sh.near_duplicates(clash)) == brute(rows)
    assert got(sh.near_duplicates(no_docs)) == Counter()


@pytest.mark.parametrize("crowded", [sh.CROWDED, 12, 2])
def test_links_equal_brute_force(spark, rng, crowded):
    """Balls of close fingerprints, chains and far ones; crowded cells split."""
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1, 1, 7, 15}
    for _ in range(6):
        c = rng.getrandbits(64)
        bits = rng.sample(range(64), 12)
        for _ in range(60):
            fps.add(c ^ sum(1 << b for b in rng.sample(bits, rng.randrange(7))))
    for _ in range(3):                                # chains of three-bit steps
        c = rng.getrandbits(64)
        for _ in range(25):
            c ^= sum(1 << b for b in rng.sample(range(64), 3))
            fps.add(c)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(4)
    links = [(r.u % (1 << 64), r.v % (1 << 64)) for r in sh.links(df, crowded=crowded).collect()]
    label = {f: f for f in fps}

    def top(x):
        while label[x] != x:
            x = label[x]
        return x
    for u, v in links:
        label[top(u)] = top(v)
    want = roots(fps)
    parts = Counter(frozenset(f for f, r in zip(fps, want) if r == k) for k in set(want))
    mine = {}
    for f in fps:
        mine.setdefault(top(f), set()).add(f)
    assert Counter(map(frozenset, mine.values())) == parts


def test_counts_bound_the_distance_and_cells_meet(rng):
    a = np.array([rng.getrandbits(64) for _ in range(3000)], np.uint64)
    flips = np.array([sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for _ in a], np.uint64)
    b = a ^ flips
    x, y = sh._unary(a), sh._unary(b)
    counts = [[bin(int(v) >> 2 * i & 3).count("1") for i in range(32)] for v in a[:50]]
    for v, u, c in zip(a[:50], x[:50], counts):       # unary code of the segment counts
        assert [bin(int(u) >> 2 * i & 3).count("1") for i in range(32)] == c
        assert all(int(u) >> 2 * i & 3 in (0, 1, 3) for i in range(32))
    apart = np.bitwise_count(x ^ y)
    assert (apart <= np.bitwise_count(flips)).all()
    low = np.uint64(0xFFFFFFFF)
    halves = np.minimum(np.bitwise_count((x ^ y) & low), np.bitwise_count((x ^ y) & ~low))
    assert halves.max() <= 1


def test_long_text_in_pieces(rng, words):
    text = words(40000)
    h = sh._hashes(text, 3)
    assert sh._majority(h) == fingerprint(text)
    assert sh._majority(h[:0]) == 0
