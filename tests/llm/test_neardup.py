import re
from itertools import combinations

from tessera.llm import components, neardup
from llm_fixtures import *  # noqa: F401,F403


def brute(rows, n, num, den):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in rows:
        w = re.findall("[^\x20\x09-\x0D]+", (t or "").translate(up))
        sets[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else (
            {tuple(w)} if w else set())
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for a, b in combinations(sets, 2):
        i, u = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if u and den * i >= num * u:
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {(d, len(s), find(d), find(d) == d) for d, s in sets.items()}


def corpus(rng, words):
    """Copies, chains of edits and a passage shared by unrelated texts."""
    rows, base, passage = [], [words(80) for _ in range(8)], words(40)
    for i in range(160):
        w = base[rng.randrange(8)].split() if i % 3 else words(rng.randint(1, 120)).split()
        for _ in range(rng.randrange(8) if i % 3 else 0):
            w[rng.randrange(len(w))] = words(1)
        if i % 5 == 0:
            w += passage.split()
        rows.append((i, " ".join(w)))
    chain = words(60).split()                         # a - b - c ..., ends far apart
    for i in range(200, 230):
        chain[rng.randrange(60)] = words(1)
        rows.append((i, " ".join(chain)))
    return rows + [(300, None), (301, ""), (302, "Word"), (303, "word"), (304, "two  WORDS")]


def test_components_equal_brute_force(spark, rng, words):
    rows = corpus(rng, words)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, sim in ((3, (85, 100)), (5, (80, 100))):
        got = {tuple(r) for r in neardup.near_duplicates(df, n, sim).collect()}
        assert got == brute(rows, n, *sim)


def test_small_sketches_still_find_every_component(spark, rng, words):
    rows = corpus(rng, words)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in neardup.near_duplicates(df, 3, (85, 100), k=16).collect()}
    assert got == brute(rows, 3, 85, 100)


def test_contained_texts_just_above_the_threshold_are_linked(spark, rng):
    rows = []
    for i in range(1500):
        w = ["%x" % rng.getrandbits(48) for _ in range(500)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:402]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(df, 5, (80, 100)).collect()}
    assert [d for d, c in got.items() if c != d - d % 2] == []


def test_pairs_on_boilerplate_grow_with_the_documents(spark, rng, monkeypatch):
    """Texts of 12 out of 40 stock sentences, nearly all without a partner."""
    stock = [" ".join("%x" % rng.getrandbits(40) for _ in range(9)) for _ in range(40)]
    seen, confirm = [], neardup.confirm

    def counted(pairs, *args):
        seen.append(pairs.count())
        return confirm(pairs, *args)
    monkeypatch.setattr(neardup, "confirm", counted)
    total = []
    for n in (300, 1200):
        rows = [(i, " ".join(rng.sample(stock, 12))) for i in range(n)]
        rows += [(n + i, rows[i][1] + " more") for i in range(n // 20)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {tuple(r) for r in neardup.near_duplicates(df).collect()}
        assert got == brute(rows, 5, 80, 100)
        total.append(sum(seen))
        seen.clear()
    print("pairs", total)
    assert total[1] < 6 * total[0]


def test_parity_bits_bound_the_difference(spark, rng, words):
    df = spark.createDataFrame([(i, words(rng.randint(0, 300))) for i in range(40)],
                               "doc_id long, text string")
    rows = neardup.full_sets(df).collect()
    for a, b in combinations(rows, 2):
        apart = sum(((a[p] ^ b[p]) & (1 << 64) - 1).bit_count() for p in neardup.PARITY)
        assert apart <= len(set(a.hashes) ^ set(b.hashes))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs, 3).collect()
    assert len(rows) == odd_docs.count()
    assert {r.component_id for r in rows if r.doc_id == 1} == {1}
    assert all(r.kept and r.n_shingles == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert neardup.near_duplicates(no_docs).collect() == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}}
    assert components.components(df.limit(0)).collect() == []
