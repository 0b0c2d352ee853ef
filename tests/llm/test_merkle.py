import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import merkle as mk
from tessera.llm import queries
from llm_fixtures import *  # noqa: F401,F403


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def reduce_up(nodes):
    """Levels from ``nodes`` to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([H(*at[i:i + 3]) for i in range(0, len(at), 3)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        out.append((run[:i % 3], run[i % 3 + 1:]))
        i //= 3
    return out


def brute(rows):
    """Rows ``doc_id, text, lang, source, n_chars``."""
    def leaf(r, text):
        return H(field(r[0]), field(r[3]), field(r[2]), field(r[4]), field(text))
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        by[s].sort(key=lambda x: x[:3])
        trees.append(reduce_up([x[2] for x in by[s]]))
    if not rows:
        return Counter()
    top = reduce_up([t[-1][0] for t in trees])
    root, out = top[-1][0], []
    for k, s in enumerate(order):
        for i, (_, _, own, r) in enumerate(by[s]):
            path = siblings(trees[k], i) + siblings(top, k)
            node = own
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                node = leaf(r, r[1].replace("\n", ""))
            for a, b in path:
                node = H(*a, node, *b)
            out.append((r[0], own, trees[k][-1][0], root,
                        H(*(x for a, b in path for x in a + b)), node, node == root))
    return Counter(out)


def run(spark, docs, tmp):
    docs.write.parquet(f"{tmp}/documents.parquet")
    return Counter(tuple(r) for r in queries.op11_merkle_manifest(spark, str(tmp)).collect())


@pytest.mark.parametrize("levels", [6, 1, 2])
def test_equals_brute_force(spark, rng, words, monkeypatch, tmp_path, levels):
    monkeypatch.setattr(mk, "LEVELS", levels)
    monkeypatch.setattr(mk, "WIDTH", 3 ** levels)
    sizes = {"hot": 250, "é": 28, None: 27, "lone": 1, "": 4, "Z": 9}
    rows, at = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", words(3), words(3) + "\n" + words(2) + "\n"])
            rows.append((at * 7 % 400 - 3, text, rng.choice(["en", None]), s, len(text or "") or None))
            at += 1
    rows += rows[5:9] + [(None, "x\ny", None, "hot", None), (None, "x\nz", None, "hot", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, DOCS)
    assert run(spark, df.repartition(6), tmp_path) == brute(rows)


def test_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd_docs.collect()]
    clash = odd_docs.withColumns({c: F.lit("x") for c in ("leaf", "tree", "at", "digest", "path", "root")})
    assert run(spark, clash, tmp_path / "a") == brute(rows)
    assert run(spark, no_docs, tmp_path / "b") == Counter()
    one = spark.createDataFrame([(7, "a\nb", "en", "s", 3)], DOCS)
    assert run(spark, one, tmp_path / "c") == brute([(7, "a\nb", "en", "s", 3)])


def test_proofs_of_some_leaves_and_stored_records(spark, words, monkeypatch):
    monkeypatch.setattr(mk, "LEVELS", 2)
    monkeypatch.setattr(mk, "WIDTH", 9)
    rows = [(i, words(4), "en", "s" if i % 5 else "t", 1) for i in range(300)]
    m = mk.manifest(spark.createDataFrame(rows, DOCS))
    got = mk.verify(mk.prove(m, m.leaves.where("doc_id in (0, 17, 299)")), "leaf").collect()
    assert sorted(r.doc_id for r in got) == [0, 17, 299] and all(r.verified for r in got)
    assert all(len(s.siblings) <= 2 for r in got for s in r.path)
    for level in m.passes:                            # each record's digest is that of its children
        for r in level.collect():
            assert all(bytes(x.digest) == mk._digest(map(bytes, x.children)) for x in r.records)
