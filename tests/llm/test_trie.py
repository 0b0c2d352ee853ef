import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, trie
from llm_fixtures import *  # noqa: F401,F403

CONV = "conv_id long, turn long, role string, text string"


def brute(rows, rebuilt=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            raw = f"{len(role.encode())}:{role}{text}".encode()
            own[c].append((turn is not None, turn or 0, hashlib.md5(raw).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    convs = own
    if rebuilt:
        convs = {}
        for c, t in own.items():
            h = zlib.crc32(str(c).encode()) % 9
            convs[c] = own.get(c - c % 5, [])[:h] + t[h:]
    node, ends = defaultdict(list), defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            node[tuple(t[:d])].append(c)
        ends[tuple(t)].append(c)
    kids = Counter(k[:-1] for k in node if k)
    leaves, saved = Counter(), Counter()
    for k, members in node.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1].encode()) if k else 0
    return Counter((min(m), len(k), min(node[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest())
                   for k, m in node.items())


def run(spark, df, tmp):
    df.write.parquet(f"{tmp}/conversations.parquet")
    return Counter(tuple(r) for r in queries.op13_prefix_trie(spark, str(tmp)).collect())


def talks(rng, n, stock, longest):
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c * 3 % (2 * n), turn, rng.choice(["user", "assistant", None]), rng.choice(stock)))
    return rows


@pytest.mark.parametrize("limit", [trie.LIMIT, 30, 1])
def test_equals_brute_force(spark, rng, monkeypatch, tmp_path, limit):
    monkeypatch.setattr(trie, "CHUNK", 4)
    monkeypatch.setattr(trie, "IDS", 3)
    monkeypatch.setattr(trie, "prefix_trie", lambda t, c, f=trie.prefix_trie: f(t, c, limit))
    rows = talks(rng, 70, ["", "a", "é", None], 6)
    rows += [(500, i, "user", "ab"[i % 2]) for i in range(60)]          # one deep conversation
    rows += [(c, 0, "user", "same") for c in range(1000, 1040)]         # a hot one
    rows += [(2, None, None, None), (2, 1, "user", "tie"), (2, 1, "user", "eit"), (2, 1, "user", "tie"),
             (None, 0, "user", "lost")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CONV).repartition(4)
    assert run(spark, df, tmp_path) == brute(rows)


def test_plain_trie_without_regrouping(spark, rng):
    rows = talks(rng, 40, ["x", "yy"], 5)
    turns = trie.number_turns(spark.createDataFrame(rows, CONV))
    convs = turns.groupBy("conv").agg(F.count("*").alias("len"))
    got = Counter(tuple(r) for r in trie.prefix_trie(turns, convs, 20).collect())
    assert got == brute(rows, rebuilt=False)


def test_empty_and_clashing_columns(spark, tmp_path):
    assert run(spark, spark.createDataFrame([], CONV), tmp_path / "a") == Counter()
    rows = [(5, 0, "user", "long " * 50000), (6, 0, "user", "b"), (7, 3, "u", "c"), (7, 3, "u", "c")]
    df = spark.createDataFrame(rows, CONV).withColumns(
        {c: F.lit("x") for c in ("conv", "pos", "a", "pa", "d", "len", "n", "depth", "bytes", "turn_id")})
    assert run(spark, df, tmp_path / "b") == brute(rows)


def test_centroid_decomposition_sums(rng):
    for n in (1, 2, 3, 50, 400):
        for kind in ("random", "chain", "star"):
            parent = [-1] + [{"random": rng.randrange(i), "chain": i - 1, "star": 0}[kind] for i in range(1, n)]
            if n > 40 and kind == "random":
                parent[20] = -1                       # a forest
            values = [(rng.randrange(10), rng.randrange(1000)) for _ in range(n)]
            want = [list(v) for v in values]
            for i in range(n - 1, -1, -1):
                if parent[i] >= 0:
                    want[parent[i]] = [x + y for x, y in zip(want[parent[i]], want[i])]
            assert trie._decompose(parent, values) == want
