import math
import zlib
from collections import Counter

from conftest import SF01

from tessera.llm import langid
from tessera.llm.queries import op9_language_id
from llm_fixtures import *  # noqa: F401,F403


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    rows = op9_language_id(spark, SF01).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_codewords_differ():
    for n in (1, 2, 3, 5, 6, 20):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code}) == n
    assert min((langid.codewords(20)[0] != r).sum() for r in langid.codewords(20)[1:]) >= 8


def test_many_languages(spark, rng):
    stock = {f"l{i}": [chr(97 + i) + chr(97 + (i + k) % 26) + "x" for k in range(6)] for i in range(9)}
    rows = [(i, " ".join(rng.choice(stock[f"l{i % 9}"]) for _ in range(30)), f"l{i % 9}") for i in range(270)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(df).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.97 * len(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    extra = spark.createDataFrame([(7, "123 ... ×", "en"), (8, "Ω", None)],
                                  "doc_id long, text string, lang string")
    rows = langid.identify(odd_docs.select("doc_id", "text", "lang").union(extra)).collect()
    assert {r.lang_pred for r in rows if r.doc_id in (2, 3, 4, 7)} == {"und"}
    assert all(r.lang_pred != "und" for r in rows if r.doc_id in (5, 6, 8))
    assert langid.identify(no_docs).collect() == []
    unlabelled = odd_docs.withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def cells_of(text):
    """Cell of every n-gram, one byte at a time."""
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    out = []
    for i, n in enumerate(langid.GRAMS):
        for a in range(len(raw) - n + 1):
            h = 0
            for b in raw[a:a + n]:
                h = (h * 0x01000193) % 2 ** 32 ^ b
            h ^= h >> 15
            h = h * 0x2C1B3C6D % 2 ** 32
            h ^= h >> 12
            out.append(i * langid.BUCKETS + h % langid.BUCKETS)
    return out


def brute(train, texts):
    """``(language, score, ambiguous)`` per text, without arrays over cells."""
    langs = sorted({lang for lang, _ in train})
    count = {x: Counter() for x in langs}
    for lang, text in train:
        count[lang].update(cells_of(text))
    code = langid.codewords(len(langs)).tolist()
    size = {(x, i): sum(n for c, n in count[x].items() if c // langid.BUCKETS == i)
            for x in langs for i in range(len(langid.GRAMS))}

    def prob(x, c):
        i = c // langid.BUCKETS
        return (count[x][c] + 0.5) / (size[x, i] + 0.5 * langid.BUCKETS)

    def odds(b, c):
        one = [prob(x, c) for x, w in zip(langs, code) if w[b] > 0]
        zero = [prob(x, c) for x, w in zip(langs, code) if w[b] < 0]
        return math.log(sum(one) / len(one)) - math.log(sum(zero) / len(zero))
    bits, weight = range(len(code[0])), []
    for b in bits:
        all_odds = [odds(b, c) for c in range(langid.WIDTH)]
        sep = [sum(prob(x, c) * o for c, o in enumerate(all_odds)) / len(langid.GRAMS) * w[b]
               for x, w in zip(langs, code)]
        weight.append(max(math.tanh(langid.SHARPNESS * sum(sep) / len(sep)), 0.05))
    out = []
    for text in texts:
        if not any(ch.isalpha() for ch in text or ""):
            out.append(("und", 0.0, True))
            continue
        cells = cells_of(text)
        margin = [langid.SHARPNESS * sum(odds(b, c) for c in cells) / max(len(cells), 1) for b in bits]
        loss = [sum(weight[b] * math.log1p(math.exp(-margin[b] * w[b])) for b in bits) / sum(weight)
                for w in code]
        two = sorted(loss)
        like = sum(math.exp(-len(weight) * (x - two[0])) for x in loss)
        out.append((langs[loss.index(two[0])], 1 / like, two[1] - two[0] < langid.AMBIGUOUS_GAP))
    return out


def test_prediction_equals_brute_force(spark, rng):
    stock = {x: ["".join(rng.choice(a) for _ in range(4)) for _ in range(12)]
             for x, a in (("aa", "abcde"), ("bb", "cdefg"), ("cc", "efghé"), ("dd", "xyzab"))}
    rows = [(i, " ".join(rng.choice(stock[x]) for _ in range(rng.randint(1, 9))).title(), x)
            for i, x in enumerate(list(stock) * 12)]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 34", "cc"), (103, "a", "dd"), (104, "cde", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    train = [(x, t) for d, t, x in rows if x is not None and zlib.crc32(str(d).encode()) % 4 != 2]
    want = dict(zip((r[0] for r in rows), brute(train, [r[1] for r in rows])))
    for r in langid.identify(df).collect():
        lang, score, ambiguous = want[r.doc_id]
        assert (r.lang_pred, r.ambiguous) == (lang, ambiguous)
        assert abs(r.score - score) < 1e-9
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_clashing_columns_do_not_matter(spark, odd_docs):
    plain = odd_docs.select("doc_id", "text", "lang")
    more = odd_docs.withColumns({c: langid.F.lit("x") for c in ("lang_pred", "ambiguous", "cell", "n")})
    key = lambda df: sorted(map(str, langid.identify(df).collect()))
    assert key(plain) == key(more)
