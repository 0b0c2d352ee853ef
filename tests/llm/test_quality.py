import re
from collections import Counter, defaultdict

from tessera.llm import quality as q
from llm_fixtures import *  # noqa: F401,F403


def brute_base(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    cover = set()
    for i in range(len(w) - 7):
        if win[tuple(w[i:i + 8])] > 1:
            cover.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover))


def normal(line):
    low = line.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                                       "abcdefghijklmnopqrstuvwxyz0000000000"))
    return tuple(re.findall("[^\x20\x09-\x0D]+", low))


def test_base_counts_and_line_rule(spark, rng, words):
    rows, footer = [], "Call 555 1234\tNOW"
    for i in range(120):
        lines = [words(rng.randint(0, 30)) for _ in range(rng.randint(0, 6))]
        if i % 4 == 0:
            lines += [lines[0] if lines else "x"] * 3 + ["é# <b> & ünï*"]
        if i % 3 == 0:
            lines.insert(0, f"call  555 {rng.randint(1000, 9999)} now" if i % 2 else footer)
        if i % 6 == 0:
            lines = lines[:1] + ["a short text here"]
        rows.append((i, "\n".join(lines), "h%d" % (i % 3)))
    rows += [(200, None, "h0"), (201, "", None), (202, "\n\n \n", "h1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = {r.doc_id: r for r in q.quality(df, min_docs=5, share=0.05).collect()}
    hosts, docs_of = defaultdict(Counter), Counter(r[2] for r in rows)
    for _, t, h in rows:
        hosts[h].update({normal(x) for x in (t or "").split("\n")} - {()})
    for d, t, h in rows:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(t)
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        gone = sum(sum(map(len, normal(x))) for x in (t or "").split("\n")
                   if hosts[h][normal(x)] >= 5 and hosts[h][normal(x)] > 0.05 * docs_of[h])
        assert (r.base_failed, r.removed_chars) == (failed, gone)
        assert r.kept == (not failed and r.word_chars - gone >= 0.5 * r.word_chars)
    assert any(r.removed_chars for r in got.values())


def test_repeated_rows_are_measured_one_by_one(spark, words):
    footer, rare = words(10), words(9)
    rows = [(i, words(30) + "\n" + footer, "h") for i in range(5)]
    rows += [rows[0]] + [(90, rare + "\n" + words(30 + i), "h") for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = q.quality(df, min_docs=5, share=0.05).collect()
    assert len(got) == len(rows)
    chars = len(footer.replace(" ", ""))
    assert all((r.removed_lines, r.removed_chars, r.kept) == (1, chars, True)
               for r in got if r.doc_id < 90)
    assert all(r.removed_lines == 0 for r in got if r.doc_id == 90)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = q.quality(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert not any(r.kept for r in rows if r.n_words < 20)
    assert q.quality(no_docs).collect() == []
