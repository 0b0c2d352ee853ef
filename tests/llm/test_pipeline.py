"""The whole pipeline against plain Python on a fixture with planted cases."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from tessera.llm import decontam
from tessera.llm.queries import bpe_files
from tessera.plans.tuning import BATCH_KEY, TEXT_BATCH_BYTES
from test_bpe import codec, library  # noqa: F401
from test_decontam import edits, even
from test_neardup import brute as components
from llm_fixtures import *  # noqa: F401,F403

INSULTS = "you stupid worthless idiot shut up loser your pathetic garbage hate you moron".split()


def cut(texts, length):
    """Every byte that a string of ``length`` bytes covers which starts elsewhere too."""
    raw = [t.encode() for t in texts]
    count = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(bytes(x for x, g in zip(b, gone) if not g).decode())
    return out


def planted(rng, words):
    """``(doc_id, text, toxic)`` rows, the benchmark items and the ids by kind."""
    ids, kinds, rows = iter(range(10_000)), {}, []

    def add(kind, text, toxic=0):
        rows.append((next(ids), text, toxic))
        kinds.setdefault(kind, []).append(rows[-1][0])
    for _ in range(90):
        add("clean", words(rng.randint(60, 110)))
    for i in range(90):
        w = words(60).split()
        for _ in range(25):
            w[rng.randrange(60)] = rng.choice(INSULTS)
        add("toxic", " ".join(w).upper() if i % 2 else " ".join(w) + "!!!", 1)
    copied = words(90)
    for i in range(6):                                # exact and near copies
        w = copied.split()
        if i % 2:
            w[-1 - i] = "changed%d" % i
        add("copies", " ".join(w))
    passage = words(60)
    for _ in range(5):
        add("passages", words(40) + " " + passage + " " + words(40))
    items = [words(25) for _ in range(4)]
    for item in items:
        add("items", words(40) + " " + item + " " + words(30))
        add("edited items", words(40) + " " + even(item, 9) + " " + words(30))
    rows += [rows[0]] * 2                             # a repeated row
    return rows, items, kinds


def test_run_equals_plain_python(spark, rng, words, tmp_path, library):  # noqa: F811
    rows, items, kinds = planted(rng, words)
    docs = spark.createDataFrame([(d, t, "en", f"s{d % 3}", len(t)) for d, t, _ in rows], DOCS)
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(d, 1, x) for d, _, x in dict((r[0], r) for r in rows).values()],
                          "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet"))

    left = [(d, t) for d, t, toxic in rows if not toxic]
    part = {row: top for row, _, top, _ in components(
        [(i, t) for i, (_, t) in enumerate(left)], 5, 80, 100)}
    first = {}
    for row, top in part.items():
        first[top] = min(first.get(top, (1 << 60, 0)), (left[row][0], row))
    left = [left[row] for _, row in sorted(first.values())]
    left = list(zip((d for d, _ in left), cut([t for _, t in left], corpus_pipeline.PASSAGE_BYTES)))
    goal = [decontam.normal_text(x) for x in items]
    left = [(d, t) for d, t in left if t.strip() and not any(
        edits(g, decontam.normal_text(t)) <= int(len(g) * decontam.MAX_EDITS) for g in goal)]
    want = set()
    for d, t in left:
        got = library.encode_ordinary(t)
        raw = b"".join(i.to_bytes(4, "little") for i in got)
        want.add((d, len(got), hashlib.sha256(raw).hexdigest(),
                  hashlib.sha256(t.encode()).hexdigest()))

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(out) == len(want)
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == want
    ids = {r.doc_id for r in out}
    assert set(kinds["clean"]) <= ids and set(kinds["passages"]) <= ids
    assert ids & set(kinds["copies"]) == {kinds["copies"][0]}
    for kind in ("toxic", "items", "edited items"):
        assert not ids & set(kinds[kind])


@pytest.fixture
def batch_conf(spark):
    before = spark.conf.get(BATCH_KEY, None)
    spark.conf.unset(BATCH_KEY)
    yield
    spark.conf.unset(BATCH_KEY) if before is None else spark.conf.set(BATCH_KEY, before)


def test_stages_bound_the_texts_of_a_batch(spark, batch_conf):
    docs = spark.range(0, 6000, 1, 1).selectExpr(
        "id as doc_id", "concat(id, repeat(' some words', 200)) as text", "'en' as lang",
        "'s' as source", "2200L as n_chars")

    def batch_bytes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    def sizes():
        return [r.n for r in docs.select("doc_id", "text").mapInArrow(batch_bytes, "n long").collect()]

    assert max(sizes()) > 2 * TEXT_BATCH_BYTES
    corpus_pipeline.encode(spark, docs, "")
    assert max(sizes()) < TEXT_BATCH_BYTES + 10_000 and len(sizes()) > 2


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_every_stage_sets_the_bound(spark, batch_conf, monkeypatch, name, stage):
    set_in = []
    monkeypatch.setattr(corpus_pipeline, "bound_text_batches", set_in.append)
    with pytest.raises(Exception):                    # there is no table to work on
        stage(spark, None, "")
    assert set_in == [spark]


def test_stages_keep_a_bound_of_the_session(spark, batch_conf):
    spark.conf.set(BATCH_KEY, "12345678")
    docs = spark.createDataFrame([(1, "a text of a few words", "en", "s", 21)], DOCS)
    assert corpus_pipeline.encode(spark, docs, "").first().n_tokens > 0
    assert spark.conf.get(BATCH_KEY) == "12345678"
