import hashlib

from pyspark.sql import functions as F

from tessera.llm import chat
from llm_fixtures import *  # noqa: F401,F403

ROW = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        flat = "".join(f"{r}\n{x}\n" for *_, r, x in turns)
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(flat.encode()).hexdigest(), len(loss),
                  hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_read_back_is_exact(spark, rng):
    bits = ["### ", "</turn>", "\n", "\\", "\\h", "<", "#", ": ", "user", "<|image|>", "é", "😀", "s", " "]
    rows = [(c, rng.choice([0, 1, 2, 70, 200, None]), rng.choice(["user", "assistant", "sy#<:\n\\s", None]),
             rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))]))
            for c in list(range(20)) * 12]
    rows += [(9, 0, "assistant", "same")] * 3 + [(None, 1, "assistant", "no id")]
    df = spark.createDataFrame(rows, ROW).repartition(4)
    parts = df.withColumn("content", chat.text_part(F.col("text")))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(chat.read_back(chat.format_chat(parts))).collect()}
    assert got == brute(rows)


def test_very_long_text_and_clashing_columns(spark):
    long = "### user: </turn>\\ é\n" * 60000
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", long), (2, 0, "assistant", "")]
    df = spark.createDataFrame(rows, ROW)
    for name in ("formatted", "body", "block", "segment", "t", "n_turns", "attachments", "loss_spans"):
        df = df.withColumn(name, F.lit("clash"))
    parts = df.withColumn("content", chat.text_part(F.col("text")))
    got = {r.conv_id: tuple(r)[1:5] for r in chat.digest(chat.read_back(chat.format_chat(parts))).collect()}
    assert got == brute(rows)


def test_typed_parts(spark):
    content = [("text", "see <|image|>", None, None, None, None, None),
               ("image", None, "a.png", 28, 29, None, None), ("audio", None, "b.wav", None, None, 1.5, None),
               ("text", "#", None, None, None, None, None), ("document", None, "c.pdf", None, None, None, 3),
               ("image", None, "unknown size", None, None, None, None), None]
    df = spark.createDataFrame([(1, 0, "user", content), (1, 1, "assistant", None)],
                               f"conv_id long, turn long, role string, content array<{chat.PART}>")
    row = chat.format_chat(df).first()
    assert row.formatted == ("### user: see \\l|image|><|image|><|audio|>\\h<|document|><|image|></turn>\n"
                             "### assistant: </turn>\n")
    assert [(a.type, a.ref, a.tokens) for a in row.attachments] == [
        ("image", "a.png", 6), ("audio", "b.wav", 38), ("document", "c.pdf", 768),
        ("image", "unknown size", 0)]
    assert row.expanded_tokens == 812
    assert [(s.segment, s.length) for s in row.loss_spans] == [(1, 0)]
    assert chat.format_chat(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    from conftest import SF001

    from tessera.llm.queries import op8_chat_format

    plan = op8_chat_format(spark, SF001)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
