"""Chat formatting of typed content parts, in DataFrame functions only.

A turn's content is an ordered list of parts.  A visitor, one branch per part
type, flattens them: text is escaped, an image, audio clip or document becomes
an ordered placeholder, and its reference and expanded token count are recorded
as an attachment.  A turn is written as ``### role: content</turn>\\n``.

Escaping works on single characters, so no control string can arise where
parts meet: ``\\`` ``#`` ``<`` (and in roles ``:`` and line feed) become
``\\s`` ``\\h`` ``\\l`` (``\\c`` ``\\n``).  Every backslash in the output starts
an escape, hence undoing is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEP, CLOSE = "### ", ": ", "</turn>\n"
# Expanded token counts of attachments (documented parameters of the model side).
IMAGE_PATCH = 14          # pixels of an image patch side, one token each
AUDIO_TOKENS_PER_SECOND = 25
DOCUMENT_TOKENS_PER_PAGE = 256
TURNS_PER_BLOCK = 64      # turns joined before the conversation is

PART = ("struct<type:string,text:string,ref:string,width:int,height:int,"
        "seconds:double,pages:int>")

_TEXT_CODES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))
_ROLE_CODES = _TEXT_CODES + ((":", "\\c"), ("\n", "\\n"))


def _replace(col: Column, old: str, new: str) -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def escape(col: Column, codes=_TEXT_CODES) -> Column:
    for raw, code in codes:
        col = _replace(col, raw, code)
    return col


def unescape(col: Column, codes=_TEXT_CODES) -> Column:
    for raw, code in reversed(codes):
        col = _replace(col, code, raw)
    return col


def text_part(text: Column) -> Column:
    """A content list that holds one text part."""
    none = F.lit(None)
    return F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        none.cast("string").alias("ref"), none.cast("int").alias("width"),
        none.cast("int").alias("height"), none.cast("double").alias("seconds"),
        none.cast("int").alias("pages")))


def part_tokens(part: Column) -> Column:
    """Expanded token count of an attachment part; 0 for text or unknown sizes."""
    patches = (F.ceil(part["width"] / F.lit(float(IMAGE_PATCH)))
               * F.ceil(part["height"] / F.lit(float(IMAGE_PATCH))))
    return F.coalesce(
        F.when(part["type"] == "image", patches)
        .when(part["type"] == "audio", F.ceil(part["seconds"] * AUDIO_TOKENS_PER_SECOND))
        .when(part["type"] == "document", part["pages"] * F.lit(DOCUMENT_TOKENS_PER_PAGE)),
        F.lit(0)).cast("long")


def visit(part: Column) -> Column:
    """One part as it stands in the output: escaped text or a placeholder."""
    return (F.when(part["type"].isin("image", "audio", "document"),
                   F.concat(F.lit("<|"), part["type"], F.lit("|>")))
            .otherwise(escape(F.coalesce(part["text"], F.lit("")))))


def format_turns(turns: DataFrame, content: str = "content") -> DataFrame:
    """Rows ``(conv_id, turn, role, body, attachments)`` of formatted content.

    ``content`` is an array of parts (``PART``).  A null list or part is empty.
    Attachments keep their order: ``(turn, type, ref, tokens)``.
    """
    parts = F.filter(F.coalesce(F.col(content), F.array().cast(f"array<{PART}>")),
                     lambda p: p.isNotNull())
    attached = F.transform(
        F.filter(parts, lambda p: p["type"].isin("image", "audio", "document")),
        lambda p: F.struct(F.col("turn").cast("long").alias("turn"), p["type"].alias("type"),
                           p["ref"].alias("ref"), part_tokens(p).alias("tokens")))
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.array_join(F.transform(parts, visit), "").alias("body"),
        attached.alias("attachments"))


def format_chat(turns: DataFrame, content: str = "content") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans,
    attachments, expanded_tokens``.

    Turns are ordered by ``turn`` (null first), ``role`` and content, so ties
    and repeated rows have a defined place and all stay.  A null ``conv_id`` is
    one conversation.  ``loss_spans`` are ``(segment, start, length)`` in code
    points: the content of each assistant turn inside the segment that ends at
    the turn's close marker.

    Turns are first joined in blocks of turn numbers, so the work on a very
    long conversation is spread; the last step only concatenates blocks.
    """
    rows = format_turns(turns, content)
    head = F.concat(F.lit(OPEN), escape(F.col("role"), _ROLE_CODES), F.lit(SEP))
    rows = rows.select(
        "conv_id", F.floor(F.col("turn") / F.lit(TURNS_PER_BLOCK)).alias("block"),
        F.struct("turn", "role", "body",
                 F.char_length(head).alias("start"),
                 F.concat(head, F.col("body"), F.lit(CLOSE)).alias("segment"),
                 "attachments").alias("t"))
    block = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    block = block.select(
        "conv_id",
        F.struct(
            "block", F.size("ts").alias("n"),
            F.array_join(F.transform("ts", lambda t: t["segment"]), "").alias("formatted"),
            F.filter(F.transform("ts", lambda t, i: F.struct(
                i.alias("segment"), t["start"].alias("start"),
                F.when(t["role"] == "assistant", F.char_length(t["body"])).alias("length"))),
                lambda s: s["length"].isNotNull()).alias("spans"),
            F.flatten(F.transform("ts", lambda t: t["attachments"])).alias("attachments"),
        ).alias("b"))
    whole = block.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("bs"))
    # Segment numbers continue over blocks.
    start = F.expr("transform(bs, (b, i) -> cast(aggregate(slice(bs, 1, i), 0, "
                   "(a, x) -> a + x.n) as int))")
    whole = whole.withColumn("starts", start)
    return whole.select(
        "conv_id",
        F.expr("aggregate(bs, 0L, (a, b) -> a + b.n)").alias("n_turns"),
        F.array_join(F.transform("bs", lambda b: b["formatted"]), "").alias("formatted"),
        F.flatten(F.zip_with("bs", "starts", lambda b, s: F.transform(
            b["spans"], lambda x: F.struct((x["segment"] + s).alias("segment"),
                                           x["start"].alias("start"),
                                           x["length"].alias("length"))))).alias("loss_spans"),
        F.flatten(F.transform("bs", lambda b: b["attachments"])).alias("attachments"),
    ).withColumn("expanded_tokens",
                 F.expr("aggregate(attachments, 0L, (a, x) -> a + x.tokens)"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns array<struct<role, text>>, loss_text`` parsed from the
    formatted string and its loss spans alone.  Placeholders stay as written
    in ``text``; text is unescaped."""
    f = formatted.withColumn("_seg", F.split("formatted", CLOSE))
    f = f.withColumn("_seg", F.expr("slice(_seg, 1, size(_seg) - 1)"))
    turns = F.transform("_seg", lambda s: F.struct(
        unescape(F.substring_index(F.substr(s, F.lit(len(OPEN) + 1)), SEP, 1),
                 _ROLE_CODES).alias("role"),
        unescape(F.substr(s, F.locate(SEP, s) + F.lit(len(SEP)))).alias("text")))
    loss = F.array_join(F.transform("loss_spans", lambda x: unescape(F.substr(
        F.element_at("_seg", x["segment"] + 1), x["start"] + 1, x["length"]))), "")
    return f.select("conv_id", turns.alias("turns"), loss.alias("loss_text"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"))


def digest(parsed: DataFrame) -> DataFrame:
    """The digests of what ``read_back`` found."""
    flat = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")
