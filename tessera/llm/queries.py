"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bpe, brown, chat, decontam, html, langid, merkle, neardup, quality, simhash,
                         suffixdedup, toxicity, trie)

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def bpe_files() -> dict[str, str]:
    """Place of the installed rank file and its split pattern."""
    import public_tokenizers

    return {"path": public_tokenizers.path(BPE_RANKS), "pattern": public_tokenizers.PATTERN}


def op1_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), n=3, similarity=(85, 100))


OP1_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') as ws from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then []
    when len(ws) < 3 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) end) as sh
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as u, b.doc_id as v, count(*) as inter
  from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
l as (
  select u, v from p join n nu on nu.doc_id = u join n nv on nv.doc_id = v
  where 100 * inter >= 85 * (nu.n + nv.n - inter)),
r(u, v) as (select u, v from l union select r.u, l.v from r join l on r.v = l.u)
select d.doc_id, coalesce(n.n, 0) as n_shingles,
  least(d.doc_id, coalesce(m.lo, d.doc_id)) as component_id,
  d.doc_id = least(d.doc_id, coalesce(m.lo, d.doc_id)) as kept
from documents d left join n using (doc_id)
left join (select u as doc_id, min(v) as lo from r group by u) m using (doc_id)
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.suffix_dedup(_read(spark, sf_dir, "documents"), with_text=False)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_lines", "removed_chars")


def op4_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score_held_out(_read(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(_read(spark, sf_dir, "documents"),
                                  _read(spark, sf_dir, "benchmark"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "ambiguous")


OP2_SQL = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as hx from documents),
w as (
  select doc_id, i, md5(substr(hx, 2 * i + 1, 800)) as h
  from (select doc_id, hx, unnest(range(length(hx) // 2 - 399)) as i from d
        where length(hx) >= 800)),
r as (select doc_id, i from w where h in (select h from w group by h having count(*) > 1)),
g as (
  select doc_id, i, sum(case when i > before + 400 then 1 else 0 end)
    over (partition by doc_id order by i) as run
  from (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from r)),
s as (select doc_id, run, min(i) as b, max(i) + 400 as e from g group by doc_id, run),
p as (
  select doc_id, run, b, e, coalesce(lag(e) over (partition by doc_id order by run), 0) as after_last
  from s),
k as (
  select doc_id, count(*) as n_spans, sum(e - b) as n_removed, max(e) as last,
    string_agg(substr(hx, 2 * after_last + 1, 2 * (b - after_last)), '' order by run) as head
  from p join d using (doc_id) group by doc_id)
select doc_id, length(hx) // 2 as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(head, '') || substr(hx, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join k using (doc_id)
"""


OP3_SQL = r"""
with d as (
  select doc_id, coalesce(source, '') as host, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (
  select doc_id, unnest(range(1, len(ws) - 6)) as i, ws from d where len(ws) >= 8),
g as (select doc_id, i, array_to_string(ws[i:i + 7], ' ') as g from w),
c as (
  select doc_id, count(distinct i + k) as n_repeat_words from (
    select doc_id, i, unnest(range(8)) as k
    from g where (doc_id, g) in (select (doc_id, g) from g group by doc_id, g having count(*) > 1))
  group by doc_id),
l as (
  select doc_id, host, line, regexp_extract_all(translate(line,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000'),
    '[^\x20\x09-\x0D]+') as ws
  from (select doc_id, host, unnest(string_split(t, chr(10))) as line from d)),
lw as (select doc_id, host, line, array_to_string(ws, ' ') as norm,
  length(array_to_string(ws, '')) as chars from l where len(ws) > 0),
dup as (select doc_id, count(*) - count(distinct line) as n_dup_lines from lw group by doc_id),
h as (select host, count(*) as host_docs from d group by host),
common as (
  select host, norm from (select host, norm, count(distinct doc_id) as n from lw group by host, norm)
  join h using (host) where n >= 10 and n > host_docs * 0.005),
gone as (
  select doc_id, count(distinct norm) as removed_lines, sum(chars) as removed_chars
  from lw join common using (host, norm) group by doc_id),
b as (
  select doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    coalesce(removed_lines, 0) as removed_lines,
    cast(coalesce(removed_chars, 0) as bigint) as removed_chars
  from d left join dup using (doc_id) left join c using (doc_id) left join gone using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words)
    and word_chars - removed_chars >= word_chars * 0.5 as kept,
  removed_lines, removed_chars
from b
"""


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(_read(spark, sf_dir, "documents"), **bpe_files(), with_ids=False)


# A conversation whose texts hold the template's own control strings.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE_ID).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE_TEXT).alias("text"))
    parts = rows.unionByName(probe).withColumn("content", chat.text_part(F.col("text")))
    return chat.digest(chat.read_back(chat.format_chat(parts)))


OP8_SQL = r"""
with t as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, length(text) + (length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', ''))) as coded
  from t)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(4 + length(role) + 2 + coded + 8) as bigint) as formatted_chars
from e group by conv_id
"""


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(_read(spark, sf_dir, "pages"))


# The article of the given pages by pattern: their block elements are p, h1 and
# div, their references amp and quot.
OP10_SQL = r"""
with a as (
  select page_id, url, regexp_replace(regexp_replace(regexp_replace(
    regexp_extract(html, '<article>(.*?)</article>', 1, 's'),
    '</?(?:p|h1|div)\b[^>]*>', chr(1), 'g'), '</?b>', '', 'g'), '<[^>]+>', ' ', 'g') as body
  from pages),
u as (
  select page_id, url, regexp_replace(regexp_replace(body, '&quot;', '"', 'g'),
    '&amp;?', '&', 'g') as body from a),
t as (
  select page_id, url, array_to_string(list_filter(list_transform(string_split(body, chr(1)),
    lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''),
    chr(10) || chr(10)) as text from u)
select page_id, url, text, length(text) as n_chars from t
"""

def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    tampered = F.when((F.crc32(doc.cast("string")) % 2 == 0) & F.col("text").contains("\n"),
                      merkle.leaf_digest(text=F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    m = merkle.manifest(_read(spark, sf_dir, "documents"), tampered=tampered)
    proofs = merkle.prove(m, m.leaves).withColumn("now", F.coalesce("tampered", "leaf"))
    return merkle.verify(proofs, "now").select(
        "doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", "verified")


def _sql_crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text, bit by bit."""
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint),
    lambda c, b: list_reduce(range(8), lambda e, k: xor(e >> 1, 3988292384 * (e & 1)), xor(c, b)),
    4294967295), 4294967295)"""


def _sql_field(c: str) -> str:
    return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(map(_sql_field, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# Level by level from the leaves; then each leaf's siblings at every level below
# the last one, and the fold over them.
OP11_SQL = rf"""
with recursive d as (
  select doc_id, dense_rank() over (order by source nulls first) - 1 as tree,
    {_sql_leaf("text")} as leaf,
    case when {_sql_crc32("doc_id::varchar")} % 2 = 0
      then {_sql_leaf("replace(text, chr(10), '')")} end as tampered
  from documents),
l as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
    count(*) over (partition by tree) as cnt, row_number() over () as id from d),
n(tree, lvl, i, h, cnt) as (
  select tree, 0, pos, leaf, cnt from l
  union all
  select tree, lvl + 1, i // 3, sha256(string_agg(h, '' order by i)), (cnt + 2) // 3
  from n where cnt > 1 group by tree, lvl, i // 3, cnt),
sub as (select tree, h, lvl from n where cnt = 1),
t(lvl, i, h, cnt) as (
  select 0, tree, h, (select count(*) from sub) from sub
  union all
  select lvl + 1, i // 3, sha256(string_agg(h, '' order by i)), (cnt + 2) // 3
  from t where cnt > 1 group by lvl, i // 3, cnt),
root as (select h from t where cnt = 1),
up(id, step, pos, i, h) as (
  select l.id, n.lvl, l.pos // pow(3, n.lvl)::bigint, n.i, n.h
  from l join n on n.tree = l.tree and n.cnt > 1 and n.i // 3 = l.pos // pow(3, n.lvl + 1)::bigint
  union all
  select l.id, sub.lvl + t.lvl, l.tree // pow(3, t.lvl)::bigint, t.i, t.h
  from l join sub using (tree)
  join t on t.cnt > 1 and t.i // 3 = l.tree // pow(3, t.lvl + 1)::bigint),
steps as (
  select id, step, coalesce(string_agg(h, '' order by i) filter (i < pos), '') as a,
    coalesce(string_agg(h, '' order by i) filter (i > pos), '') as b
  from up group by id, step),
proof as (select id, string_agg(a || b, '' order by step) as p from steps group by id),
f(id, step, h) as (
  select id, 0, coalesce(tampered, leaf) from l
  union all
  select id, step + 1, sha256(a || h || b) from f join steps using (id, step)),
folded as (select id, arg_max(h, step) as h from f group by id)
select doc_id, leaf, sub.h as subroot, root.h as root, sha256(coalesce(p, '')) as proof_sha256,
  folded.h as folded_root, folded.h = root.h as verified
from l join sub using (tree) join folded using (id) left join proof using (id) cross join root
"""

def op12_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_duplicates(_read(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = trie.number_turns(_read(spark, sf_dir, "conversations"))
    return trie.prefix_trie(*trie.regroup(turns))


# A prefix is its turns' digests in order; sums run over all pairs of a node and
# its ancestors.
OP13_SQL = rf"""
with t as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, h) - 1 as p, h, n
  from (select conv_id, turn, strlen(coalesce(text, '')) as n,
      md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as h
    from conversations where conv_id is not null)),
k as (select c, c - c % 5 as base, {_sql_crc32("c::varchar")} % 9 as h from (select distinct c from t)),
m as (select k.c, k.base, k.h, least(k.h, coalesce((select count(*) from t where t.c = k.base), 0)) as m from k),
r as (
  select m.c, t.p + 1 as d, t.h, t.n from m join t on t.c = m.base and t.p < m.h
  union all
  select m.c, t.p - m.h + m.m + 1, t.h, t.n from m join t on t.c = m.c and t.p >= m.h),
x as (
  select c, d, n, string_agg(h, '') over (partition by c order by d) as key from r
  union all select c, 0, 0, '' from k),
l as (select c, max(d) as len from x group by c),
node as (
  select key, any_value(d) as depth, min(c) as conv_id, count(*) as n_convs, any_value(n) as n,
    coalesce(string_agg(c, ',' order by c) filter (d = len), '') as ends
  from x join l using (c) group by key),
kids as (
  select substr(key, 1, length(key) - 32) as key, count(*) as n_children from node where depth > 0 group by 1),
full_ as (select node.*, coalesce(n_children, 0) as n_children from node left join kids using (key)),
up as (select f.*, unnest(range(depth + 1)) as level from full_ f),
sums as (
  select substr(key, 1, 32 * level::int) as key, count(*) filter (n_children = 0) as n_leaves,
    sum((n_convs - 1) * n)::bigint as saved_tokens
  from up group by 1)
select f.conv_id, f.depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens,
  sha256(f.ends) as ends_sha256
from full_ f join sums using (key)
left join full_ p on f.depth > 0 and p.key = substr(f.key, 1, length(f.key) - 32)
"""


QUERIES = {
    "op1_minhash_neardup": op1_minhash_neardup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_brown_lm": op4_brown_lm,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_chat_format": op8_chat_format,
    "op9_language_id": op9_language_id,
    "op10_html_extraction": op10_html_extraction,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_simhash_neardup": op12_simhash_neardup,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op1_minhash_neardup": OP1_SQL,
    "op2_suffix_dedup": OP2_SQL,
    "op3_quality_rules": OP3_SQL,
    "op8_chat_format": OP8_SQL,
    "op10_html_extraction": OP10_SQL,
    "op11_merkle_manifest": OP11_SQL,
    "op13_prefix_trie": OP13_SQL,
}
