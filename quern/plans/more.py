"""Queries of tokenizers, formats, templates, loaders and the rest of the sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import blend as B
from ..operators import chat as C
from ..operators import dedup as D
from ..operators import formats as R
from ..operators import media as M
from ..operators import packing as K
from ..operators import samples as S
from ..operators.tasks import task_texts
from ..operators.tokenizer import Tokenizer
from ..sources import files, pairs, shards
from ..session import table
from .chat import _M, _VA2

W = r"[\p{L}\p{N}_]"
_LENGTHS = f"list_transform(regexp_extract_all(lower(text), '{W}+'), lambda x: length(x))"
#: A data set whose turns are named in another way.
CONFIG = '{"logs": {"format": "sharegpt", "columns": {"messages": "conversation"}, "tags": {"role_tag": "from", "content_tag": "value", "user_tag": "human", "assistant_tag": "gpt"}}}'


def docs(s, d):
    return table(s, d, "documents")


def convs(s, d):
    return C.gathered(table(s, d, "conversations"))


def lengths(c="text"):
    return F.transform(words(F.col(c)), lambda w: F.length(w))


def joined(c, mark=","):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), mark)


def tokenizer(s):
    import public_tokenizers

    return Tokenizer(s, public_tokenizers.path("byte_bpe_50k.json"))


def _round_trip(s, d):
    t = tokenizer(s)
    return docs(s, d).select("doc_id", F.md5(t.detokenize(t.tokenize(F.col("text")))).alias("text"))


def _registry(s, d):
    role = lambda x: F.when(x == "user", "human").when(x == "assistant", "gpt").otherwise(x)
    c = convs(s, d).select("conv_id", F.transform("m", lambda x: F.struct(role(x["role"]).alias("from"), x["content"].alias("value"))).alias("conversation"))
    told = lambda m: F.md5(F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "|"))
    return R.unified(c, R.formats(CONFIG)["logs"], "conv_id").select("conv_id", "system", told("prompt").alias("prompt"), told("response").alias("response"), "d_len")


def _templates(s, d):
    texts = F.array(*[F.struct(F.lit(k).alias("template"), F.md5(F.array_join(R.rendered_turns(F.col("m"), k), "")).alias("text")) for k in R.TEMPLATES])
    return convs(s, d).select("conv_id", F.inline(texts))


def _tasks(s, d):
    b = table(s, d, "benchmark")
    out = task_texts(b, "lambada")
    out = out.union(task_texts(b.select(F.struct("text").alias("question")), "natural_questions"))
    return out.union(task_texts(b.select(F.split("text", " ").alias("questions")), "coqa"))


def _pairs(s, d):
    t = docs(s, d).select("doc_id", lengths().alias("ids"), F.encode("text", "UTF-8").alias("content"))
    got = pairs.ingest(t.select("doc_id", "ids"), t.select("doc_id", "content"), "doc_id", length=64, eod=0)
    return got.select("doc_id", "seq_no", "mode", F.size("tokens").alias("n"), F.md5(joined("tokens")).alias("tokens"))


def _images(s, d):
    """BMP files of no, black and other pixels, and what is no image."""
    head = F.unhex(F.lit("424D12000000000000000E000000"))
    made = F.when(F.col("doc_id") % 4 == 0, F.unhex(F.lit(""))).when(F.col("doc_id") % 4 == 1, F.concat(head, F.unhex(F.lit("00000000")))).when(F.col("doc_id") % 4 == 2, F.concat(head, F.unhex(F.lit("00010000")))).otherwise(F.encode("lang", "UTF-8"))
    return docs(s, d).select("doc_id", M.image_ok(made).alias("ok"))


def _collated(s, d):
    rows = docs(s, d).select("doc_id", F.expr("doc_id div 8").alias("batch"), F.slice(lengths(), 1, 100).alias("ids"))
    c = R.collated(rows, "batch", "ids", pad=-1, left=True)
    return c.select("doc_id", F.size("input_ids").alias("n"), F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("own"), F.md5(joined("input_ids")).alias("ids"))


def _payloads(s, d):
    p = shards.media_payload(F.col("m"), F.array(F.concat(F.lit("img/"), F.col("conv_id").cast("string"), F.lit(".jpg"))), fps=F.col("conv_id") % 5)
    return convs(s, d).select("conv_id", F.md5(p).alias("payload"))


QUERIES = {
    "T4_tokenizer_round_trip": _round_trip,
    "VA3_format_registry": _registry,
    "VA4_all_templates": _templates,
    "C3_task_texts": _tasks,
    "IO17_media_payloads": _payloads,
    "IO20_pair_ingest": _pairs,
    "F17_image_filter": _images,
    "X5_regular_sizes": lambda s, d: docs(s, d).select("doc_id", *[x.alias(n) for x, n in zip(M.regular_size((F.col("doc_id") % 500 + 1).cast("int"), (F.col("doc_id") * 37 % 9000 + 1).cast("int")), ("w", "h"))]),
    "X9_question_answers": lambda s, d: files.questions(docs(s, d).select(F.col("lang").alias("c0"), F.concat(F.lit("['"), "source", F.lit("', \"it's "), "lang", F.lit("\", 'a\\'b']")).alias("c1"), "doc_id").select("c0", "c1")).select("question", F.array_join("answers", "|").alias("answers")),
    "D8_keyed_sources": lambda s, d: D.keyed_sources([("docs", docs(s, d), "doc_id", "text"), ("pages", table(s, d, "pages"), "page_id", "url")]).select("id", "source", F.md5("text").alias("text")),
    "B10_worker_rotation": lambda s, d: B.dealt_to_workers(docs(s, d).where("lang = 'en'").select("doc_id"), ["doc_id"], 8, B.rotation_offsets([docs(s, d).where("lang <> 'en'").count(), 1], 8)[1]).select("doc_id", "worker"),
    "B10_virtual_epoch": lambda s, d: B.epoch_of(docs(s, d).select("doc_id"), ["doc_id"], 300, 2),
    "B10_shuffle_buffer": lambda s, d: B.shuffle_buffered(docs(s, d).select("doc_id"), ["doc_id"], 64),
    "K9_hash_buckets": lambda s, d: K.packed(docs(s, d).select(F.col("doc_id").alias("id"), F.size(words(F.col("text"))).alias("tokens")), 4096, 1000, "buckets"),
    "X14_without_long_pairs": lambda s, d: S.without_long_pairs(convs(s, d).select("conv_id", *[x.alias(n) for x, n in zip(C.first_pair(F.col("m")), ("prompt", "answer"))]), "prompt", "answer", 400).select("conv_id"),
    "X16_collated_batches": _collated,
    "X16_group_prompts": lambda s, d: R.group_prompts(convs(s, d)).select("conv_id", F.size("prompt").alias("n"), F.md5("solution").alias("solution")),
}


def _q(x: str) -> str:
    return "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"


def _values() -> str:
    rows = []
    for k, t in R.TEMPLATES.items():
        cols = [k, *t.user.split("{}"), *t.system.split("{}"), t.separator, t.default_system, "<s>" if t.begins == "prefix" else "", "<s>" if t.begins == "user" else "", "" if t.efficient_eos else "</s>"]
        rows.append("(" + ", ".join(map(_q, cols)) + f", {str(t.system_in_user).lower()})")
    return ", ".join(rows)


_TEMPLATES = f"""with t(template, ua, ub, sa, sb, sep, def, bp, bu, eos, inside) as (values {_values()}),
c as (select conv_id, case when len(m) % 2 = 1 then m[1].content end as own, case when len(m) % 2 = 1 then m[2:] else m end as r from {_M}),
j as (select *, case when coalesce(own, def) <> '' then sa || coalesce(own, def) || sb else '' end as sys from c, t),
u as (select conv_id, template, i, case when i % 2 = 0 then r[i].content || eos
when inside then case when i = 1 then bp else sep end || bu || ua || case when i = 1 then sys else '' end || r[i].content || ub
else case when i = 1 then bp || sys else sep end || bu || ua || r[i].content || ub end as x from (select *, unnest(range(1, len(r) + 1)) as i from j))
select conv_id, template, md5(string_agg(x, '' order by i)) as text from u group by all"""
_HEX = "hex(encode(text)) || repeat('00', (-octet_length(encode(text))) & 3)"
_PAD = "((-octet_length(encode(text))) & 3)::int"
_CUT = f"({_LENGTHS})[1:100]"

ORACLES = {
    "T4_tokenizer_round_trip": "select doc_id, md5(text) as text from documents",
    "VA3_format_registry": _VA2,
    "VA4_all_templates": _TEMPLATES,
    "C3_task_texts": "select 'lambada' as task, text from benchmark union all select 'natural_questions', text from benchmark union all select 'coqa', unnest(string_split(text, ' ')) from benchmark",
    "IO17_media_payloads": f"select conv_id, md5(to_json({{'messages': list_transform(m, lambda x: {{'role': x.role, 'content': x.content}}), 'images': ['img/' || conv_id || '.jpg'], 'fps': conv_id % 5}})::varchar) as payload from {_M}",
    "IO20_pair_ingest": f"""with o as (select row_number() over (order by doc_id) - 1 as o, {_LENGTHS} as ids, {_HEX} as hx, {_PAD} as pad from documents),
w as (select o, 0 as mode, case when len(ids) = 0 then ids else list_concat(ids[1:64], list_transform(range(0, greatest(64 - len(ids), 0)), lambda i: 0)) end as t from o union all
select o, 1, list_concat([pad], list_transform(regexp_extract_all(hx, '.{{8}}'), lambda x: (('0x' || x[7:8] || x[5:6] || x[3:4] || x[1:2])::bigint + 2147483648) % 4294967296 - 2147483648)) from o)
select o as doc_id, o * 2 + mode as seq_no, mode, len(t)::int as n, md5(array_to_string(t, ',')) as tokens from w""",
    "F17_image_filter": "select doc_id, doc_id % 4 = 2 as ok from documents",
    "X5_regular_sizes": "select doc_id, case when w / h > 200 then h * 180 else w end::int as w, case when h / w > 200 then w * 180 else h end::int as h from (select doc_id, greatest(doc_id % 500 + 1, 28) as w, greatest(doc_id * 37 % 9000 + 1, 28) as h from documents)",
    "X9_question_answers": "select lang as question, source || '|it''s ' || lang || '|a''b' as answers from documents",
    "D8_keyed_sources": "select 'docs:' || doc_id as id, 'docs' as source, md5(text) as text from documents union all select 'pages:' || page_id, 'pages', md5(url) from pages",
    "B10_worker_rotation": "select doc_id, ((row_number() over (order by doc_id) - 1 + (select count(*) from documents where lang <> 'en')) % 8)::int as worker from documents where lang = 'en'",
    "B10_virtual_epoch": "with o as (select doc_id, row_number() over (order by doc_id) - 1 as o, count(*) over () as n from documents), p as (select unnest(range(0, 300)) as place) select doc_id, place from p join o on o.o = (600 + place) % n",
    "X14_without_long_pairs": f"select conv_id from {_M} where coalesce(length(list_filter(m, lambda x: x.role = 'user')[1].content), 0) + coalesce(length(list_filter(m, lambda x: x.role = 'assistant')[1].content), 0) <= 400",
    "X16_collated_batches": f"""with d as (select doc_id, {_CUT} as ids, max(len({_CUT})) over (partition by doc_id // 8) as n from documents)
select doc_id, n::int as n, len(ids)::int as own, md5(array_to_string(list_concat(list_transform(range(0, n - len(ids)), lambda i: -1), ids), ',')) as ids from d""",
    "X16_group_prompts": f"select conv_id, (len(m) - 1)::int as n, md5(m[len(m)].content) as solution from {_M} where m[len(m)].role = 'assistant'",
}
