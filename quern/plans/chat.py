"""Queries of conversations, time buckets, vectors and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chat as C
from ..operators import metrics as M
from ..operators import timebucket as S
from ..operators import vector as V
from ..session import table

W = r"[\p{L}\p{N}_]"


def convs(s, d):
    return C.gathered(table(s, d, "conversations"))


def _json(c):
    return F.array_join(F.transform(c, lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "|")


def events(s, d):
    """Per user: whole seconds from the first event, folded into a day of 240 seconds to make runs and clashes."""
    e = table(s, d, "events").select(F.col("user_id").alias("key"), F.expr("pmod(unix_seconds(cast(ts as timestamp)), 240)").alias("t"), F.col("event_type").alias("value"), F.col("event_id").alias("ord"))
    return e


def _filled(s, d):
    return S.gap_filled(S.bucketed(events(s, d), 5, 200), 40, 4)


def _neigh(s, d):
    e = table(s, d, "embeddings")
    return V.top_inner_products(e.where("vec_id % 50 = 0"), e, 20)


def _scores(s, d):
    lab = table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "text"), "doc_id")
    return lab.select("quality", F.least(F.lit(1.0), F.length("text") / 2000.0).alias("score"), "doc_id")


def _pairs(s, d):
    c = table(s, d, "conversations")
    a, b = c.where("turn = 0").select("conv_id", F.col("text").alias("answer")), c.where("turn = 1").select("conv_id", F.col("text").alias("guess"))
    return a.join(b, "conv_id")


_M = "(select conv_id, list({'turn': turn, 'role': role, 'content': text} order by turn, role, text) as m from conversations group by conv_id)"
_BUCK = "(select user_id as key, least(floor(epoch(ts))::bigint % 240 // 5, 39) as bucket, arg_max(event_type, (floor(epoch(ts))::bigint % 240) * 100000000 + event_id) as value from events where floor(epoch(ts))::bigint % 240 <= 200 group by all)"
_FILLED = f"""bk as materialized {_BUCK}, gr as (select key, unnest(range(0, least(40, max(bucket) + 5))) as bucket from bk group by key),
fl as (select key, bucket, coalesce(value, '</silence>') as value from gr left join bk using (key, bucket))"""
_IP = """nn as (select a.vec_id as query_id, b.vec_id, list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::double * b.embedding[i]::double)) as score from embeddings a, embeddings b where a.vec_id % 50 = 0),
tk as materialized (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from nn qualify rank <= 20)"""
_NORM = r"array_to_string(list_filter(string_split_regex(regexp_replace(lower({}), '[!-/:-@\[-`{{-~]', '{}', 'g'), '\s+'), lambda w: w not in ('', 'a', 'an', 'the')), ' ')"
_PAIRS = "(select a.conv_id, a.text as answer, b.text as guess from conversations a join conversations b using (conv_id) where a.turn = 0 and b.turn = 1)"
_F1 = f"""with p as (select conv_id, string_split({_NORM.format('guess', ' ')}, ' ') as g, string_split({_NORM.format('answer', ' ')}, ' ') as a from {_PAIRS}),
o as (select conv_id, list_filter(g, lambda w: w <> '') as g, list_filter(a, lambda w: w <> '') as a from p),
q as (select *, coalesce(list_sum(list_transform(list_distinct(list_intersect(g, a)), lambda w: least(len(list_filter(g, lambda x: x = w)), len(list_filter(a, lambda x: x = w))))), 0) as c from o)
select conv_id, case when len(a) = 0 then null when len(g) = 0 or c = 0 then 0.0 else round(2.0 * c / (len(g) + len(a)), 9) end as f1 from q"""
_SWEEP = "(select k::int as step, avg(((s >= k / 100.0)::int = quality)::int) as accuracy from (select quality, least(1.0, length(text) / 2000.0::double) as s from labels join documents using (doc_id)), (select unnest(range(0, 100)) as k) group by k)"

QUERIES = {
    "VA1_instruction_unified": lambda s, d: C.alpaca_unified(_pairs(s, d).withColumn("empty", F.lit("")), "answer", "empty", "guess").select("conv_id", F.md5(_json("prompt")).alias("prompt"), F.md5(_json("response")).alias("response"), "d_len"),
    "VA2_role_tagged_unified": lambda s, d: C.sharegpt_unified(convs(s, d)).select("conv_id", "system", F.md5(_json("prompt")).alias("prompt"), F.md5(_json("response")).alias("response"), "d_len"),
    "VA4_template_render": lambda s, d: convs(s, d).select("conv_id", F.md5(C.rendered(F.col("m"))).alias("text")),
    "VA5_chatml_render": lambda s, d: convs(s, d).select("conv_id", F.length(C.chatml(F.col("m"))).alias("n"), F.md5(C.chatml(F.col("m"))).alias("text")),
    "VA6_budgeted_truncation": lambda s, d: _pairs(s, d).select("conv_id", *[x.alias(n) for x, n in zip(C.budgeted(F.length("answer"), F.length("guess"), 512), ("source", "target"))]),
    "VA8_prompt_response": lambda s, d: convs(s, d).select("conv_id", *[x.alias(n) for x, n in zip(C.first_pair(F.col("m")), ("prompt", "response"))]),
    "VA9_fitted_rounds": lambda s, d: convs(s, d).select("conv_id", F.size(C.fitted_rounds(F.col("m"), 3000)).alias("kept")),
    "VA10_context_rows": lambda s, d: C.context_rows(table(s, d, "conversations")).select("conv_id", "turn", F.md5("context").alias("context"), F.md5("response").alias("response")),
    "P11_role_map": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", *[x.alias(n) for x, n in zip(C.role_mapped(F.col("role"), F.col("text")), ("role", "text"))]),
    "X7_question_prompt": lambda s, d: convs(s, d).select("conv_id", F.md5(C.question_prompt(F.col("m"))).alias("prompt")),
    "P13_format_reward": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", T.format_reward(F.concat(F.lit("<think>"), F.col("role"), F.lit("</think> <answer>"), F.col("text"), F.lit("</answer>"))).alias("reward")),
    "S1_time_parse": lambda s, d: table(s, d, "events").select("event_id", F.array_join(F.transform(S.parsed_times(F.concat((F.col("event_id") % 60).cast("string"), F.lit(", "), F.round("value", 2).cast("string"))), lambda x: x.cast("string")), ";").alias("t")),
    "S2_tumbling_buckets": lambda s, d: S.bucketed(events(s, d), 5, 200),
    "S3_horizon_rejects": lambda s, d: S.bucketed(events(s, d), 5, 238, truncated=False),
    "S5_gap_fill": lambda s, d: _filled(s, d),
    "S6_run_weights": lambda s, d: S.run_weights(_filled(s, d)),
    "S8_adaptive_rate": lambda s, d: table(s, d, "events").select("event_id", S.adaptive_rate(F.col("event_id") % 200).alias("fps")),
    "S9_even_spaced": lambda s, d: table(s, d, "events").select("event_id", F.array_join(F.transform(S.even_spaced((F.col("event_id") % 300 + 1).cast("int"), 8), lambda x: x.cast("string")), ",").alias("f")),
    "S12_resize": lambda s, d: table(s, d, "events").select("event_id", *[x.alias(n) for x, n in zip(S.resized((F.col("event_id") % 4000 + 1).cast("double"), (F.col("event_id") * 7 % 3000 + 1).cast("double")), ("w", "h"))]),
    "S16_event_counters": lambda s, d: table(s, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
    "X6_video_frames": lambda s, d: table(s, d, "events").select("event_id", S.video_frames(F.col("event_id") % 500, 64, F.col("event_id") % 97 / 1.0, 2.0).alias("n")),
    "V1_exact_inner_product": lambda s, d: _neigh(s, d).select("query_id", "vec_id", "rank", F.round("score", 6).alias("score")),
    "V6_ban_and_pad": lambda s, d: V.banned(_neigh(s, d), table(s, d, "embeddings"), 5).select("query_id", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids")),
    "J6_continuation": lambda s, d: V.continued(_neigh(s, d), 500).select("query_id", "vec_id", "k", "chunk"),
    "V4_coarse_cells": lambda s, d: V.cells(table(s, d, "embeddings")).groupBy("cell").agg(F.count(F.lit(1)).alias("n")),
    "V8_block_map": lambda s, d: table(s, d, "embeddings").select("vec_id", V.block_of(F.col("vec_id"), 64).alias("block")),
    "A2_token_f1": lambda s, d: _pairs(s, d).select("conv_id", F.round(M.f1(F.col("guess"), F.col("answer")), 9).alias("f1")),
    "A3_exact_match": lambda s, d: _pairs(s, d).select("conv_id", M.exact_match(F.col("guess"), F.col("answer")).alias("same")),
    "A4_answer_contained": lambda s, d: _pairs(s, d).select("conv_id", M.contains_answer(F.col("guess"), F.substring_index("answer", " ", 2)).alias("held")),
    "A5_hit_curve": lambda s, d: M.hit_curve(_neigh(s, d).join(table(s, d, "embeddings").select("vec_id", "label"), "vec_id").join(table(s, d, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql")), "query_id").where("vec_id <> query_id").withColumn("hit", F.col("label") == F.col("ql")), 10),
    "A7_perplexity": lambda s, d: table(s, d, "documents").select("doc_id", F.round(M.perplexity(F.length("text") / 3.0, F.col("n_chars") / 4 + 2), 6).alias("ppl")),
    "A9_threshold_sweep": lambda s, d: M.best_threshold(M.threshold_sweep(_scores(s, d), "score", "quality")).select("step", F.round("accuracy", 9).alias("accuracy")),
    "A11_accuracy": lambda s, d: _scores(s, d).select(((F.col("score") >= 0.5).cast("int") == F.col("quality")).alias("ok")).agg(F.count_if("ok").alias("right"), F.count(F.lit(1)).alias("n")),
    "A12_relative_difference": lambda s, d: M.relative_difference(table(s, d, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")), ["l_returnflag"], "l_extendedprice", "net"),
}

_JS = "array_to_string(list_transform({}, lambda x: x.role || ':' || x.content), '|')"
_VA2 = f"""with c as {_M}, b as (select conv_id, m, list_position(list_transform(m, lambda x: x.role), 'system') as p from c),
r as (select conv_id, case when p > 0 then m[p].content else '' end as system, case when p > 0 then list_concat(m[1:p-1], m[p+1:]) else m end as r from b),
k as (select conv_id, system, case when len(r) % 2 = 0 and len(list_filter(list_transform(r, lambda x, i: case when i % 2 = 1 then x.role in ('user', 'observation') else x.role in ('assistant', 'function') end), lambda o: not o)) = 0 then r else r[1:0] end as r from r)
select conv_id, system, md5({_JS.format('r[1:len(r)-1]')}) as prompt, md5({_JS.format('r[greatest(len(r), 1):len(r)]')}) as response, coalesce(list_sum(list_transform(r, lambda x: length(x.content))), 0)::bigint as d_len from k"""
_CML = f"case when m[1].role = 'system' then '' else '<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10) end || replace(array_to_string(list_transform(m, lambda x: '<|im_start|>' || x.role || chr(10) || x.content || '<|im_end|>' || chr(10)), ''), '<image>', '{C.VISION}')"
_S, _T = "length(answer)", "length(guess)"
_TT = f"least(case when {_T} * 2 < 512 then 512 when {_S} * 2 < 512 then 512 - {_S} else floor(512.0::double * ({_T}::double / greatest({_S} + {_T}, 1))) end, {_T})::bigint"

_NEAR = "greatest(round_even({0} / 28.0::double, 0) * 28, 28)"
_SIDE = "case when big then greatest(floor({0} / shrink / 28) * 28, 28) when small then ceil({0} * grow / 28) * 28 else " + _NEAR + " end"

ORACLES = {
    "VA9_fitted_rounds": f"select conv_id, (n - n % 2)::int as kept from (select conv_id, len(list_filter(range(1, len(m) + 1), lambda i: list_sum(list_transform(m[1:i], lambda x: length(x.content))) <= 3000)) as n from {_M})",
    "S1_time_parse": "select event_id, (event_id % 60)::int || ';' || floor(round(value, 2))::int as t from events",
    "S12_resize": f"""with e as (select event_id, (event_id % 4000 + 1)::double as w, (event_id * 7 % 3000 + 1)::double as h from events),
b as (select *, {_NEAR.format('w')} * {_NEAR.format('h')} > 1003520 as big, {_NEAR.format('w')} * {_NEAR.format('h')} < 3136 as small, sqrt(w * h / 1003520.0::double) as shrink, sqrt(3136.0::double / (w * h)) as grow from e)
select event_id, case when greatest(w, h) / least(w, h) <= 200 then ({_SIDE.format('w')})::int end as w, case when greatest(w, h) / least(w, h) <= 200 then ({_SIDE.format('h')})::int end as h from b""",
    "VA1_instruction_unified": f"select conv_id, md5('user:' || answer) as prompt, md5('assistant:' || guess) as response, (length(answer) + length(guess))::bigint as d_len from {_PAIRS}",
    "VA2_role_tagged_unified": _VA2,
    "VA4_template_render": f"select conv_id, md5(array_to_string(list_transform(m, lambda x, i: case when i % 2 = 1 and i > 1 then chr(10) else '' end || case when i % 2 = 1 then 'User: ' else 'Assistant: ' end || x.content || chr(10)), '')) as text from {_M}",
    "VA5_chatml_render": f"select conv_id, length({_CML})::int as n, md5({_CML}) as text from {_M}",
    "VA6_budgeted_truncation": f"select conv_id, least(greatest(512 - {_TT}, 0), {_S})::bigint as source, {_TT} as target from {_PAIRS}",
    "VA8_prompt_response": f"select conv_id, list_filter(m, lambda x: x.role = 'user')[1].content as prompt, list_filter(m, lambda x: x.role = 'assistant')[1].content as response from {_M}",
    "VA10_context_rows": "select conv_id, turn, md5(context) as context, md5(text) as response from (select conv_id, turn, role, text, string_agg(text, ' [SEP] ') over (partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as context, row_number() over (partition by conv_id order by turn) as k from conversations) where k > 1 and role = 'assistant'",
    "P11_role_map": f"select conv_id, turn, case role when 'human' then 'user' when 'gpt' then 'assistant' else role end as role, regexp_replace(text, '\\n?<image>\\n?', '{C.VISION}', 'g') as text from conversations",
    "X7_question_prompt": f"select conv_id, md5(array_to_string(list_transform(m, lambda x, i: case when i % 2 = 1 then 'Question: ' || x.content else ' Answer: ' || x.content || chr(10) end), '')) as prompt from {_M}",
    "P13_format_reward": "select conv_id, turn, case when contains(text, chr(10)) then 0.0 else 1.0 end::double as reward from conversations",
    "S2_tumbling_buckets": f"select * from {_BUCK}",
    "S3_horizon_rejects": "select user_id as key, least(floor(epoch(ts))::bigint % 240 // 5, 47) as bucket, arg_max(event_type, (floor(epoch(ts))::bigint % 240) * 100000000 + event_id) as value from events where user_id not in (select user_id from events where floor(epoch(ts))::bigint % 240 > 238) group by all",
    "S5_gap_fill": f"with {_FILLED} select * from fl",
    "S6_run_weights": f"with {_FILLED} select *, case when value <> '</silence>' then 1.0 when lag(value) over (partition by key order by bucket) = '</silence>' then 0.1 else 0.5 end::double as weight from fl",
    "S8_adaptive_rate": "select event_id, case when event_id % 200 >= 160 then 1 when event_id % 200 >= 64 then 2 else 4 end as fps from events",
    "S9_even_spaced": "select event_id, array_to_string(list_transform(range(0, 8), lambda i: floor(i * ((event_id % 300) / 7.0::double))::int), ',') as f from events",
    "S16_event_counters": "select event_type, count(*) as n from events group by event_type",
    "X6_video_frames": "select event_id, (floor(floor(least((event_id % 500)::double, 64.0, event_id % 97 * 2.0)) / 2) * 2)::int as n from events",
    "V1_exact_inner_product": f"with {_IP} select query_id, vec_id, rank, round(score, 6) as score from tk",
    "V6_ban_and_pad": f"with {_IP}, lf as (select query_id, vec_id, rank, row_number() over (partition by query_id order by rank) as nr from tk join embeddings b using (vec_id) join embeddings a on a.vec_id = query_id where a.label <> b.label qualify nr <= 5), g as (select query_id, list(vec_id order by nr) as ids from lf group by query_id) select query_id, array_to_string(list_concat(ids, list_transform(range(0, 5 - len(ids)), lambda i: -1)), ',') as ids from g",
    "J6_continuation": f"with {_IP} select query_id, vec_id, k::int as k, (vec_id + k) % 500 as chunk from tk, (select unnest([0, 1]) as k)",
    "V8_block_map": "select vec_id, vec_id // 64 as block from embeddings",
    "A2_token_f1": _F1,
    "A3_exact_match": f"select conv_id, {_NORM.format('guess', '')} = {_NORM.format('answer', '')} as same from {_PAIRS}",
    "A4_answer_contained": f"select conv_id, contains(' ' || {_NORM.format('guess', ' ')} || ' ', ' ' || {_NORM.format('short', ' ')} || ' ') as held from (select *, array_to_string(string_split(answer, ' ')[1:2], ' ') as short from {_PAIRS})",
    "A5_hit_curve": f"with {_IP}, h as (select query_id, min(case when a.label = b.label then rank end) as first from tk join embeddings b using (vec_id) join embeddings a on a.vec_id = query_id where vec_id <> query_id group by query_id) select k::int as k, round(avg(coalesce((first <= k)::int, 0)), 9) as accuracy from h, (select unnest(range(1, 11)) as k) group by k",
    "A7_perplexity": "select doc_id, round(exp(least(20.0, (length(text) / 3.0::double) / (n_chars / 4::double + 2 - 1))), 6) as ppl from documents",
    "A9_threshold_sweep": f"select step, round(accuracy, 9) as accuracy from {_SWEEP} order by accuracy desc, step limit 1",
    "A11_accuracy": "select count(*) filter ((least(1.0, length(text) / 2000.0::double) >= 0.5)::int = quality) as right, count(*) as n from labels join documents using (doc_id)",
    "A12_relative_difference": "select l_returnflag, round(sum(abs(l_extendedprice - l_extendedprice * (1 - l_discount))) / sum(abs(l_extendedprice)), 3) as difference from lineitem group by 1",
}
