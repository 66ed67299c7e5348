"""Queries of chunks, sample windows, blends and packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import blend as B
from ..operators import packing as K
from ..operators import windows as X
from ..session import table

W = r"[\p{L}\p{N}_]"
_WS = f"regexp_extract_all(lower(text), '{W}+')"
_N = f"len({_WS})"


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def sizes(spark, sf):
    return docs(spark, sf).select(F.col("doc_id").alias("id"), F.size(words(F.col("text"))).cast("long").alias("tokens"))


def stream(spark, sf):
    return X.document_stream(docs(spark, sf), "doc_id", F.size(words(F.col("text"))) + 1)


def turn_tokens(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.concat(words(F.col("text")), F.array(F.lit("<eod>"))).alias("w"))
    g = c.groupBy("conv_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("turn", "w"))), lambda x: x["w"])).alias("w"))
    return g.select(F.col("conv_id").alias("key"), F.posexplode("w").alias("i", "token"))


def joined(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def _all_sizes(s, d):
    """Samples of every source, null last."""
    return [r["count"] for r in sorted(table(s, d, "documents").groupBy("source").count().collect(), key=lambda r: (r.source is None, r.source or ""))]


_SOURCES = "(select (row_number() over (order by source nulls last) - 1)::int as k, count(*) as n from documents group by source)"
_GREEDY = """with recursive fv as materialized """ + _SOURCES + """, c as (select list(n / (select sum(n) from fv) order by k) as w, list(n order by k) as n from fv),
st as (select 0::bigint as i, -1 as p, list_transform(w, lambda x: 0::bigint) as cnt, w, n from c union all
select i + 1, b, list_transform(cnt, lambda x, j: case when j = b + 1 then x + 1 else x end), w, n from
(select *, list_reduce(list_transform(range(0, len(w)), lambda k: {'v': w[k+1] * greatest(i, 1) - cnt[k+1] - case when cnt[k+1] >= CAP then 1e12 else 0 end, 'k': k}), lambda a, x: case when x.v > a.v then x else a end).k::int as b from st where i < list_sum(n)))
select i - 1 as i, p as dataset, row_number() over (partition by p order by i) - 1 as sample from st where i > 0"""
_STREAM = f"(select doc_id, {_N} + 1 as len, row_number() over (order by doc_id) - 1 as pos, coalesce(sum({_N} + 1) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as start from documents)"
_ORD = "(select doc_id, row_number() over (order by doc_id) - 1 as ord from documents)"
_COUNT = "(select count(*) from documents)"
_SENT = f"list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda s: len(regexp_extract_all(lower(s), '{W}+'))), lambda k: k > 0)"
_LENS = "case when len(n) = 0 then n else list_concat(n[1:len(n) - 1], [n[len(n)] + 1]) end"
_CHUNKS = f"(select doc_id, w, unnest(range(0, len(w), 64)) as start from (select doc_id, {_WS} as w from documents) where len(w) > 0)"
_PAD = "list_concat(w[start+1:start+64], list_transform(range(0, greatest(start + 64 - len(w), 0)), lambda i: '<eod>'))"
_EDGES = [0, 64, 128, 256, 512, 1024, 100000]

QUERIES = {
    "T2_encode_documents": lambda s, d: X.encoded(docs(s, d)).select(F.col("id").alias("doc_id"), joined("lens").alias("lens"), "n_tokens"),
    "T5_fixed_chunks": lambda s, d: X.chunks(docs(s, d)).select(F.col("id").alias("doc_id"), "chunk", "start", "stop"),
    "T6_chunk_validity": lambda s, d: X.chunk_validity(X.chunks(docs(s, d))).withColumnRenamed("id", "doc_id"),
    "T7_chunk_offsets": lambda s, d: X.chunk_offsets(X.chunk_validity(X.chunks(docs(s, d)))).select(F.col("id").alias("doc_id"), "n_valid", "offset", "train"),
    "T8_padded_chunks": lambda s, d: X.chunks(docs(s, d)).select(F.col("id").alias("doc_id"), "chunk", F.md5(F.array_join("tokens", " ")).alias("tokens")),
    "W1_epochs": lambda s, d: sizes(s, d).agg(F.sum("tokens").alias("tokens")).withColumn("epochs", F.expr("cast(ceil((100000L * 128 + 1) / cast(tokens as double)) as bigint)")),
    "W2_document_index": lambda s, d: X.shuffle_index(docs(s, d), "doc_id", 1234),
    "W3_sample_index": lambda s, d: X.sample_index(stream(s, d), 256),
    "W4_shuffle_index": lambda s, d: X.shuffle_index(X.sample_index(stream(s, d), 256), "sample", 7),
    "W5_sample_spans": lambda s, d: X.sample_spans(stream(s, d), 256),
    "W6_labels_and_positions": lambda s, d: X.token_labels(turn_tokens(s, d)),
    "W13_evaluation_windows": lambda s, d: X.evaluation_windows(sizes(s, d).withColumnRenamed("tokens", "n"), 256, 32),
    "W14_last_word_cloze": lambda s, d: X.last_word_cloze(docs(s, d)).select(F.col("id").alias("doc_id"), F.md5("context").alias("context"), "label"),
    "W15_sample_chunks": lambda s, d: X.sample_index(stream(s, d), 256).select("sample", F.posexplode(F.sequence(F.lit(0), F.lit(3))).alias("k", "_v")).select((F.col("sample") * 4 + F.col("k")).alias("chunk"), "sample"),
    "B2_normalized_weights": lambda s, d: table(s, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).crossJoin(F.broadcast(table(s, d, "documents").agg(F.count(F.lit(1)).alias("t")))).select("source", F.round(F.col("n") / F.col("t"), 9).alias("weight")),
    "B3_greedy_blend": lambda s, d: B.blend_ranges(s, _all_sizes(s, d)),
    "B4_exhaustive_blend": lambda s, d: B.blend_ranges(s, _all_sizes(s, d), exhaustive=True),
    "B6_range_split": lambda s, d: B.range_split(docs(s, d).select("doc_id"), ["doc_id"], "969,30,1").select("doc_id", "split"),
    "B7_requested_sizes": lambda s, d: table(s, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n")).select("source", B.requested(F.lit(1000.0), F.col("n") / 997.0).alias("asked")),
    "B8_interleave": lambda s, d: B.interleaved([docs(s, d).where("doc_id % 3 = 0").select("doc_id"), docs(s, d).where("doc_id % 3 <> 0").select("doc_id")], ["doc_id"]),
    "B8_interleave_all": lambda s, d: B.interleaved([docs(s, d).where("doc_id % 3 = 0").select("doc_id"), docs(s, d).where("doc_id % 3 <> 0").select("doc_id")], ["doc_id"], "all"),
    "B9_take_and_skip": lambda s, d: B.range_split(docs(s, d).select("doc_id"), ["doc_id"], "90,10,0").groupBy("split").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count(F.lit(1)).alias("n")),
    "B11_sequential_sampler": lambda s, d: B.sequential_batches(docs(s, d).select("doc_id"), ["doc_id"], 4, 2, consumed=16),
    "B13_length_pools": lambda s, d: B.pooled(docs(s, d).select("doc_id"), ["doc_id"], 64),
    "B15_length_order": lambda s, d: sizes(s, d).orderBy("tokens", "id"),
    "IO14_round_robin": lambda s, d: B.running(docs(s, d).select("doc_id"), ["doc_id"]).select("doc_id", (F.col("ord") % 7).alias("robin"), F.expr("ord div 150").alias("run")),
    "K1_token_info": lambda s, d: K.parsed(docs(s, d).select(F.concat(F.lit("doc"), (F.col("doc_id") % 500).cast("string"), F.lit(":"), F.length("text").cast("string")).alias("line"), F.col("doc_id").alias("ord"))),
    "K2_length_summary": lambda s, d: K.length_summary(sizes(s, d)),
    "K2_length_ranges": lambda s, d: K.length_ranges(sizes(s, d), _EDGES),
    "K3_first_fit_decreasing": lambda s, d: K.packed(sizes(s, d), 4096, 10, "ffd"),
    "K5_best_fit_decreasing": lambda s, d: K.packed(sizes(s, d), 4096, 10, "bfd"),
    "K6_packing_report": lambda s, d: K.report(K.packed(sizes(s, d), 4096, 10, "bfd"), 4096),
    "K8_greedy_knapsack": lambda s, d: K.packed(sizes(s, d).where("tokens <= 4096"), 4096, 10, "knapsack"),
    "K12_padding": lambda s, d: docs(s, d).select("doc_id", F.md5(F.array_join(K.padded(words(F.col("text")), 8, F.lit("<pad>"), most=100), " ")).alias("right"), F.md5(F.array_join(K.padded(words(F.col("text")), 8, F.lit("<pad>"), True, 100), " ")).alias("left")),
}

_CUT = f"(select doc_id, ({_WS})[1:100] as w from documents)"
_FILL = "list_transform(range(0, ((8 - len(w) % 8) % 8)), lambda i: '<pad>')"
_THIRD = "(select doc_id, case when doc_id % 3 = 0 then 0 else 1 end as dataset from documents)"
_INTER = f"select doc_id, dataset, (o * 2 + dataset)::bigint as place from (select *, row_number() over (partition by dataset order by doc_id) - 1 as o from {_THIRD})"
_SPLIT = f"case when ord < round_even({{a}} * {_COUNT}, 0) then 0 when ord < round_even({{b}} * {_COUNT}, 0) then 1 else 2 end"

# one sample after the other by size: PLACE is the bin (from 1) it goes to, null for a new one
_FIT = f"""with recursive it as materialized (select row_number() over (order by tokens desc, id) as k, id, tokens from (select doc_id as id, {_N}::bigint as tokens from documents)),
st as (select 0::bigint as k, []::bigint[] as room, []::bigint[] as cnt, 0 as bin, 0::bigint as id, 0::bigint as tokens union all
select k, case when p is null then list_append(room, 4096 - tokens) else list_transform(room, lambda x, i: case when i = p then x - tokens else x end) end,
case when p is null then list_append(cnt, 1) else list_transform(cnt, lambda x, i: case when i = p then x + 1 else x end) end, (coalesce(p, len(room) + 1) - 1)::int, id, tokens
from (select it.k, st.room, st.cnt, it.id, it.tokens, PLACE as p from st join it on it.k = st.k + 1)),
pk as (select 0 as shard, bin, id, tokens, tokens > 4096 as oversize from st where k > 0)"""
_OPEN = "list_filter(range(1, len(st.room) + 1), lambda i: st.room[i] >= it.tokens and st.cnt[i] < 10)"
_FFD = _FIT.replace("PLACE", f"list_min({_OPEN})")
_BFD = _FIT.replace("PLACE", f"(list_min(list_transform(list_filter({_OPEN}, lambda i: st.room[i] > 0), lambda i: st.room[i] * 1000000 + i)) % 1000000)")
# one bin after the other takes the largest that fits; rest: what waits, rising
_SACK = f"""with recursive st as (select 0 as step, -1 as bin, 0::bigint as room, list({{'t': tokens, 'id': id}} order by tokens, id) as rest, null::struct(t bigint, id bigint) as x from (select doc_id as id, {_N}::bigint as tokens from documents) where tokens <= 4096 union all
select step + 1, case when p = 0 then bin + 1 else bin end, case when p = 0 then 4096 else room - rest[p].t end, case when p = 0 then rest else list_concat(rest[1:p-1], rest[p+1:]) end, case when p > 0 then rest[p] end
from (select *, len(list_filter(rest, lambda y: y.t <= room and bin >= 0)) as p from st where len(rest) > 0))
select 0 as shard, bin, x.id as id, x.t as tokens, false as oversize from st where x is not null"""
_VALID = f"(select doc_id, count(*) filter (len(list_filter({_PAD}, lambda t: regexp_full_match(t, '\\p{{L}}+'))) > 0) as n_valid from {_CHUNKS} group by doc_id)"

ORACLES = {
    "K3_first_fit_decreasing": f"{_FFD} select * from pk",
    "K5_best_fit_decreasing": f"{_BFD} select * from pk",
    "K6_packing_report": f"{_BFD}, b as (select bin, sum(tokens) as t, count(*) as n from pk group by bin) select count(*) as bins, sum(n)::bigint as samples, round(100.0 * sum(t) / (count(*) * 4096), 6) as use, ceil(sum(t) / 4096.0::double)::bigint as least, round(100.0 * ceil(sum(t) / 4096.0::double) / count(*), 6) as efficiency from b",
    "K8_greedy_knapsack": _SACK,
    "T7_chunk_offsets": f"select doc_id, n_valid, coalesce(sum(n_valid) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as \"offset\", row_number() over (order by doc_id) - 1 < floor(0.9::double * count(*) over ())::bigint as train from {_VALID}",
    "W4_shuffle_index": f"select row_number() over (order by md5('7:' || sample), sample) - 1 as i, sample as id from (select unnest(range(0, (sum({_N} + 1)::bigint - 1) // 256 + 1)) as sample from documents)",
    "W15_sample_chunks": f"select sample * 4 + k as chunk, sample from (select unnest(range(0, (sum({_N} + 1)::bigint - 1) // 256 + 1)) as sample from documents), (select unnest(range(0, 4)) as k)",
    "T2_encode_documents": f"select doc_id, array_to_string({_LENS}, ',') as lens, coalesce(list_sum({_LENS}), 0)::int as n_tokens from (select doc_id, {_SENT} as n from documents)",
    "T5_fixed_chunks": f"select doc_id, (start // 64)::int as chunk, start::int as start, least(start + 64, len(w))::int as stop from {_CHUNKS}",
    "T6_chunk_validity": f"select doc_id, count(*) filter (len(list_filter({_PAD}, lambda t: regexp_full_match(t, '\\p{{L}}+'))) > 0) as n_valid, count(*) filter (len(list_filter({_PAD}, lambda t: regexp_full_match(t, '\\p{{L}}+'))) = 0) as n_invalid from {_CHUNKS} group by doc_id",
    "T8_padded_chunks": f"select doc_id, (start // 64)::int as chunk, md5(array_to_string({_PAD}, ' ')) as tokens from {_CHUNKS}",
    "W1_epochs": f"select sum({_N})::bigint as tokens, ceil((100000 * 128 + 1) / sum({_N})::double)::bigint as epochs from documents",
    "W2_document_index": "select row_number() over (order by md5('1234:' || doc_id), doc_id) - 1 as i, doc_id as id from documents",
    "W3_sample_index": f"with st as materialized {_STREAM}, k as (select unnest(range(0, ((select sum(len) from st) - 1)::bigint // 256 + 1)) as sample) select sample, pos, sample * 256 - start as \"offset\" from k join st on sample * 256 >= start and sample * 256 < start + len",
    "W5_sample_spans": f"with st as materialized {_STREAM}, k as (select unnest(range(0, ((select sum(len) from st) - 1)::bigint // 256)) as sample) select sample, pos, greatest(sample * 256 - start, 0) as \"from\", least(sample * 256 + 257 - start, len) as \"to\" from k join st on sample * 256 + 257 > start and sample * 256 < start + len",
    "W6_labels_and_positions": f"""with c as (select conv_id, turn, list_append({_WS}, '<eod>') as w from conversations), g as (select conv_id as key, flatten(list(w order by turn, w)) as w from c group by conv_id),
t as (select key, unnest(range(0, len(w)))::int as i, unnest(w) as token from g)
select key, i, token, lead(token) over p as label, (token <> '<eod>')::int as loss_mask, (i - coalesce(max(case when token = '<eod>' then i + 1 end) over (partition by key order by i rows between unbounded preceding and 1 preceding), 0))::int as position from t window p as (partition by key order by i)""",
    "W13_evaluation_windows": f"select doc_id as id, k::int as k, (k * 32)::int as start, case when k = 0 then 0 else 224 end as scored_from from (select doc_id, unnest(range(0, ceil(greatest({_N} - 256, 0) / 32.0)::bigint + 1)) as k from documents)",
    "W14_last_word_cloze": r"select doc_id, md5(array_to_string(w[1:len(w) - 1], ' ')) as context, w[len(w)] as label from (select doc_id, string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') as w from documents)",
    "B2_normalized_weights": f"select source, round(count(*) / {_COUNT}, 9) as weight from documents group by source",
    "B3_greedy_blend": _GREEDY.replace("CAP", "1e9"),
    "B4_exhaustive_blend": _GREEDY.replace("CAP", "n[k+1]"),
    "B6_range_split": f"select doc_id, {_SPLIT.format(a='0.969', b='0.999')} as split from {_ORD}",
    "B7_requested_sizes": "select source, ceil(ceil(1000.0 * (count(*) / 997.0)) * 1.005)::bigint as asked from documents group by source",
    "B8_interleave": f"with a as ({_INTER}) select * from a where place // 2 < (select min(c) from (select count(*) as c from {_THIRD} group by dataset))",
    "B8_interleave_all": _INTER,
    "B9_take_and_skip": f"select {_SPLIT.format(a='0.9', b='1.0')} as split, min(doc_id) as least, max(doc_id) as most, count(*) as n from {_ORD} group by 1",
    "B11_sequential_sampler": f"select doc_id, (ord - 16) // 8 as batch, (ord - 16) % 8 // 4 as rank, (ord - 16) % 4 as place from {_ORD} where ord >= 16 and ord - 16 < ({_COUNT} - 16) // 8 * 8",
    "B13_length_pools": f"select doc_id, ord // 64 as pool from {_ORD}",
    "B15_length_order": f"select doc_id as id, {_N}::bigint as tokens from documents",
    "IO14_round_robin": f"select doc_id, ord % 7 as robin, ord // 150 as run from {_ORD}",
    "K1_token_info": "select 'doc' || (doc_id % 500) as name, arg_max(length(text), doc_id)::bigint as tokens from documents group by 1",
    "K2_length_summary": f"select count(*) as n, sum({_N})::bigint as total, round(avg({_N}), 6) as mean, min({_N})::bigint as least, max({_N})::bigint as most from documents",
    "K2_length_ranges": f"with e as (select unnest({_EDGES[:-1]}) as low, unnest({_EDGES[1:]}) as high) select low, high, count(*) filter (t > low and t <= high) as n from e, (select {_N} as t from documents) group by low, high",
    "K12_padding": f"select doc_id, md5(array_to_string(list_concat(w, {_FILL}), ' ')) as right, md5(array_to_string(list_concat({_FILL}, w), ' ')) as left from {_CUT}",
}
