"""Queries of media samples and what the other modules leave: joins, samplers, metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import words
from ..operators import blend as B
from ..operators import chat as C
from ..operators import media as M
from ..operators import metrics as A
from ..operators import packing as K
from ..operators import timebucket as S
from ..operators import vector as V
from ..operators import windows as X
from ..operators.ordinal import running
from ..session import table

W = r"[\p{L}\p{N}_]"


def docs(s, d):
    return table(s, d, "documents")


def samples(s, d):
    """Documents as samples with images named after ids; a listing lacks every seventh."""
    ids = F.transform(F.sequence(F.lit(0), (F.col("doc_id") % 4).cast("int")), lambda i: F.concat(F.lit("img/"), (F.col("doc_id") + i).cast("string"), F.lit(".jpg")))
    return docs(s, d).select("doc_id", ids.alias("images"))


def listing(s, d):
    return docs(s, d).where("doc_id % 7 <> 0").select(F.concat(F.lit("img/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("path"))


def _models(s, d):
    lab = table(s, d, "labels").join(docs(s, d).select("doc_id", "n_chars"), "doc_id")
    two = F.array(F.struct(F.lit(0).alias("cls"), (F.col("n_chars") % 97 / 97.0).alias("score")), F.struct(F.lit(1).alias("cls"), (F.col("n_chars") % 89 / 89.0).alias("score")), F.struct(F.lit(1).alias("cls"), (F.col("doc_id") % 83 / 83.0).alias("score")), F.struct(F.lit(0).alias("cls"), (F.col("doc_id") % 79 / 79.0).alias("score")))
    return lab.select(F.col("doc_id").alias("uid"), "quality", F.inline(two))


def _materialized(s, d):
    t = docs(s, d).select(F.col("doc_id").alias("id"), F.transform(words(F.col("text")), lambda w: F.length(w)).alias("ids")).where("size(ids) between 1 and 2048")
    return K.materialized(K.packed(t.select("id", F.size("ids").alias("tokens")), 2048, 10, "bfd"), t)


def _neigh(s, d):
    e = table(s, d, "embeddings")
    return V.top_inner_products(e.where("vec_id % 50 = 0"), e, 20)


def _batches(s, d):
    """Queries and the item of each, the next vector, in batches of 32."""
    e = table(s, d, "embeddings")
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("v"))
    return e.join(after, "vec_id").select(F.expr("vec_id div 32").alias("batch"), F.col("vec_id").alias("q"), F.col("embedding").alias("qv"), "v")


def _dialogues(s, d):
    """Answers as knowledge, the turns before as context; the topic is the answer's second word."""
    g = C.gathered(table(s, d, "conversations")).select(F.col("conv_id").alias("id"), "m", F.posexplode("m").alias("i", "x")).where("x.role = 'assistant' and i > 0")
    return g.select("id", F.split("x.content", " ")[1].alias("topic"), F.transform(F.slice("m", F.lit(1), F.col("i")), lambda t: t["content"]).alias("context"), F.col("x.content").alias("knowledge"), F.col("x.content").alias("response"))


def _preferences(s, d):
    """The next conversation's answer is the one rejected."""
    g = C.gathered(table(s, d, "conversations")).select("conv_id", *[x.alias(n) for x, n in zip(C.first_pair(F.col("m")), ("prompt", "chosen"))])
    g = g.join(g.select((F.col("conv_id") - 1).alias("conv_id"), F.col("chosen").alias("rejected")), "conv_id")
    return g.select("conv_id", *[F.md5(x).alias(n) for x, n in zip(C.preference_row(F.col("prompt"), F.col("chosen"), F.col("rejected")), ("prompt", "chosen", "rejected"))])


_IMG = "(select doc_id, unnest(list_transform(range(0, doc_id % 4 + 1), lambda i: 'img/' || (doc_id + i) || '.jpg')) as image from documents)"
_LIST = "(select 'img/' || doc_id || '.jpg' from documents where doc_id % 7 <> 0)"
_MISS = f"select doc_id, image from {_IMG} where image not in {_LIST}"
_M = "(select conv_id, list({'turn': turn, 'role': role, 'content': text} order by turn, role, text) as m from conversations group by conv_id)"
_CLEAN = "array_to_string(list_filter(string_split(regexp_replace(x.content, '<image>|<video>', '', 'g'), chr(10)), lambda y: trim(y) <> ''), chr(10))"

QUERIES = {
    "F20_missing_media": lambda s, d: M.missing_media(samples(s, d), listing(s, d), "doc_id", "images"),
    "F21_sampled_media": lambda s, d: M.sampled(samples(s, d).select("doc_id"), "doc_id", 100, 42),
    "F22_intact_samples": lambda s, d: M.intact(samples(s, d), listing(s, d), "doc_id", "images").select("doc_id"),
    "F23_consistent_samples": lambda s, d: samples(s, d).select("doc_id", M.consistent(F.col("images"), count=F.lit(3)).alias("ok")),
    "P4_quantized_boxes": lambda s, d: docs(s, d).select("doc_id", F.array_join(F.transform(M.boxes(F.format_string("[0.%03d, .25, 1.0, 0] and [0.5, 0.%03d, 0.1, 0.9]", F.col("doc_id") % 1000, F.col("n_chars") % 1000)), lambda x: x.cast("string")), ",").alias("b")),
    "P5_source_tag": lambda s, d: docs(s, d).select("doc_id", M.source_tag(F.concat(F.lit("/data/images/"), F.col("source"), F.lit("/a.jpg"))).alias("tag"), M.source_tag(F.concat(F.lit("/data/x/"), F.col("source"))).alias("none")),
    "P6_content_id": lambda s, d: docs(s, d).select("doc_id", F.sha1(F.concat(F.lit("{\"m\":\""), F.col("lang"), F.lit("\"}"))).alias("id")),
    "P7_unique_names": lambda s, d: M.unique_names(docs(s, d).select("doc_id", F.concat("source", F.lit(".txt")).alias("name")), "name", "doc_id"),
    "P8_path_resolution": lambda s, d: docs(s, d).select("doc_id", M.resolved_path(F.when(F.col("doc_id") % 5 == 0, "/abs/a").otherwise("a"), F.when(F.col("doc_id") % 3 == 0, F.lit("rel")), F.when(F.col("doc_id") % 2 == 0, F.lit("root")), F.lit("json")).alias("path")),
    "P9_marks_first": lambda s, d: C.gathered(table(s, d, "conversations")).select("conv_id", F.md5(F.array_join(F.transform(M.marks_first(F.col("m"), (F.col("conv_id") % 3).cast("int")), lambda x: F.concat(x["role"], F.lit(":"), x["content"])), "|")).alias("m")),
    "P10_video_as_images": lambda s, d: docs(s, d).select("doc_id", M.video_as_images(F.concat(F.lit("<video>"), F.col("lang")), (F.col("doc_id") % 3).cast("int"), (F.col("doc_id") % 2).cast("int")).alias("t")),
    "IO8_image_folder": lambda s, d: M.first_fraction(docs(s, d).select(F.col("source").alias("cls"), F.col("doc_id").alias("path")), "cls", "path", 0.4),
    "X12_frame_rows": lambda s, d: M.frame_rows(samples(s, d), "doc_id", "images", 4.0),
    "J1_anti_join": lambda s, d: docs(s, d).join(table(s, d, "labels").where("quality = 0").select("doc_id"), "doc_id", "left_anti").select("doc_id"),
    "J2_pairing": lambda s, d: docs(s, d).select("doc_id").join(table(s, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi"),
    "J8_topic_split": lambda s, d: docs(s, d).where("doc_id % 5 = 0").select("doc_id", "source").join(docs(s, d).where("doc_id % 5 <> 0 and lang <> 'en'").select("source").distinct().withColumn("seen", F.lit(True)), "source", "left").select("doc_id", F.coalesce("seen", F.lit(False)).alias("seen")),
    "J9_trace_match": lambda s, d: A.relative_difference(table(s, d, "orders").join(table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("b")), "o_orderkey"), ["o_orderpriority"], "o_totalprice", "b"),
    "J10_passage_lookup": lambda s, d: table(s, d, "labels").join(docs(s, d).select("doc_id", "source"), "doc_id").select("doc_id", "source", "quality"),
    "B12_random_sampler": lambda s, d: X.shuffle_index(docs(s, d), "doc_id", 77).select(F.expr("i div 8").alias("batch"), F.expr("i % 8").alias("place"), "id"),
    "B14_packed_interleave": lambda s, d: running(docs(s, d).where("n_chars > 2000").select("doc_id"), ["doc_id"]).withColumn("place", (F.col("ord") * 2).cast("long")).union(running(docs(s, d).where("n_chars <= 2000").select("doc_id"), ["doc_id"]).withColumn("place", (F.col("ord") * 2 + 1).cast("long"))).select("doc_id", "place"),
    "B16_sorted_merge": lambda s, d: docs(s, d).select("doc_id", F.size(words(F.col("text"))).alias("tokens")).where("tokens <= 2000").orderBy("tokens", "doc_id"),
    "K10_materialized_packs": lambda s, d: _materialized(s, d).select("shard", "bin", F.size("input_ids").alias("n"), F.size("cu_lengths").alias("pieces"), "max_length"),
    "K11_load_order": lambda s, d: _materialized(s, d).select("shard", "bin", "load").orderBy("load"),
    "S7_sentinel_splice": lambda s, d: docs(s, d).select("doc_id", F.array_join(S.spliced(F.array("lang", "source"), F.array((F.col("doc_id") % 3).cast("int"), F.lit(2))), ",").alias("s")),
    "S10_rate_spaced": lambda s, d: docs(s, d).select("doc_id", F.size(S.rate_spaced(F.col("doc_id") % 50 + 0.5, 2, 25, F.lit(700))).alias("n")),
    "S11_frame_times": lambda s, d: docs(s, d).select("doc_id", F.array_max(S.frame_times(F.array((F.col("doc_id") % 9).cast("int"), F.lit(3)), 2.0)).alias("last")),
    "S13_patch_grid": lambda s, d: docs(s, d).select("doc_id", F.md5(F.array_join(F.transform(S.patch_grid(F.lit(2), ((F.col("doc_id") % 3 + 1) * 2).cast("int"), ((F.col("doc_id") % 2 + 1) * 2).cast("int")), lambda p: F.concat_ws(".", p["t"].cast("string"), p["h"].cast("string"), p["w"].cast("string"))), " ")).alias("g")),
    "T1_sentence_split": lambda s, d: docs(s, d).select("doc_id", F.size(X.sentences(F.col("text"))).alias("n"), F.md5(F.array_join(X.sentences(F.col("text")), "|")).alias("s")),
    "V2_top_k_reversed": lambda s, d: _neigh(s, d).where("rank <= 10").select("query_id", "vec_id", (11 - F.col("rank")).alias("place")),
    "V3_merged_shards": lambda s, d: V.merged_shards(table(s, d, "embeddings").where("vec_id % 2 = 0"), table(s, d, "embeddings").where("vec_id % 2 = 1")).select("vec_id", "label"),
    "V9_differences": lambda s, d: V.differences(docs(s, d).select("doc_id", "lang"), docs(s, d).select("doc_id", F.when(F.col("doc_id") % 50 == 0, "xx").otherwise(F.col("lang")).alias("lang"))),
    "A6_gold_rank": lambda s, d: A.rank_summary(A.in_batch_ranks(_batches(s, d), V.inner(F.col("qv"), F.col("other"))), 1, 5),
    "A8_all_correct": lambda s, d: A.all_correct(docs(s, d).join(table(s, d, "labels"), "doc_id").select(F.expr("doc_id div 4").alias("sample"), ((F.col("n_chars") >= 500).cast("int") == F.col("quality")).alias("ok")), "sample", "ok"),
    "A10_ensemble": lambda s, d: A.ensemble(_models(s, d), 2).select("uid", "cls", F.round("mean", 9).alias("mean")),
    "VA11_topic_prompts": lambda s, d: C.dialogue_examples(_dialogues(s, d), _dialogues(s, d).where("id % 5 = 0").select("topic")).select("id", "topic", F.md5("instance").alias("instance"), F.md5("dialog").alias("dialog"), "known"),
    "VA12_preference_rows": lambda s, d: _preferences(s, d),
    "X2_legacy_requests": lambda s, d: docs(s, d).groupBy("source").agg(F.count(F.lit(1)).alias("n")).select("source", F.ceil(F.lit(1000.0) * (F.col("n") / 997.0) * 1.005).alias("asked")),
}

ORACLES = {
    "F20_missing_media": _MISS,
    "F21_sampled_media": "select doc_id from documents order by md5('42:' || doc_id), doc_id limit 100",
    "F22_intact_samples": f"select doc_id from documents where doc_id not in (select doc_id from ({_MISS}))",
    "F23_consistent_samples": "select doc_id, doc_id % 4 + 1 = 3 as ok from documents",
    "P4_quantized_boxes": "select doc_id, array_to_string(list_transform(['0.' || lpad((doc_id % 1000)::varchar, 3, '0'), '.25', '1.0', '0', '0.5', '0.' || lpad((n_chars % 1000)::varchar, 3, '0'), '0.1', '0.9'], lambda v: least(greatest(round_even(v::double * 1000, 0), 0), 999)::int), ',') as b from documents",
    "P5_source_tag": "select doc_id, source as tag, '' as none from documents",
    "P6_content_id": "select doc_id, sha1('{\"m\":\"' || lang || '\"}') as id from documents",
    "P7_unique_names": "select doc_id, source || '.txt' as name, case when n = 0 then source || '.txt' else source || '_' || n || '.txt' end as unique_name from (select *, row_number() over (partition by source order by doc_id) - 1 as n from documents)",
    "P8_path_resolution": "select doc_id, case when doc_id % 5 = 0 then '/abs/a' when doc_id % 3 = 0 then 'rel/a' when doc_id % 2 = 0 then 'root/a' else 'json/a' end as path from documents",
    "P9_marks_first": f"select conv_id, md5(array_to_string(list_transform(m, lambda x, i: x.role || ':' || case when i = list_position(list_transform(m, lambda z: z.role), 'user') then repeat('<image>' || chr(10), (conv_id % 3)::int) else '' end || {_CLEAN}), '|')) as m from {_M}",
    "P10_video_as_images": "select doc_id, case when doc_id % 3 > 0 and doc_id % 2 = 0 then repeat('<image>', (doc_id % 3)::int) || lang else '<video>' || lang end as t from documents",
    "IO8_image_folder": "select source as cls, doc_id as path, (dense_rank() over (order by source) - 1)::int as class_index from documents qualify row_number() over (partition by source order by doc_id) <= floor(count(*) over (partition by source) * 0.4::double)",
    "X12_frame_rows": "select doc_id, i::int as i, round_even(i / 4.0, 1)::double as at, printf('<%.1f s>', round_even(i / 4.0, 1)::double) as label from (select doc_id, unnest(range(0, doc_id % 4 + 1)) as i from documents)",
    "J1_anti_join": "select doc_id from documents where doc_id not in (select doc_id from labels where quality = 0)",
    "J2_pairing": "select doc_id from documents where doc_id in (select doc_id from labels)",
    "J8_topic_split": "select doc_id, source in (select source from documents where doc_id % 5 <> 0 and lang <> 'en') as seen from documents where doc_id % 5 = 0",
    "J9_trace_match": "select o_orderpriority, round(sum(abs(o_totalprice - b)) / sum(abs(o_totalprice)), 3) as difference from orders join (select l_orderkey, sum(l_extendedprice) as b from lineitem group by 1) on l_orderkey = o_orderkey group by 1",
    "J10_passage_lookup": "select doc_id, source, quality from labels join documents using (doc_id)",
    "B12_random_sampler": "select (r // 8)::bigint as batch, (r % 8)::bigint as place, doc_id as id from (select doc_id, row_number() over (order by md5('77:' || doc_id), doc_id) - 1 as r from documents)",
    "B14_packed_interleave": "select doc_id, ((row_number() over (partition by n_chars > 2000 order by doc_id) - 1) * 2 + case when n_chars > 2000 then 0 else 1 end)::bigint as place from documents",
    "B16_sorted_merge": f"select doc_id, len(regexp_extract_all(lower(text), '{W}+'))::int as tokens from documents where len(regexp_extract_all(lower(text), '{W}+')) <= 2000",
    "S7_sentinel_splice": "select doc_id, array_to_string(list_concat(list_transform(range(0, doc_id % 3), lambda i: lang), [source, source]), ',') as s from documents",
    "S11_frame_times": "select doc_id, greatest(doc_id % 9, 3) / 2.0::double as last from documents",
    "T1_sentence_split": "select doc_id, len(regexp_extract_all(text, '[^.!?]+[.!?]*'))::int as n, md5(array_to_string(regexp_extract_all(text, '[^.!?]+[.!?]*'), '|')) as s from documents",
    "V3_merged_shards": "select vec_id, label from embeddings",
    "V9_differences": "select doc_id, lang, 'a' as side from documents where doc_id % 50 = 0 union all select doc_id, 'xx' as lang, 'b' as side from documents where doc_id % 50 = 0",
    "A6_gold_rank": """with p as (select a.vec_id // 32 as batch, a.vec_id as q, a.embedding as qv, b.embedding as v from embeddings a join embeddings b on b.vec_id = a.vec_id + 1),
s as (select a.batch, a.q, b.q as item, list_sum(list_transform(range(1, len(a.qv) + 1), lambda i: a.qv[i]::double * b.v[i]::double)) as s from p a join p b using (batch)),
r as (select q, (select count(*) from s x where x.batch = s.batch and x.q = s.q and (x.s > s.s or (x.s = s.s and x.item < s.item))) + 1 as rank from s where q = item)
select round(avg(rank), 9) as mean_rank, round(avg((rank <= 1)::int), 9) as top1, round(avg((rank <= 5)::int), 9) as top5 from r""",
    "A8_all_correct": "select doc_id // 4 as sample, bool_and((n_chars >= 500)::int = quality) as all_correct from documents join labels using (doc_id) group by 1",
    "A10_ensemble": """with m as (select doc_id as uid, (n_chars % 97 / 97.0::double + doc_id % 79 / 79.0::double) / 2 as a, (n_chars % 89 / 89.0::double + doc_id % 83 / 83.0::double) / 2 as b from labels join documents using (doc_id))
select uid, case when b > a then 1 else 0 end as cls, round(greatest(a, b), 9) as mean from m""",
    "VA11_topic_prompts": """with o as (select conv_id as id, turn, role, text, row_number() over (partition by conv_id order by turn, role, text) as k, list(text) over (partition by conv_id order by turn, role, text rows between unbounded preceding and 1 preceding) as c from conversations),
d as (select id, k, string_split(text, ' ')[2] as topic, c[greatest(len(c) - 2, 1):] as last, text as knowledge from o where k > 1 and role = 'assistant'),
t as (select distinct topic from d where id % 5 = 0),
g as (select *, topic in (select topic from t) as known from d where topic is not null and knowledge <> 'no_passages_used' and not regexp_matches(knowledge, '[()]') and contains(knowledge, topic))
select id, topic, md5('( ' || last[len(last)] || ' ) ' || topic || ' => ' || knowledge) as instance, md5('( ' || topic || ' ) ' || array_to_string(last, ' ')) as dialog, known from g
where known or (len(list_filter(string_split_regex(trim(knowledge), '\\s+'), lambda w: w <> '')) <= 20 and not regexp_matches(knowledge, '^([Ii]t|[Tt]his)'))""",
    "VA12_preference_rows": f"""with g as (select conv_id, list_filter(m, lambda x: x.role = 'user')[1].content as p, list_filter(m, lambda x: x.role = 'assistant')[1].content as c from {_M})
select a.conv_id, md5('<|im_start|>user' || chr(10) || a.p || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10)) as prompt, md5(a.c || '<|im_end|>' || chr(10)) as chosen, md5(b.c || '<|im_end|>' || chr(10)) as rejected from g a join g b on b.conv_id = a.conv_id + 1""",
    "V2_top_k_reversed": """with n as (select a.vec_id as query_id, b.vec_id, list_sum(list_transform(range(1, len(a.embedding) + 1), lambda i: a.embedding[i]::double * b.embedding[i]::double)) as s from embeddings a, embeddings b where a.vec_id % 50 = 0)
select query_id, vec_id, (11 - row_number() over (partition by query_id order by s desc, vec_id))::int as place from n qualify row_number() over (partition by query_id order by s desc, vec_id) <= 10""",
    "S10_rate_spaced": "select doc_id, len(list_distinct(list_transform(range(0, greatest(floor((doc_id % 50 + 0.5::double) * 2)::bigint, 1)), lambda i: least(i * 25 // 2, 699))))::int as n from documents",
    "X2_legacy_requests": "select source, ceil(1000.0 * (count(*) / 997.0::double) * 1.005::double)::bigint as asked from documents group by source",
}
