"""Queries of near-duplicate detection and decontamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decontam as C
from ..operators import dedup as D
from ..session import stage, table

W = r"[\p{L}\p{N}_]"


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def neighbours(spark, sf):
    d = docs(spark, sf)
    n = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("next"))
    j = lambda over: F.round(D.similarity(F.col("both"), F.col("na"), F.col("nb"), over), 9).alias(f"by_{over}")
    return D.shingle_overlaps(d.join(n, "doc_id")).select("doc_id", j("union"), j("min"), j("max"))


def _edges(s, d, rounds=1):
    return D.duplicate_edges(docs(s, d), rounds=rounds).select("main", "other", F.round("sim", 9).alias("sim"))


def _groups(s, d):
    return D.duplicate_groups(D.duplicate_edges(docs(s, d)))


def _found(s, d):
    dic = stage(C.ngram_dictionary(table(s, d, "benchmark")), "dictionary")
    return dic, stage(C.matches(docs(s, d), dic), "matches")


def _flags(s, d):
    dic, found = _found(s, d)
    return C.contaminated(found, C.telling(C.document_frequency(dic, found))).select(F.col("id").alias("doc_id"))


def _pieces(s, d):
    dic, found = _found(s, d)
    return C.decontaminated(docs(s, d), found, C.telling(C.document_frequency(dic, found)))


_CH = "select doc_id, unnest(string_split(text, '')) as c, generate_subscripts(string_split(text, ''), 1) as p from documents"
_WIN = f"select doc_id, c || lead(c) over w || lead(c, 2) over w || lead(c, 3) over w || lead(c, 4) over w as x, lead(c, 5) over w as more from ({_CH}) window w as (partition by doc_id order by p)"
_SH = f"(select documents.doc_id, coalesce(any_value(g.s), []) as s from documents left join (select doc_id, list(distinct x) as s from ({_WIN}) where more is not null group by doc_id) g on g.doc_id = documents.doc_id group by documents.doc_id)"
_A, _B = zip(*D.permutations(100))
_SIG = f"""sh as materialized {_SH},
hs as (select distinct doc_id, ('0x' || substr(md5(unnest(s)), 1, 7))::bigint as h from sh),
pm as (select unnest(range(0, 100)) as k, unnest({list(_A)}) as a, unnest({list(_B)}) as b),
mh as materialized (select doc_id, k, min((a * h + b) % {D.PRIME}) as v from hs, pm group by all),
bk as materialized (select doc_id, (k // 10)::int as band, md5(string_agg(v::varchar, ',' order by k)) as bucket from mh group by doc_id, k // 10)"""
_STAR = f"""{_SIG}, mn as (select band, bucket, min(doc_id) as main from bk group by all having count(*) > 1),
pr as materialized (select distinct main, doc_id as other from bk join mn using (band, bucket) where doc_id <> main),
sm as materialized (select main, other, len(list_intersect(a.s, b.s)) as i, len(a.s) as x, len(b.s) as y from pr join sh a on a.doc_id = main join sh b on b.doc_id = other),
ed as materialized (select main, other, i / (x + y - i) as sim from sm where i / (x + y - i) > 0.5)"""
_CC = f"""with recursive {_STAR}, e2 as (select main as a, other as b from ed where sim >= 0.7 union select other, main from ed where sim >= 0.7),
walk as (select distinct a as id, a as node from e2 union select id, b from walk join e2 on node = a)"""
_DIC = f"""ws as (select regexp_extract_all(lower(text), '{W}+') as w from benchmark),
dic as materialized (select distinct g as ngram from (select unnest(case when len(w) < 8 then [] when len(w) < 13 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i+12], ' ')) end) as g from ws))"""
_MATCH = f"""{_DIC}, sz as (select distinct len(string_split(ngram, ' ')) as n from dic), dw as (select doc_id, regexp_extract_all(lower(text), '{W}+') as w from documents),
dg as (select doc_id, unnest(list_transform(range(1, greatest(len(w) - n + 2, 1)), lambda i: array_to_string(w[i:i+n-1], ' '))) as ngram from dw, sz where len(w) >= 13),
hit as materialized (select distinct doc_id, ngram from dg join dic using (ngram)), fr as (select ngram, count(doc_id) as df from dic left join hit using (ngram) group by ngram)"""

QUERIES = {
    "D1_char_shingles": lambda s, d: D.shingle_sizes(docs(s, d)).select(F.col("id").alias("doc_id"), "n", "least"),
    "D2_jaccard": neighbours,
    "D3_minhash_signatures": lambda s, d: D.signatures(docs(s, d)).select(F.col("id").alias("doc_id"), F.md5(F.array_join(F.transform("sig", lambda x: x.cast("string")), ",")).alias("sig")),
    "D4_lsh_buckets": lambda s, d: D.buckets(D.signatures(docs(s, d))).select(F.col("id").alias("doc_id"), "band", "bucket"),
    "D5_star_verification": _edges,
    "D6_star_until_done": lambda s, d: _edges(s, d, -1),
    "D7_incremental_buckets": lambda s, d: D.buckets(stage(D.signatures(docs(s, d).where("doc_id % 2 = 0"))).union(D.signatures(docs(s, d).where("doc_id % 2 = 1")))).select(F.col("id").alias("doc_id"), "band", "bucket"),
    "D9_duplicate_groups": lambda s, d: _groups(s, d).select(F.col("id").alias("doc_id"), "component"),
    "D10_group_removal": lambda s, d: D.without_duplicates(docs(s, d), _groups(s, d)).select("doc_id"),
    "C2_ngram_dictionary": lambda s, d: C.ngram_dictionary(table(s, d, "benchmark")),
    "C4_length_histogram": lambda s, d: C.length_histogram(C.ngram_dictionary(table(s, d, "benchmark"))),
    "C5_document_frequency": lambda s, d: C.document_frequency(*_found(s, d)),
    "C6_frequency_threshold": lambda s, d: C.telling(C.document_frequency(*_found(s, d))),
    "C7_contaminated_documents": _flags,
    "C8_split_and_trim": lambda s, d: _pieces(s, d).select(F.col("id").alias("doc_id"), "piece", F.md5("text").alias("text"), "status"),
    "C9_split_ids": lambda s, d: C.split_ids(_pieces(s, d).where("text is not null")).select("split_id", F.length("text").alias("n")),
    "C10_counters": lambda s, d: _pieces(s, d).where("piece = 0").groupBy("status").agg(F.count(F.lit(1)).alias("n")),
}

ORACLES = {
    "D1_char_shingles": f"select doc_id, len(s)::int as n, list_min(s) as least from {_SH}",
    "D2_jaccard": f"""with sh as materialized {_SH}, p as (select a.doc_id, len(list_intersect(a.s, b.s)) as i, len(a.s) as x, len(b.s) as y from sh a join sh b on b.doc_id = a.doc_id + 1)
select doc_id, case when x = 0 or y = 0 then 0.0 else round(i / (x + y - i), 9) end as by_union, case when x = 0 or y = 0 then 0.0 else round(i / least(x, y), 9) end as by_min, case when x = 0 or y = 0 then 0.0 else round(i / greatest(x, y), 9) end as by_max from p""",
    "D3_minhash_signatures": f"with {_SIG} select doc_id, md5(string_agg(v::varchar, ',' order by k)) as sig from mh group by doc_id",
    "D4_lsh_buckets": f"with {_SIG} select doc_id, band, bucket from bk",
    "D7_incremental_buckets": f"with {_SIG} select doc_id, band, bucket from bk",
    "D5_star_verification": f"with {_STAR} select main, other, round(sim, 9) as sim from ed",
    "D9_duplicate_groups": f"{_CC} select id as doc_id, min(node) as component from walk group by id",
    "D10_group_removal": f"{_CC} select doc_id from documents where doc_id not in (select id from walk group by id having min(node) < id)",
    "C2_ngram_dictionary": f"with {_DIC} select ngram, len(string_split(ngram, ' '))::int as size from dic",
    "C4_length_histogram": f"with {_DIC} select len(string_split(ngram, ' '))::int as size, count(*) as n from dic group by 1",
    "C5_document_frequency": f"with {_MATCH} select ngram, df from fr",
    "C6_frequency_threshold": f"with {_MATCH} select ngram, df from fr where df < 10",
    "C7_contaminated_documents": f"with {_MATCH} select distinct doc_id from hit join fr using (ngram) where df < 10",
}
