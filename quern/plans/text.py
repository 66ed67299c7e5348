"""Queries of the text and url families."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U
from ..operators import cleaning as C
from ..session import table

W = r"[\p{L}\p{N}_]"
_NAMES = ", ".join(f"'{x}'" for x in sorted(U.BLOCKED_NAMES))
_BLOCKED = f"regexp_extract(lower(regexp_extract(url, '{U.HOST}', 1)), '{U.REGISTERED}', 1)"
_EXT = f"regexp_matches(lower(split_part(url, '?', 1)), '{U.ending_pattern()}')"
_GOOD = f"regexp_matches(url, '{U.WELL_FORMED}')"
_REASON = f"case when {_BLOCKED} in ({_NAMES}) then 'domain' when {_EXT} then 'extension' when length(url) <= 8 then 'short' when not {_GOOD} then 'malformed' else 'keep' end"
_URLS = f"""with a as (select page_id as id, url, {_REASON} as r from pages),
b as (select *, row_number() over (partition by url, r order by id) as k from a)
select id, url, case when r = 'keep' and k > 1 then 'duplicate' else r end as reason from b"""


def docs(spark, sf):
    return table(spark, sf, "documents")


def pages(spark, sf):
    return table(spark, sf, "pages")


def _x(text: str, *pairs, fn="replace") -> str:
    for a, b in pairs:
        a, b = a.replace("'", "''"), b.replace("'", "''")
        text = f"replace({text}, '{a}', '{b}')" if fn == "replace" else f"regexp_replace({text}, '{a}', '{b}', 'g')"
    return text.replace("\n", "' || chr(10) || '") if fn == "replace" else text


_PTB = _x("text", (" '", "'"), (" \n", "\n"), ("\n ", "\n"), (" n't", "n't"), (" N ", "1 "), ("$ 1", "$1"), ("# 1", "#1"))
_WIKI = _x("text", ("s '", "s'"))
_WIKI = _x(_WIKI, ("/' [0-9]/", "/'[0-9]/"), fn="re")
_WIKI = _x(_WIKI, *[(f" @{x}@ ", x) for x in "-,."], *[(f" {x} ", f"{x} ") for x in ":;.!?,"])
_WIKI = _x(_WIKI, *[(rf"\{a}\s*([^\{b}]*?)\s*\{b}", rf"{a}\1{b}") for a, b in ("()", "[]", "{}", '""', "''")], fn="re")
_WIKI = _x(_WIKI, ("= = = =", "===="), ("= = =", "==="), ("= =", "=="), (" ° ", "°"), (" \n", "\n"), ("\n ", "\n"), (" N ", " 1 "), (" 's", "'s"))
_NORM = r"array_to_string(list_filter(string_split_regex(regexp_replace(lower({}), '[!-/:-@\[-`{{-~]', '{}', 'g'), '\s+'), lambda w: w not in ('', 'a', 'an', 'the')), ' ')"
_WORDS = f"regexp_extract_all(lower(text), '{W}+')"
_CAPTION = f"""select doc_id, not (starts_with(lower(text), 'i cannot') or starts_with(lower(text), 'i can''t') or starts_with(lower(text), 'i''m sorry') or starts_with(lower(text), 'i am sorry'))
and not coalesce(len(list_filter(range(1, len(w) - 6), lambda i: len(list_distinct(w[i:i+7])) = 1)) > 0, false) and length(text) between 50 and 3500 as ok from (select *, {_WORDS} as w from documents)"""
_TASK = """case when length(text) < 512 then 'remove_512' when length(text) < 256 and contains(lower(text), 'javascript') then 'remove_256_javascript' when length(text) < 512 and lang <> 'en' then 'remove_512_non_english' end"""
_SMALL = f"(length(text) < 1024 and len({_WORDS}) < 128)"

QUERIES = {
    "F1_domain_blocklist": lambda s, d: pages(s, d).select("page_id", U.registered_name(F.col("url")).alias("name"), U.domain_blocked(F.col("url")).alias("blocked")),
    "F2_extension_blocklist": lambda s, d: pages(s, d).select("page_id", U.extension_blocked(F.col("url")).alias("blocked")),
    "F3_short_url": lambda s, d: pages(s, d).select("page_id", U.too_short(F.col("url")).alias("short")),
    "F4_malformed_url": lambda s, d: pages(s, d).select("page_id", U.malformed(F.col("url")).alias("malformed")),
    "F5_url_cascade": lambda s, d: C.url_reasons(pages(s, d)),
    "A1_url_reason_counts": lambda s, d: C.url_reasons(pages(s, d)).groupBy("reason").agg(F.count(F.lit(1)).alias("n")),
    "F7_language_filter": lambda s, d: docs(s, d).where("lang = 'en'").select("doc_id", "lang"),
    "F8_min_tokens": lambda s, d: docs(s, d).select("doc_id", C.min_token_ok(F.col("text")).alias("ok")),
    "F9_cleanup_counters": lambda s, d: C.counted(docs(s, d).withColumn("reason", C.cleanup_reason(F.col("text"), F.col("lang")))),
    "F10_remove_512": lambda s, d: docs(s, d).where(F.length("text") >= 512).select("doc_id"),
    "F11_remove_256_javascript": lambda s, d: C.task_outcomes(docs(s, d), ["remove_256_javascript"]).where("not filtered").select("doc_id"),
    "F12_remove_512_non_english": lambda s, d: C.task_outcomes(docs(s, d), ["remove_512_non_english"]).where("not filtered").select("doc_id"),
    "F13_general_cleaning": lambda s, d: docs(s, d).select("doc_id", F.md5(T.general_cleaning(F.col("text"))).alias("cleaned")),
    "F14_task_cascade": lambda s, d: C.task_outcomes(docs(s, d)).select("doc_id", "task", "filtered", F.length("cleaned").alias("n_cleaned")),
    "A1_task_counts": lambda s, d: C.task_outcomes(docs(s, d)).groupBy(F.coalesce("task", F.lit("pass")).alias("task")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars")),
    "F15_add_id": lambda s, d: C.with_ids(docs(s, d).select("doc_id"), "web", ["doc_id"]),
    "F16_caption_filter": lambda s, d: docs(s, d).select("doc_id", T.caption_ok(F.col("text")).alias("ok")),
    "F18_least_toxic_half": lambda s, d: C.least_half(table(s, d, "labels").select("doc_id", "toxic"), "toxic", "doc_id"),
    "F18_toxicity_summary": lambda s, d: C.score_summary(table(s, d, "labels"), "toxic"),
    "F19_annotation_text": lambda s, d: docs(s, d).select("doc_id", F.md5(T.detox_text(F.col("text"))).alias("prepared")),
    "F24_length_gate": lambda s, d: docs(s, d).agg(F.count_if(F.size(T.words(F.col("text"))) <= 512).alias("n_kept"), F.count_if(F.size(T.words(F.col("text"))) > 512).alias("n_filtered")),
    "F25_discard_long": lambda s, d: docs(s, d).where(F.size(T.words(F.col("text"))) <= 1024).select("doc_id"),
    "P1_ptb_detokenizer": lambda s, d: docs(s, d).select("doc_id", F.md5(T.ptb_detokenized(F.col("text"))).alias("t")),
    "P1_wikitext_detokenizer": lambda s, d: docs(s, d).select("doc_id", F.md5(T.wikitext_detokenized(F.col("text"))).alias("t")),
    "P2_task_clean": lambda s, d: docs(s, d).select("doc_id", F.md5(T.task_clean(F.col("text"))).alias("t")),
    "P3_normalize_answer": lambda s, d: docs(s, d).select("doc_id", F.md5(T.normalized_answer(F.col("text"))).alias("spaced"), F.md5(T.normalized_answer(F.col("text"), "")).alias("closed")),
    "P12_sentence_end": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", T.sentence_ended(F.col("text")).alias("text")),
    "C1_words": lambda s, d: docs(s, d).select("doc_id", F.size(T.words(F.col("text"))).alias("n"), F.md5(F.array_join(T.words(F.col("text")), " ")).alias("w")),
    "X10_retrieval_tokens": lambda s, d: docs(s, d).select("doc_id", F.md5(F.array_join(T.retrieval_tokens(F.col("text")), " ")).alias("w")),
    "X11_question_normalize": lambda s, d: table(s, d, "conversations").select("conv_id", "turn", T.trailing_question_mark_dropped(F.col("text")).alias("text")),
    "D11_exact_url_dedup": lambda s, d: C.first_of_each(pages(s, d), "url", "page_id").where("first").select("page_id", "url"),
}

ORACLES = {
    "F1_domain_blocklist": f"select page_id, {_BLOCKED} as name, {_BLOCKED} in ({_NAMES}) as blocked from pages",
    "F2_extension_blocklist": f"select page_id, {_EXT} as blocked from pages",
    "F3_short_url": "select page_id, length(url) <= 8 as short from pages",
    "F4_malformed_url": f"select page_id, not {_GOOD} as malformed from pages",
    "F5_url_cascade": _URLS,
    "A1_url_reason_counts": f"select reason, count(*) as n from ({_URLS}) group by reason",
    "F7_language_filter": "select doc_id, lang from documents where lang = 'en'",
    "F8_min_tokens": f"select doc_id, not {_SMALL} as ok from documents",
    "F9_cleanup_counters": f"select case when lang <> 'en' then 'other_language' when {_SMALL} then 'small' else 'keep' end as reason, count(*) as n_docs, sum(length(text))::bigint as n_chars from documents group by 1",
    "F10_remove_512": "select doc_id from documents where length(text) >= 512",
    "F11_remove_256_javascript": "select doc_id from documents where not (length(text) < 256 and contains(lower(text), 'javascript'))",
    "F12_remove_512_non_english": "select doc_id from documents where not (length(text) < 512 and lang <> 'en')",
    "F13_general_cleaning": f"select doc_id, md5(regexp_replace(text, '({W})\\n+ ?|  +', '\\1 ', 'g')) as cleaned from documents",
    "F14_task_cascade": f"select doc_id, {_TASK} as task, {_TASK} is not null as filtered, case when {_TASK} is null then length(text)::int end as n_cleaned from documents",
    "A1_task_counts": f"select coalesce({_TASK}, 'pass') as task, count(*) as n, sum(length(text))::bigint as n_chars from documents group by 1",
    "F15_add_id": "select doc_id, printf('web-%010d', row_number() over (order by doc_id)) as adlr_id from documents",
    "F16_caption_filter": _CAPTION,
    "F18_least_toxic_half": "select doc_id, toxic from labels where toxic is not null order by toxic, doc_id limit (select (count(toxic) // 2)::bigint from labels)",
    "F18_toxicity_summary": "select count(toxic) as n, round(avg(toxic::double), 9) as mean, round(stddev_pop(toxic::double), 9) as std, sum(case when toxic >= 0.5 then 1 else 0 end)::bigint as n_over from labels where toxic is not null",
    "F19_annotation_text": """with t as (select doc_id, trim(replace(text, '<|endoftext|>', '')) as t from documents), b as (select *, encode(t) as b from t)
select doc_id, case when length(t) > 0 then md5(case when octet_length(b) <= 20480 then t else coalesce(try(decode(b[1:20480])), try(decode(b[1:20479])), try(decode(b[1:20478])), try(decode(b[1:20477]))) end) end as prepared from b""",
    "F24_length_gate": f"select count(*) filter (len({_WORDS}) <= 512) as n_kept, count(*) filter (len({_WORDS}) > 512) as n_filtered from documents",
    "F25_discard_long": f"select doc_id from documents where len({_WORDS}) <= 1024",
    "P1_ptb_detokenizer": f"select doc_id, md5({_PTB}) as t from documents",
    "P1_wikitext_detokenizer": f"select doc_id, md5({_WIKI}) as t from documents",
    "P2_task_clean": r"select doc_id, md5(replace(replace(replace(regexp_replace(replace(text, chr(10), ' '), '\s+', ' ', 'g'), ' . ', '. '), ' . ', '. '), ' . ', '. ')) as t from documents",
    "P3_normalize_answer": f"select doc_id, md5({_NORM.format('text', ' ')}) as spaced, md5({_NORM.format('text', '')}) as closed from documents",
    "P12_sentence_end": "select conv_id, turn, case when regexp_matches(text, '[?.!]$') then text else text || '.' end as text from conversations",
    "C1_words": f"select doc_id, len({_WORDS})::int as n, md5(array_to_string({_WORDS}, ' ')) as w from documents",
    "X10_retrieval_tokens": r"select doc_id, md5(array_to_string(regexp_extract_all(text, '[\p{M}\p{N}\p{L}]+|[^\p{C}\p{Z}]'), ' ')) as w from documents",
    "X11_question_normalize": r"select conv_id, turn, regexp_replace(text, '\?$', '') as text from conversations",
    "D11_exact_url_dedup": "select min(page_id) as page_id, url from pages group by url",
}
