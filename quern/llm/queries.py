"""The registered queries of this subpackage: op1 .. op10 and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import ann_forest, chat_collapse, license_scan, line_dedup, minhash_dedup, packing, quality_crf, quality_rules, source_mix, token_counts

NOT_HELD_OUT = "pmod(crc32(cast(doc_id as string)), 4) <> 2"


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    return got.withColumnRenamed("id", "doc_id")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), with_ids=False)
    return got.withColumnRenamed("id", "doc_id")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = source_mix.fair_queue(table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), "id % 100 = 0")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.format_chats(table(spark, sf_dir, "conversations"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality_rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return got.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = line_dedup.keep_lines(docs, line_dedup.line_bitmaps(docs))
    return got.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.fit(docs, table(spark, sf_dir, "labels"), where=NOT_HELD_OUT)
    got = quality_crf.quality_scores(docs, model).withColumnRenamed("id", "doc_id")
    held = F.expr("pmod(crc32(cast(doc_id as string)), 4) = 2")
    return got.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return license_scan.license_scan(docs, license_scan.fit(docs)).withColumnRenamed("id", "doc_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_minhash_near_dedup": op1,
    "op2_packing": op2,
    "op3_source_mixing": op3,
    "op4_nearest_neighbours": op4,
    "op5_chat_formatting": op5,
    "op6_quality_rules": op6,
    "op7_token_counts": op7,
    "op8_line_dedup": op8,
    "op9_quality_classifier": op9,
    "op10_license_scan": op10,
    "pipeline": pipeline,
}

_WORDS = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_PIECE = "coalesce(length({0}) || ':' || {0}, '-')"

#: Operators 1, 2, 4, 6, 7, 9 and 10 and the pipeline have no SQL that is the same (or fast enough); tests/llm holds
#: them against plain Python.
ORACLES: dict[str, str] = {
    "op3_source_mixing": f"""with d as (select doc_id, source, case when text is null then 0 else {_WORDS} end::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
n as (select *, ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as w, row_number() over (order by source nulls last) as nr, sum(source_size) over ()::bigint as budget from s),
l as (select *, 3.0::double * source_size as most, 3.0::double * source_size / w as level from n),
r as (select *, (budget - coalesce(sum(most) over (order by level, nr rows between unbounded preceding and 1 preceding), 0)) / sum(w) over (order by level, nr rows between current row and unbounded following) as rate from l),
t as (select source, source_size, budget, nr, least(most, w * max(case when rate <= level then rate end) over ()) as target from r),
q as (select d.*, source_size, target, budget, nr, coalesce(sum(size) over (partition by d.source order by md5('1:' || doc_id), doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as start, row_number() over () as i from d join t on d.source is not distinct from t.source),
c as (select i, nr, size, target, budget, start + r * source_size as start from q, (select unnest([0, 1, 2]) as r) where size > 0 and start + r * source_size < target),
w as (select *, case when start + size <= target then size else ceil(size / 1024.0::double)::bigint end as width from c),
e as (select i, nr, target, budget, start + k as start, least(width, size - k) as words from (select *, unnest(range(0, size, width)) as k from w) where start + k < target),
f as (select *, coalesce(sum(words) over (order by (start + words)::double * budget / target, nr, start rows between unbounded preceding and 1 preceding), 0)::bigint as served from e),
x as (select i, sum(greatest(0, least(words, budget - served)))::bigint as taken from f group by i)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from q left join x using (i)""",
    "op5_chat_formatting": f"""with c as (select *, string_agg({_PIECE.format('role')} || '|' || {_PIECE.format('text')}, ';') over w as p, row_number() over w as k, count(*) over (partition by conv_id) as n from conversations where conv_id is not null window w as (partition by conv_id order by turn, role, text rows unbounded preceding)),
f as (select p, min(conv_id) as conv_id from c where k = n and p not in (select p from c where k < n) group by p)
select conv_id, count(*) as n_turns, string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' order by turn, role, text) as text from conversations where conv_id in (select conv_id from f) group by conv_id""",
    "op8_line_dedup": f"""with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) as pos from documents),
k as (select *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
s as (select key, max(doc_id) as last from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
j as (select k.*, coalesce(k.doc_id < s.last, false) as goes from k left join s using (key))
select doc_id, count(*) as n_lines, count(*) filter (goes) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not goes), '')) as kept_sha256 from j group by doc_id""",
}
