"""Queries of row-wise training samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import words
from ..operators.chat import supervised
from ..operators import samples as S
from ..operators import windows as X
from ..session import table

W = r"[\p{L}\p{N}_]"


def docs(s, d):
    return table(s, d, "documents").select("doc_id", "text", "lang")


def encoded(s, d):
    return X.encoded(docs(s, d))


def tokens(s, d):
    return docs(s, d).select(F.col("doc_id").alias("id"), words(F.col("text")).alias("w")).where("size(w) > 0")


def _masked(s, d):
    row = lambda r: [(r.id, k, len(w), len(S.masked(w, S.sample_seed(r.id, k))[1])) for k, w in enumerate(S.consecutive(list(r.w), 512))]
    return S.per_row(tokens(s, d), row, "id long, sample int, n int, masked int")


def _corrupted(s, d):
    row = lambda r: [(r.id, k, *map(len, S.span_corrupted(w, S.sample_seed(r.id, k)))) for k, w in enumerate(S.consecutive(list(r.w), 512))]
    return S.per_row(tokens(s, d), row, "id long, sample int, encoder int, decoder int")


def _pair_samples(s, d):
    t = docs(s, d).select(F.col("doc_id").alias("id"), F.filter(F.transform(X.sentences(F.col("text")), lambda x: words(x)), lambda x: F.size(x) > 0).alias("s")).where("size(s) > 1")
    one = lambda g, seed: (lambda x: (len(x[0]), sum(x[1]), x[2]))(S.pair_sample(g, 128, seed))
    row = lambda r: [(r.id, k, *one(g, S.sample_seed(r.id, k))) for k, g in enumerate(S.pair_groups([list(y) for y in r.s], 128))]
    return S.per_row(t, row, "id long, sample int, n int, second int, swapped boolean")


def turns(s, d):
    c = table(s, d, "conversations")
    q = c.where("role = 'user'").select("conv_id", F.col("turn").alias("i"), F.md5("text").alias("q"))
    return q.join(c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("i"), F.md5("text").alias("a")), ["conv_id", "i"])


def _overlaps(s, d):
    """The whole text is the knowledge; the response is the same with 1 to 30 fortieths of its length in foreign words behind it."""

    def row(r):
        k = list(r.k)
        response = k + [f"zz{i}" for i in range(1, -(-len(k) * (r.doc_id % 30 + 1) // 40) + 1)]
        n = S.overlap_in_runs(response, k)
        return [(r.doc_id, n, S.overlap_kept(n, len(response), len(k)))]

    return S.per_row(docs(s, d).select("doc_id", words(F.coalesce("text", F.lit(""))).alias("k")), row, "doc_id long, overlap int, kept boolean")


def _shots(s, d):
    """Every row whose id is divisible by 100 against all rows but itself; half of them of an unknown topic."""
    e = table(s, d, "embeddings")
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("q"), F.when(F.col("vec_id") % 200 == 0, -1).otherwise(F.col("label")).alias("topic"), F.col("embedding").alias("qv"))
    return S.few_shot(q, e.select(F.col("vec_id").alias("e"), F.col("label").alias("topic"), F.col("embedding").alias("v")), apart=True)


def rounds(s, d):
    """(conv_id, pairs): questions and answers as arrays of their words' lengths."""
    c = table(s, d, "conversations").select("conv_id", "turn", "role", F.transform(words(F.col("text")), lambda w: F.length(w)).alias("w"))
    t = c.where("role = 'user'").select("conv_id", F.col("turn").alias("i"), F.col("w").alias("source"))
    t = t.join(c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("i"), F.col("w").alias("target")), ["conv_id", "i"])
    return t.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "source", "target"))), lambda x: F.struct(x["source"].alias("source"), x["target"].alias("target"))).alias("pairs"))


def _supervised(s, d):
    x = rounds(s, d).select("conv_id", supervised(F.col("pairs"), 256, eos=2).alias("x"))
    text = lambda c: F.md5(F.array_join(F.transform(c, lambda v: v.cast("string")), ","))
    return x.select("conv_id", F.size("x.ids").alias("n"), text("x.ids").alias("ids"), text("x.labels").alias("labels"), F.aggregate("x.loss_mask", F.lit(0), lambda a, v: a + v).alias("loss"))


_SENT = f"list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'), lambda s: len(regexp_extract_all(lower(s), '{W}+'))), lambda k: k > 0)"
# cuts a document's sentences into samples: TARGET tokens, at least LEAST sentences, MORE of them left
_CUTS = f"""with recursive n as (select doc_id, {_SENT} as n from documents), l as (select doc_id, case when len(n) = 0 then n else list_concat(n[1:len(n)-1], [n[len(n)] + 1]) end as n from n),
ok as (select * from l where len(n) >= LEAST and (len(n) = 1 or list_max(n) <= 512)),
w as (select doc_id, n, 0 as i, 0 as head, 0::bigint as total, false as hit, 0 as begins, -1 as block from ok union all
select doc_id, n, i + 1, case when cut then i + 1 else head end, case when cut then 0 else t end, cut, head, case when cut then block + 1 else block end from
(select *, ((t >= TARGET and MORE and i + 1 - head >= LEAST) or len(n) - i - 1 = 0) as cut from (select *, total + n[i + 1] as t from w where i < len(n))))
"""
_W7 = _CUTS.replace("LEAST", "2").replace("TARGET", "128").replace("MORE", "len(n) - i - 1 > 1") + 'select doc_id as id, begins as first, i as "end", 128 as target from w where hit'
_W8 = _CUTS.replace("LEAST", "1").replace("TARGET", "120").replace("MORE", "len(n) - i - 1 >= 1") + 'select doc_id as id, block, begins as first, i as "end", 120 as target from w where hit'
_LENGTHS = "list_transform(regexp_extract_all(lower(COLUMN), '" + W + "+'), lambda x: length(x))"
_VA7 = f"""with recursive t as (select a.conv_id, row_number() over (partition by a.conv_id order by a.turn) as k, {_LENGTHS.replace('COLUMN', 'a.text')} as s, {_LENGTHS.replace('COLUMN', 'b.text')} as t from conversations a join conversations b on b.conv_id = a.conv_id and b.turn = a.turn + 1 where a.role = 'user' and b.role = 'assistant'),
w as (select distinct conv_id, 0::bigint as k, 1::bigint as used, []::bigint[] as ids, []::bigint[] as labels from t union all
select conv_id, k, used + ns + nt, list_concat(ids, s[1:ns], t[1:nt]), list_concat(labels, case when k > 1 then list_concat([2], list_transform(range(0, greatest(ns - 1, 0)), lambda i: -100)) else list_transform(range(0, ns), lambda i: -100) end, t[1:nt]) from
(select *, least(greatest(room - nt, 0), len(s)) as ns from
(select *, least(case when len(t) * 2 < room then room when len(s) * 2 < room then room - len(s) else floor(room::double * (len(t)::double / greatest(len(s) + len(t), 1)))::bigint end, len(t)) as nt from
(select t.*, w.used, w.ids, w.labels, 256 - w.used as room from w join t on t.conv_id = w.conv_id and t.k = w.k + 1 where w.used < 256)))),
f as (select conv_id, list_append(ids, 2) as ids, list_append(labels, 2) as labels from w qualify row_number() over (partition by conv_id order by k desc) = 1)
select conv_id, len(ids)::int as n, md5(array_to_string(ids, ',')) as ids, md5(array_to_string(labels, ',')) as labels, len(list_filter(labels, lambda x: x <> -100))::int as loss from f"""

QUERIES = {
    "F6_text_repair": lambda s, d: S.repaired_texts(docs(s, d)).select("id", F.md5("text").alias("text"), "fixed"),
    "F7_language_detector": lambda s, d: docs(s, d).select("doc_id", S.detected_language(words(F.col("text"))).alias("found")),
    "W7_sentence_pairs": lambda s, d: S.sentence_pair_index(encoded(s, d)),
    "W7_short_sentence_pairs": lambda s, d: S.sentence_pair_index(encoded(s, d), short=0.1),
    "W8_blocks": lambda s, d: S.block_index(encoded(s, d).withColumn("title", F.lit(8))),
    "W9_masked_tokens": _masked,
    "W10_pair_samples": _pair_samples,
    "W11_span_corruption": _corrupted,
    "W12_inverse_cloze": lambda s, d: S.per_row(docs(s, d).select(F.col("doc_id").alias("id"), X.sentences(F.col("text")).alias("s")).where("size(s) > 1"), lambda r: [(r.id, x[0], len(x[1])) for x in [S.inverse_cloze(list(r.s), 7 + r.id)]], "id long, query string, block int"),
    "VA7_supervised_encode": _supervised,
    "B10_repeat": lambda s, d: S.repeated(docs(s, d).select("doc_id"), (F.col("doc_id") % 3 + 1).cast("int")),
    "X8_random_round": lambda s, d: S.random_round(turns(s, d), "conv_id"),
    "X17_few_shot": _shots,
    "X18_overlap_filter": _overlaps,
}

ORACLES = {
    "W7_sentence_pairs": _W7,
    "W8_blocks": _W8,
    "VA7_supervised_encode": _VA7,
    "B10_repeat": "select doc_id, unnest(range(1, doc_id % 3 + 2))::int as epoch from documents",
    "X8_random_round": """with t as (select a.conv_id, a.turn as i, md5(a.text) as q, md5(b.text) as a from conversations a join conversations b on b.conv_id = a.conv_id and b.turn = a.turn + 1 where a.role = 'user' and b.role = 'assistant'),
h as (select *, md5('1:' || conv_id || ':' || i) as h, lag(q) over (partition by conv_id order by i) as before from t)
select conv_id, i, q, a, case when substr(h, 1, 1) < '8' then before end as history from h qualify h = min(h) over (partition by conv_id)""",
    "X17_few_shot": """with q as (select vec_id as q, case when vec_id % 200 = 0 then -1 else label end as topic, embedding as qv from embeddings where vec_id % 100 = 0), e as (select vec_id as e, label as topic, embedding as v from embeddings),
p as (select q, q.topic, e, e.topic as et, q.topic in (select topic from e) as seen, list_sum(list_transform(range(1, len(v) + 1), lambda i: v[i]::double * qv[i]::double)) as s from q, e where e <> q),
o as (select q, 11 - row_number() over (partition by q order by s desc, e) as place, e from p where seen and topic = et),
n as (select q, e, s from p where not seen qualify row_number() over (partition by q, et order by s desc, e) = 1)
select q, place::int as place, e from o where place >= 1 union all select q, row_number() over (partition by q order by s, e)::int as place, e from n qualify row_number() over (partition by q order by s, e) <= 10""",
}
