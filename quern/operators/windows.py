"""Chunks, sample windows and labels over token streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import words
from .ordinal import running


def sentences(text: Column) -> Column:
    """T1 by rule: runs up to and with their end marks."""
    return F.regexp_extract_all(text, F.lit("[^.!?]+[.!?]*"), F.lit(0))


def sentence_lengths(text: Column, eod: bool = True) -> Column:
    """Words of each sentence that has any; the end-of-document token counts with the last."""
    n = F.filter(F.transform(sentences(text), lambda s: F.size(words(s))), lambda k: k > 0)
    return F.transform(n, lambda k, i: F.when(i == F.size(n) - 1, k + int(eod)).otherwise(k)) if eod else n


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lens, n_tokens)."""
    n = docs.select(F.col(id_col).alias("id"), F.filter(F.transform(sentences(F.col(text_col)), lambda s: F.size(words(s))), lambda k: k > 0).alias("n"))
    lens = F.expr("case when size(n) = 0 then n else concat(slice(n, 1, size(n) - 1), array(n[size(n) - 1] + 1)) end")
    return n.select("id", lens.alias("lens")).withColumn("n_tokens", F.expr("aggregate(lens, 0, (a, x) -> a + x)"))


def chunks(docs: DataFrame, length: int = 64, id_col: str = "doc_id", text_col: str = "text", eod: str = "<eod>") -> DataFrame:
    """(id, chunk, start, stop, tokens) with the last chunk filled up with end tokens."""
    w = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    c = w.select("id", "w", F.posexplode(F.sequence(F.lit(0), F.size("w") - 1, F.lit(length))).alias("chunk", "start"))
    c = c.withColumn("stop", F.least(F.col("start") + length, F.size("w")))
    full = F.concat(F.slice("w", F.col("start") + 1, F.lit(length)), F.array_repeat(F.lit(eod), (F.lit(length) - (F.col("stop") - F.col("start")))))
    return c.select("id", "chunk", "start", "stop", full.alias("tokens"))


def chunk_validity(chunked: DataFrame) -> DataFrame:
    """Chunks per document that a second tokenizer (words with a letter) finds empty or not."""
    ok = F.exists("tokens", lambda t: t.rlike(r"^[\p{L}]+$"))
    return chunked.groupBy("id").agg(F.count_if(ok).alias("n_valid"), F.count_if(~ok).alias("n_invalid"))


def chunk_offsets(valid: DataFrame, train: float = 0.9) -> DataFrame:
    """Per document its chunk offset and whether it is a training document (first int(train n) of them)."""
    n = valid.count()
    return running(valid, ["id"], {"offset": "n_valid"}).withColumn("train", F.col("ord") < int(train * n)).drop("ord")


def epochs_needed(tokens: int, samples: int, length: int, extra: int = 1) -> int:
    """The least number of passes that give so many samples."""
    return -(-(samples * length + extra) // tokens)


def document_stream(docs: DataFrame, id_col: str, size: Column) -> DataFrame:
    """(id, len, pos, start): documents in order of id with their place in the stream of all tokens."""
    d = docs.select(F.col(id_col).alias("id"), size.cast("long").alias("len"))
    return running(d, ["id"], {"start": "len"}, "pos")


def sample_index(stream: DataFrame, length: int, extra: int = 1) -> DataFrame:
    """(sample, pos, offset) for every sample boundary. Each document finds the boundaries inside it, so no range join."""
    total = stream.agg(F.sum("len")).first()[0] or 0
    n = max(0, (total - extra) // length)
    k = F.sequence(F.expr(f"cast(ceil(start / {length}D) as bigint)"), F.expr(f"(start + len - 1) div {length}"))
    some = stream.where(f"len > 0 and (start + len - 1) div {length} >= ceil(start / {length}D)")
    return some.select(F.explode(k).alias("sample"), "pos", "start").where(F.col("sample") <= n).select("sample", "pos", (F.col("sample") * length - F.col("start")).alias("offset"))


def sample_spans(stream: DataFrame, length: int, extra: int = 1) -> DataFrame:
    """(sample, pos, from, to): the part of each document in each sample [kL, kL + L + extra)."""
    total = stream.agg(F.sum("len")).first()[0] or 0
    n = max(0, (total - extra) // length)
    low = F.expr(f"greatest(0, cast(floor((start - {extra}) / {length}D) as bigint))")
    s = stream.where("len > 0").select("pos", "start", "len", F.explode(F.sequence(low, F.expr(f"(start + len - 1) div {length}"))).alias("sample")).where(F.col("sample") < n)
    a, b = F.col("sample") * length, (F.col("sample") + 1) * length + extra
    return s.select("sample", "pos", F.greatest(a - F.col("start"), F.lit(0)).alias("from"), F.least(b - F.col("start"), F.col("len")).alias("to")).where("to > from")


def shuffle_index(ids: DataFrame, id_col: str, seed: int) -> DataFrame:
    """(i, id) with the ids in a seeded pseudo-random order."""
    k = ids.select(F.col(id_col).alias("id"), F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))).alias("h"))
    return running(k, ["h", "id"], ordinal="i").select("i", "id")


def token_labels(tokens: DataFrame, eod: str = "<eod>") -> DataFrame:
    """From (key, i, token): label (the next token), loss mask (0 at end tokens), position since the last end token."""
    w = Window.partitionBy("key").orderBy("i")
    last = F.max(F.when(F.col("token") == eod, F.col("i") + 1)).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return tokens.select("key", "i", "token", F.lead("token").over(w).alias("label"), (F.col("token") != eod).cast("int").alias("loss_mask"), (F.col("i") - F.coalesce(last, F.lit(0))).alias("position"))


def evaluation_windows(sizes: DataFrame, window: int, stride: int) -> DataFrame:
    """From (id, n): (id, k, start, scored_from); after the first window only the new tail is scored."""
    more = F.expr(f"cast(ceil(greatest(n - {window}, 0) / {stride}D) as int)")
    k = sizes.select("id", "n", F.explode(F.sequence(F.lit(0), more)).alias("k"))
    return k.select("id", "k", (F.col("k") * stride).alias("start"), F.when(F.col("k") == 0, 0).otherwise(window - stride).alias("scored_from"))


def last_word_cloze(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The last word apart from what stands before it."""
    w = F.split(F.trim(F.regexp_replace(text_col, r"\s+", " ")), " ")
    return docs.select(F.col(id_col).alias("id"), F.array_join(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), " ").alias("context"), F.element_at(w, -1).alias("label"))
