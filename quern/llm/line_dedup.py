"""Exact line dedup across documents (operator 8), in DataFrame operations only.

Every line of `min_chars` code points or more is a posting (128-bit hash, document, position). Postings are dealt out by
range of the hash with a secondary sort by document (largest first) and position within; one streaming pass over each
sorted range numbers the documents of a hash and tells the first occurrence, that in the largest document, from the
later ones, which go if `min_docs` documents hold the line. What comes back for each document that loses lines is its
keep bitmap, not its text: 64 lines to a word, words that keep all left out. The text meets its bitmap in one join.

A line that a large part of all documents hold would fill one range. So postings are counted by hash first (map-side,
one row for each task and hash); hashes of more than a 10,000th of all postings, fewer than 10,000, are broadcast with
their counts, which settles their postings where they are, without a shuffle.

Edge cases: a null or empty text is one empty line; lines of white space alone have an empty key and stay; rows with
a null id take no part and keep all; rows that repeat an id are one document for the counts, and each loses the lines
of its own text; the key strips the six ASCII separators and lower-cases A-Z only; other columns, whatever their names,
are passed on by `keep_lines` as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HEAVY, SPACES, ascii_lower, fresh, stage


def lines_of(text: F.Column) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: F.Column) -> F.Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, digest, keep) of the documents that lose a line; digest: xxhash64 of the text.

    keep is an array of (word, bits): bit i % 64 of word i / 64 is set if line i stays; words without a lost line are
    left out.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    long_enough = src.where(F.length("text") >= min_chars).withColumn("digest", F.xxhash64("text"))
    lines = long_enough.select("id", "digest", F.posexplode(lines_of(F.col("text"))).alias("pos", "line")).where(F.length("line") >= min_chars)
    lines = lines.select("id", "digest", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    post = stage(lines.select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit(7), "key").alias("g"), "id", "digest", "pos"), "postings")
    total = post.count()

    counted = post.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * HEAVY > total).where(F.col("n") >= min_docs)
    heavy = stage(counted.select("h", "g"), "heavy")
    of_heavy = post.join(F.broadcast(heavy), ["h", "g"])
    held = of_heavy.groupBy("h", "g", "id").agg(F.lit(1).alias("one")).groupBy("h", "g").agg(F.count("one").alias("docs"), F.max("id").alias("last"))
    lost_heavy = of_heavy.join(F.broadcast(held.where(F.col("docs") >= min_docs)), ["h", "g"]).where("id < last").select("id", "digest", "pos")

    n = int(post.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = post.join(F.broadcast(heavy), ["h", "g"], "left_anti").repartitionByRange(n, "h", "g")
    line = Window.partitionBy("h", "g")
    walked = dealt.withColumn("nth", F.dense_rank().over(line.orderBy(F.desc("id")))).withColumn("docs", F.max("nth").over(line))
    lost = walked.where((F.col("docs") >= min_docs) & (F.col("nth") > 1)).select("id", "digest", "pos").unionAll(lost_heavy)

    words = lost.groupBy("id", "digest", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("gone"))
    return words.groupBy("id", "digest").agg(F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("keep"))


#: A keep bitmap with every word up to the last: gaps are filled with words that keep all.
_DENSE = "flatten(transform({0}, (x, i) -> concat(array_repeat(-1L, x.word - coalesce(get({0}, i - 1).word + 1, 0)), array(x.bits))))"
#: The lines whose bit is set. The bitmap is made once, as the one member of an array.
_KEPT = "transform(array({dense}), k -> array_join(filter(split({text}, '\\n', -1), (x, i) -> (shiftright(coalesce(get(k, i div 64), -1L), cast(i % 64 as int)) & 1L) = 1L), '\\n'))[0]"


def keep_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, n_lines: str = "_n_lines", n_dropped: str = "_n_dropped") -> DataFrame:
    """docs with the lines that stay in text_col, and two counts; a text that loses no line is unchanged."""
    i, d, k = fresh(docs, "_id"), fresh(docs, "_digest"), fresh(docs, "_keep")
    text = F.col(f"`{text_col}`").cast("string")
    b = bitmaps.select(F.col("id").alias(i), F.col("digest").alias(d), F.col("keep").alias(k))
    both = docs.join(b, (docs[f"`{id_col}`"].cast("long") == b[i]) & (F.xxhash64(docs[f"`{text_col}`"].cast("string")) == b[d]), "left")
    kept = F.expr(_KEPT.format(dense=_DENSE.format(f"`{k}`"), text=f"`{text_col}`"))
    dropped = F.expr(f"coalesce(aggregate(`{k}`, 0L, (a, x) -> a + 64 - bit_count(x.bits)), 0L)")
    columns = [F.when(F.col(f"`{k}`").isNull(), F.col(f"`{c}`")).otherwise(kept).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return both.select(*columns, F.size(lines_of(text)).cast("long").alias(n_lines), dropped.alias(n_dropped))
