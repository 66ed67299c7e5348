"""Benchmark decontamination by word n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import words
from ..session import ship

LONGEST, SHORTEST = 13, 8


def _let(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def _grams(w: Column, n: int) -> Column:
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))


def ngram_dictionary(items: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct (ngram, size): every 13-gram; texts of 8 to 12 words are one n-gram, shorter ones give none."""
    w = words(F.col(text_col))
    made = _let(w, lambda x: F.when(F.size(x) < SHORTEST, F.array().cast("array<string>")).when(F.size(x) < LONGEST, F.array(F.array_join(x, " "))).otherwise(_grams(x, LONGEST)))
    return items.select(F.explode(made).alias("ngram")).distinct().withColumn("size", F.size(F.split("ngram", " ")))


def save_dictionary(dictionary: DataFrame, path: str) -> None:
    """C11."""
    dictionary.select("ngram", "size").write.mode("overwrite").parquet(path)


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """C11."""
    return spark.read.schema("ngram string, size int").parquet(path)


def length_histogram(dictionary: DataFrame) -> DataFrame:
    """C4."""
    return dictionary.groupBy("size").agg(F.count(F.lit(1)).alias("n"))


def matches(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Distinct (id, ngram) of the dictionary's n-grams in documents of 13 words or more.

    Documents send 64-bit hashes of their n-grams, of the few lengths in the dictionary; the dictionary is broadcast if
    it is below Spark's limit and shuffled otherwise.
    """
    sizes = sorted(r.size for r in dictionary.select("size").distinct().collect())  # 8 to 13 at most
    if not sizes:
        return docs.select(F.col(id_col).alias("id"), F.lit("").alias("ngram")).limit(0)
    keyed = dictionary.select(F.xxhash64("ngram").alias("h"), "ngram")
    made = _let(words(F.col(text_col)), lambda w: F.when(F.size(w) >= LONGEST, F.array_distinct(F.transform(F.flatten(F.array(*[_grams(w, n) for n in sizes])), lambda g: F.xxhash64(g)))))
    return docs.select(F.col(id_col).alias("id"), F.explode(made).alias("h")).join(keyed, "h").select("id", "ngram")


def document_frequency(dictionary: DataFrame, found: DataFrame) -> DataFrame:
    """(ngram, df) for the whole dictionary; n-grams without a match have 0."""
    df = found.groupBy("ngram").agg(F.count(F.lit(1)).alias("df"))
    return dictionary.select("ngram").join(df, "ngram", "left").select("ngram", F.coalesce("df", F.lit(0)).alias("df"))


def telling(frequencies: DataFrame, below: int = 10) -> DataFrame:
    """N-grams in fewer than `below` documents; the others are boilerplate."""
    return frequencies.where(F.col("df") < below)


def contaminated(found: DataFrame, kept: DataFrame) -> DataFrame:
    """Ids of documents that hold one of the kept n-grams."""
    return found.join(kept.select("ngram"), "ngram", "left_semi").select("id").distinct()


_WORD = re.compile(r"\w+")


def split_text(text: str, grams: set[str], margin: int = 200, least: int = 200) -> list[str]:
    """The pieces of text that are left around matched n-grams.

    The longest size is tried first at each place, then the shorter ones from short to long; what a match cuts away
    reaches `margin` characters to both sides and on to the next . ! or ?; pieces of `least` characters or fewer go.
    """
    sizes = sorted({g.count(" ") + 1 for g in grams})
    order = [LONGEST, *[n for n in sizes]]
    todo, out = [text], []
    while todo:
        t = todo.pop(0)
        at = [(m[0], m.start()) for m in _WORD.finditer(t.lower())]
        names = [x[0] for x in at]
        places = [(i, n) for i in range(len(names) - LONGEST + 1) for n in order]
        if len(names) > LONGEST:
            tail = len(names) - LONGEST
            places += [(i, n) for n in sizes if n != LONGEST for i in range(tail, len(names) - n + 1)]
        hit = next(((at[i][1], s) for i, n in places if (s := " ".join(names[i : i + n])) in grams), None)
        if hit is None:
            out.append(t)
            continue
        left, right = hit[0] - margin, hit[0] + len(hit[1]) + margin
        while left > 0 and t[left] not in ".!?":
            left -= 1
        while right < len(t) and t[right] not in ".!?":
            right += 1
        before, after = t[: left + 1] if left > 0 else "", t[right + 1 :]
        if len(before) > least:
            out.append(before)
        if len(after) > least:
            todo.append(after)
    return out


def decontaminated(docs: DataFrame, found: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, most: int = 10, margin: int = 200, least: int = 200) -> DataFrame:
    """(id, piece, text, status); documents in more than `most` pieces are dropped (status over_split, no text).

    A document travels with its own matches only, so no dictionary is held in a task. Others pass unchanged.
    """
    own = found.join(kept.select("ngram"), "ngram", "left_semi").groupBy("id").agg(F.collect_set("ngram").alias("grams")).withColumnRenamed("id", "_id")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    both = src.join(own, F.col("id") == F.col("_id"), "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            rows = []
            for i, t, g in zip(d["id"], d["text"], d["grams"], strict=True):
                pieces = split_text(t, set(g), margin, least)
                if len(pieces) > most:
                    rows.append((i, 0, None, "over_split"))
                elif not pieces:
                    rows.append((i, 0, None, "removed"))
                else:
                    status = "trimmed" if len(pieces) == 1 and len(pieces[0]) < len(t) else "split"
                    rows += [(i, k, p, status) for k, p in enumerate(pieces)]
            yield pd.DataFrame(rows, columns=["id", "piece", "text", "status"])

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    done = both.where("grams is not null").select("id", "text", "grams").mapInPandas(cut, f"id {kind}, piece int, text string, status string")
    return done.union(both.where("grams is null").select("id", F.lit(0).alias("piece"), "text", F.lit("clean").alias("status")))


def split_ids(pieces: DataFrame, prefix: str = "web") -> DataFrame:
    """Prefix-%010d-%04d for every piece."""
    return pieces.withColumn("split_id", F.format_string(f"{prefix}-%010d-%04d", F.col("id"), F.col("piece")))
