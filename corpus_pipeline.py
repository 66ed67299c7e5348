"""From raw documents to packed training sequences: each stage is one operator of quern.llm.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a table, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import line_dedup, minhash_dedup, packing, quality_crf, source_mix
from quern.llm.common import fresh, stage
from quern.llm.queries import NOT_HELD_OUT, tokenizer
from quern.session import table


def counted_anew(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, n_chars (where there is one) of the changed text."""
    if "n_chars" not in docs.columns:
        return changed.select(*docs.columns)
    n = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return changed.select(*[n if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier scores below 0.7 go.

    Null, empty and wordless texts score the training documents' share of good ones and stay or go by it, all alike;
    repeated rows and ids are scored each; an empty table stays empty; columns of any name are passed on.
    """
    model = quality_crf.fit(docs, table(spark, sf_dir, "labels"), where=NOT_HELD_OUT)
    return quality_crf.good_documents(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more found in 3 documents stay in the one with the largest id. n_chars is counted anew.

    A null text stays null; empty lines stay; rows with a null id keep all and count for nothing; rows that repeat an
    id are one document for the counts; a document all of whose lines go stays with an empty text.
    """
    kept = line_dedup.keep_lines(docs, line_dedup.line_bitmaps(docs), n_lines=fresh(docs, "n_lines"), n_dropped=fresh(docs, "n_dropped"))
    return counted_anew(kept, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 of their five-word shingles the document with the smallest id stays.

    Null and wordless texts and null ids are in no group and stay; of rows alike in every column one stays; rows that
    repeat an id with different texts are documents of their own.
    """
    return minhash_dedup.without_near_duplicates(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in proportion 1, 2, 3, repeating, at the corpus's size; a row for each copy. n_chars is counted anew.

    Texts without a word have nothing to give and go; a null source is a source; equal digests go by the row's digest;
    rows alike in every column share what they are taken.
    """
    return counted_anew(source_mix.mixed_documents(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens. A null or empty text is its end token; every row is packed."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"), with_ids=False).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: Tokenizers, the classifier and the sketches have no SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
