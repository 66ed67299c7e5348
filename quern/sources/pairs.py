"""Pairs of text and image as token sequences (IO20)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed_length(ids: Column, length: int, eod: int | None) -> Column:
    """Token ids cut to length and filled up with eod; an empty text stays empty, and without eod nothing changes."""
    if eod is None:
        return ids
    cut = F.slice(ids, 1, length)
    return F.when(F.size(ids) == 0, ids).otherwise(F.concat(cut, F.array_repeat(F.lit(eod), F.lit(length) - F.size(cut))))


def image_words(content: Column) -> Column:
    """Bytes as 32-bit little-endian words: first how many zero bytes were added to fill the last one, then the words."""

    @F.pandas_udf("array<int>")
    def run(x: pd.Series) -> pd.Series:
        made = [None if v is None else np.concatenate([[-len(v) % 4], np.frombuffer(bytes(v) + bytes(-len(v) % 4), "<i4")]).astype(np.int32) for v in x]
        return pd.Series(made, dtype=object)

    return run(content)


def ingest(texts: DataFrame, images: DataFrame, key: str = "key", ids: str = "ids", content: str = "content", *, length: int, eod: int | None) -> DataFrame:
    """(doc_id, seq_no, mode, tokens): for each key the text's sequence (mode 0) and then the image's (mode 1).

    Texts and images meet on an explicit key, not on the order of a listing; documents are numbered in order of it.
    """
    from ..operators.ordinal import running

    both = texts.select(key, F.col(ids).alias("_ids")).join(images.select(key, F.col(content).alias("_raw")), key)
    nr = running(both, [key], ordinal="_nr")
    parts = F.array(F.struct(F.lit(0).alias("mode"), fixed_length(F.col("_ids"), length, eod).cast("array<int>").alias("tokens")), F.struct(F.lit(1).alias("mode"), image_words(F.col("_raw")).alias("tokens")))
    return nr.select(F.col("_nr").alias("doc_id"), F.posexplode(parts).alias("k", "p")).select("doc_id", (F.col("doc_id") * 2 + F.col("k")).alias("seq_no"), "p.mode", "p.tokens")
