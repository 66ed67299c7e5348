"""Token counts of whole texts (operator 7), by the whole-token shortcut.

Before any text is seen, every vocabulary string that stands for a whole word is encoded alone; those that come out as
one token are the whole tokens. A text is cut into pre-tokens on its bytes; a pre-token that is a whole token counts
one, and only the rest is merged by the library, once for each distinct pre-token and worker. Texts outside the
proven alphabet, or with special strings, are counted by the library as they are.

Edge cases: null and empty texts have no tokens; special strings inside a text count as the library's default has it
(one token each); texts of any length are counted whole; other columns are ignored, repeated rows count each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, text_chunks
from .tokens import Cached, lowered, merged, plain_texts, pretoken_spans, split_plain


def whole_tokens(tokenizer, path: str) -> frozenset[str]:
    """The strings that the tokenizer, given them alone, encodes as one token that is their own vocabulary entry."""
    from tokenizers import decoders

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    ends = [w[:-4] for w in vocab if w.endswith("</w>") and len(w) > 4]
    plain = decoders.ByteLevel()
    texts = [plain.decode([w]) for w in ends]
    out = set()
    for w, t, e in zip(ends, texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
        if len(e.ids) == 1 and e.ids[0] == vocab[f"{w}</w>"]:
            out.add(t)
    return frozenset(out)


@lru_cache(maxsize=4)
def _counter(path: str) -> tuple:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    whole, model = whole_tokens(t, path), t.model

    def make(texts: list[str]) -> list[int]:
        return [1 if x in whole else len(merged(model, x)) for x in texts]

    return t, Cached(make)


def count_tokens(data: np.ndarray, offs: np.ndarray, path: str) -> np.ndarray:
    """Token counts of texts given as bytes and offsets."""
    t, cached = _counter(path)
    plain = plain_texts(data, offs)
    out = np.zeros(len(offs) - 1, np.int64)
    d, o = split_plain(data, offs, plain)
    if len(d):
        d = lowered(d)
        starts, ends = pretoken_spans(d, o, blanks=False)
        codes, values = cached(d, starts, ends)
        sums = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(np.array(values, np.int64)[codes] if len(codes) else np.zeros(0, np.int64), out=sums[1:])
        out[plain] = np.diff(sums[np.searchsorted(starts, o)])
    for i in np.flatnonzero(~plain).tolist():
        out[i] = len(t.encode(data[offs[i] : offs[i + 1]].tobytes().decode(), add_special_tokens=False).ids)
    return out


def _counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for lo, hi, data, offs in text_chunks(b, "text"):
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(np.diff(offs)), pa.array(count_tokens(data, offs, path))], ["id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", *, limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row. The vocabulary file lies at the same path on every executor."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    got = arrow_map(src, partial(_counts, path=tokenizer_path), "id long, n_bytes long, n_tokens long")
    return got.withColumn("over_limit", F.col("n_tokens") > limit)
