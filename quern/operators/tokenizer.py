"""Tokenizers as column functions (T4): one Arrow-batched UDF per method, the file loaded once per worker."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship


#: What the byte-level pattern's classes are among these characters; any other text is the library's.
_PLAIN = re.compile("[ -~\\t-\\rÀ-ÿ]*")
_PIECE = re.compile("'(?:[stmd]|re|ve|ll)| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^ \\t-\\rA-Za-z0-9À-ÖØ-öø-ÿ]+|[ \\t-\\r]+(?![^ \\t-\\r])|[ \\t-\\r]+")
#: Pieces whose ids a worker keeps (twice as many at most), and texts that go to the library together.
PIECES, TEXTS = 150_000, 64


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in own)}


class _Json:
    """A `tokenizers` file.

    Where pieces are by the usual byte-level pattern, a plain text's ids are those of its pieces, and the library's model is
    asked once for each piece; pieces not seen for long are forgotten. The library is asked for the whole of any other text.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.t.no_truncation()
        self.t.no_padding()
        told = json.loads(self.t.to_str())
        pre, model, added = told["pre_tokenizer"] or {}, told["model"], told["added_tokens"]
        self.by_piece = told["normalizer"] is None and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre.get("use_regex", True) and model["type"] == "BPE" and not model.get("dropout") and all(x["content"] for x in added)
        self.own = re.compile("|".join(re.escape(x["content"]) for x in added)) if added else None
        self.model, self.letters = self.t.model, {b: c for c, b in byte_of().items()}
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.bytes = None
        if (told["decoder"] or {}).get("type") == "ByteLevel":
            to = byte_of()
            whole = lambda x: bytes(map(to.get, x)) if all(c in to for c in x) else x.encode()
            self.bytes = {i: whole(x) for x, i in self.t.get_vocab(with_added_tokens=True).items()}

    def _pieces(self, text: str) -> list[int]:
        found = _PIECE.findall(text)
        for x in set(found).difference(self.young):
            ids = self.old.get(x)
            self.young[x] = tuple([t.id for t in self.model.tokenize("".join([self.letters[b] for b in x.encode()]))]) if ids is None else ids
        ids = list(chain.from_iterable(map(self.young.__getitem__, found)))
        if len(self.young) > PIECES:
            self.old, self.young = self.young, {}
        return ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        out: list = [self._pieces(x) if self.by_piece and _PLAIN.fullmatch(x) and not (self.own and self.own.search(x)) else None for x in texts]
        other = [i for i, x in enumerate(out) if x is None]
        for at in range(0, len(other), TEXTS):
            some = other[at : at + TEXTS]
            for i, e in zip(some, self.t.encode_batch([texts[i] for i in some], add_special_tokens=False)):
                out[i] = e.ids
        return out

    def offsets(self, texts: list[str]) -> list[list[int]]:
        return [[a for a, _ in e.offsets] for e in self.t.encode_batch(texts, add_special_tokens=False)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        if self.bytes is None:
            return self.t.decode_batch(ids, skip_special_tokens=False)
        return [b"".join(map(self.bytes.get, x, repeat(b""))).decode("utf-8", "replace") for x in ids]

    def vocab(self) -> dict[str, int]:
        return self.t.get_vocab(with_added_tokens=True)

    def special(self) -> dict[str, int]:
        return {v.content: k for k, v in self.t.get_added_tokens_decoder().items() if v.special}


class _Pieces:
    """A `sentencepiece` model."""

    def __init__(self, path: str):
        import sentencepiece

        self.t = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.t.encode(texts, num_threads=1)

    def offsets(self, texts: list[str]) -> list[list[int]]:
        return [[p.begin for p in self.t.encode(x, return_type="proto").pieces] for x in texts]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.t.decode(ids)

    def vocab(self) -> dict[str, int]:
        return {self.t.id_to_piece(i): i for i in range(self.t.get_piece_size())}

    def special(self) -> dict[str, int]:
        return {self.t.id_to_piece(i): i for i in range(self.t.get_piece_size()) if self.t.is_control(i) or self.t.is_unknown(i)}


@lru_cache(maxsize=4)
def loaded(path: str) -> _Json | _Pieces:
    return _Pieces(path) if path.endswith(".model") else _Json(path)


class Tokenizer:
    """tokenize, detokenize and offsets of a column; vocab, size and special ids. The file lies at the same path everywhere.

    A null text is an empty one; special strings inside texts are tokens of their own, the library's default.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        ship(spark)

    def tokenize(self, text: Column) -> Column:
        path = self.path

        @F.pandas_udf("array<int>")
        def run(x: pd.Series) -> pd.Series:
            made: list = []
            for at in range(0, len(x), TEXTS):  # arrays instead of lists of numbers, as soon as some are there
                made += [np.array(v, np.int32) for v in loaded(path).encode(x.iloc[at : at + TEXTS].fillna("").tolist())]
            return pd.Series(made, dtype=object)

        return run(text)

    def offsets(self, text: Column) -> Column:
        """Where each token begins, in characters."""
        path = self.path

        @F.pandas_udf("array<int>")
        def run(x: pd.Series) -> pd.Series:
            return pd.Series(loaded(path).offsets(x.fillna("").tolist()))

        return run(text)

    def detokenize(self, ids: Column) -> Column:
        path = self.path

        @F.pandas_udf("string")
        def run(x: pd.Series) -> pd.Series:
            made: list = []
            for at in range(0, len(x), TEXTS):
                made += loaded(path).decode([[] if v is None else np.asarray(v, np.int64).tolist() for v in x.iloc[at : at + TEXTS]])
            return pd.Series(made, dtype=object)

        return run(ids)

    def vocab(self) -> DataFrame:
        """(token, id); read by token it is the vocabulary, by id the inverse one."""
        return self.spark.createDataFrame(pd.DataFrame(sorted(loaded(self.path).vocab().items(), key=lambda x: x[1]), columns=["token", "id"]), "token string, id int")

    @property
    def size(self) -> int:
        return len(loaded(self.path).vocab())

    @property
    def special(self) -> dict[str, int]:
        return loaded(self.path).special()

    @property
    def eod(self) -> int | None:
        """The end-of-document id: that of <|endoftext|> or </s>."""
        s = self.special
        return next((s[x] for x in ("<|endoftext|>", "</s>") if x in s), None)
