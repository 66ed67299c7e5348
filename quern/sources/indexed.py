"""Indexed token stores (M2, IO9 to IO11): .bin holds the tokens, .idx lengths, pointers, documents and modes.

`register` adds the format "indexed_tokens" (a Python data source): reading splits the sequences into ranges, and a task
maps the files and touches its own range only. Writing is done by all executors: every sequence's place in both files
follows from running sums, so tasks write side by side into files of the final size, and a repeated task writes the
same bytes again. Paths are in a folder that all executors share (a mounted store; `stores.fetched` brings files there).
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.ordinal import running
from ..session import ship, stage

# How an index begins, and its type codes.
MAGIC = b"MMIDIDX\x00\x00"
HEAD = 34
DTYPES = {1: np.uint8, 2: np.int8, 3: np.int16, 4: np.int32, 5: np.int64, 6: np.float64, 7: np.float32, 8: np.uint16}


def dtype_code(vocabulary: int | None) -> int:
    """16 bits without sign for vocabularies below 65500, else 32 bits."""
    return 8 if vocabulary is not None and vocabulary < 65500 else 4


class Index:
    """What an .idx file says; the arrays are mapped, so only what is looked at is read."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            head = f.read(HEAD)
        if head[:9] != MAGIC:
            raise ValueError(f"{path} is no index")
        version, code, n, docs = struct.unpack_from("<QBQQ", head, 9)
        if version != 1:
            raise ValueError(f"{path}: version {version}")
        self.dtype = np.dtype(DTYPES[code])
        size = os.path.getsize(path)
        part = lambda kind, many, at: np.memmap(path, kind, "r", at, many) if many else np.zeros(0, kind)
        self.lengths = part(np.int32, n, HEAD)
        self.pointers = part(np.int64, n, HEAD + 4 * n)
        self.documents = part(np.int64, docs, HEAD + 12 * n)
        rest = HEAD + 12 * n + 8 * docs
        self.modes = part(np.int8, n, rest) if size >= rest + n and n else None


class Sequences(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class TokenReader(DataSourceReader):
    def __init__(self, options: dict):
        self.prefix, self.ranges = options["path"], int(options.get("ranges", 8))

    def partitions(self) -> list[Sequences]:
        n = len(Index(f"{self.prefix}.idx").lengths)
        cuts = [n * k // self.ranges for k in range(self.ranges + 1)]
        return [Sequences(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if a < b] or [Sequences(0, 0)]

    def read(self, partition: Sequences) -> Iterator[tuple]:
        index = Index(f"{self.prefix}.idx")
        doc = np.searchsorted(index.documents, np.arange(partition.lo, partition.hi), "right") - 1
        raw = np.memmap(f"{self.prefix}.bin", np.uint8, "r") if os.path.getsize(f"{self.prefix}.bin") else np.zeros(0, np.uint8)
        for i in range(partition.lo, partition.hi):
            at, n = int(index.pointers[i]), int(index.lengths[i]) * index.dtype.itemsize
            mode = int(index.modes[i]) if index.modes is not None else None
            yield int(doc[i - partition.lo]), i, mode, raw[at : at + n].view(index.dtype).tolist()


class IndexedTokens(DataSource):
    @classmethod
    def name(cls) -> str:
        return "indexed_tokens"

    def schema(self) -> str:
        return "doc_id bigint, seq_no bigint, mode int, tokens array<bigint>"

    def reader(self, schema) -> TokenReader:
        return TokenReader(self.options)


def register(spark: SparkSession) -> None:
    ship(spark)
    spark.dataSource.register(IndexedTokens)


def write(df: DataFrame, prefix: str, code: int = 4, modes: bool = False) -> None:
    """IO10: (doc_id, seq_no, tokens[, mode]) in order of doc_id and seq_no."""
    kind, spark = np.dtype(DTYPES[code]), df.sparkSession
    mode = F.coalesce(F.col("mode"), F.lit(0)).cast("int") if modes else F.lit(0)
    rows = df.select("doc_id", "seq_no", F.coalesce("tokens", F.expr("cast(array() as array<bigint>)")).cast("array<bigint>").alias("tokens"), mode.alias("mode"))
    placed = stage(running(rows, ["doc_id", "seq_no"], {"begin": "size(tokens)"}), "sequences")
    n, total = placed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("tokens")), F.lit(0))).first()
    ends = stage(running(placed.groupBy("doc_id").agg((F.max("ord") + 1).alias("end")), ["doc_id"], ordinal="nr"), "documents")
    docs = ends.count() + 1
    for name, size in ((f"{prefix}.bin", total * kind.itemsize), (f"{prefix}.idx", HEAD + 12 * n + 8 * docs + n * modes)):
        with open(name, "wb") as f:
            f.truncate(size)
    with open(f"{prefix}.idx", "r+b") as f:
        f.write(MAGIC + struct.pack("<QBQQ", 1, code, n, docs))

    def put(f, at: int, values, kind) -> None:
        f.seek(at)
        f.write(np.asarray(values, kind).tobytes())

    def sequences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with open(f"{prefix}.bin", "r+b") as data, open(f"{prefix}.idx", "r+b") as index:
            for d in batches:
                for at, begin, tokens, m in zip(d["ord"], d["begin"], d["tokens"], d["mode"], strict=True):
                    put(data, begin * kind.itemsize, tokens, kind)
                    put(index, HEAD + 4 * at, [len(tokens)], np.int32)
                    put(index, HEAD + 4 * n + 8 * at, [begin * kind.itemsize], np.int64)
                    if modes:
                        put(index, HEAD + 12 * n + 8 * docs + at, [m], np.int8)
                yield pd.DataFrame({"n": [len(d)]})

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with open(f"{prefix}.idx", "r+b") as index:
            for d in batches:
                for nr, end in zip(d["nr"], d["end"], strict=True):
                    put(index, HEAD + 12 * n + 8 * (nr + 1), [end], np.int64)
                yield pd.DataFrame({"n": [len(d)]})

    ship(spark)
    placed.select("ord", "begin", "tokens", "mode").mapInPandas(sequences, "n long").agg(F.sum("n")).collect()
    ends.select("nr", "end").mapInPandas(documents, "n long").agg(F.sum("n")).collect()


def sliced(df: DataFrame, offset: int, length: int | None = None) -> DataFrame:
    """IO9: a part of every sequence; slices are contiguous."""
    n = F.lit(length) if length is not None else F.greatest(F.size("tokens") - offset, F.lit(0))
    return df.withColumn("tokens", F.slice("tokens", F.lit(offset + 1), n))


def merged(parts: list[DataFrame]) -> DataFrame:
    """IO11: one store after another; document and sequence numbers go on."""
    out, docs, seqs = None, 0, 0
    for p in parts:
        moved = p.withColumns({"doc_id": F.col("doc_id") + docs, "seq_no": F.col("seq_no") + seqs})
        top = p.agg(F.max("doc_id").alias("d"), F.max("seq_no").alias("s")).first()
        docs, seqs = docs + (top.d + 1 if top.d is not None else 0), seqs + (top.s + 1 if top.s is not None else 0)
        out = moved if out is None else out.unionByName(moved)
    return out
