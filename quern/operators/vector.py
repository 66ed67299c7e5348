"""Exact vector search and its bookkeeping."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ship
from .nearest import BLOCK_NUMBERS, Vectors


def inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def _best_of(batches: Iterator[pa.RecordBatch], held: Broadcast, k: int) -> Iterator[pa.RecordBatch]:
    """The k best of a task's rows for each query of the block."""
    ids, vectors = held.value.columns
    q = None
    for b in batches:
        q = q or Vectors(vectors, k, b.column(0).type)
        q.meet(b.column(0), b.column(1))
    for at, found, scores in q.found() if q else ():
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), found, scores], ["query_id", "vec_id", "score"])


def blocks(queries: DataFrame, vec_col: str, block: int) -> int:
    """How many blocks keep each at about `block` queries and BLOCK_NUMBERS numbers."""
    n, numbers = queries.agg(F.count(F.lit(1)), F.sum(F.greatest(F.size(vec_col), F.lit(0)).cast("long"))).first()
    return max(1, -(-n // block), -(-(numbers or 0) // BLOCK_NUMBERS))


def block_of_queries(queries: DataFrame, i: int, n: int) -> Broadcast:
    """The i-th of n blocks, dealt by a hash of the first column, for Python workers."""
    held = queries.where(F.pmod(F.xxhash64(queries.columns[0]), F.lit(n)) == i).toArrow().combine_chunks().to_batches()
    return queries.sparkSession.sparkContext.broadcast(held[0] if held else pa.RecordBatch.from_pylist([], to_arrow_schema(queries.schema)))


def top_inner_products(queries: DataFrame, rows: DataFrame, k: int, block: int = 16_384, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """V1, V2: (query_id, rank, vec_id, score), the k largest inner products, ties to the smaller id.

    Stated queries against all rows, in blocks of about `block` broadcast queries; every task keeps k rows of its own
    for each query of a block before anything is shuffled. Queries times rows by nature, so pairs are matrix products;
    the few that may be among the k best are summed in order (`nearest`), and scores are those of SQL to the last bit.
    """
    spark = queries.sparkSession
    ship(spark)
    q = queries.select(F.col(id_col).alias("query_id"), F.col(vec_col).alias("q"))
    src = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"))
    kinds = [df.schema[0].dataType.simpleString() for df in (q, src)]
    n, out = blocks(q, "q", block), None
    for i in range(n):
        s = src.mapInArrow(partial(_best_of, held=block_of_queries(q, i, n), k=k), f"query_id {kinds[0]}, vec_id {kinds[1]}, score double")
        out = s if out is None else out.union(s)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def banned(neighbours: DataFrame, labels: DataFrame, keep: int) -> DataFrame:
    """Neighbours with their query's own label go, `keep` of the rest stay, in order; (query_id, ids) is filled up with -1."""
    a, b = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql")), labels.select("vec_id", F.col("label").alias("vl"))
    left = neighbours.join(a, "query_id").join(b, "vec_id").where("ql <> vl")
    left = left.withColumn("nr", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).where(F.col("nr") <= keep)
    g = left.groupBy("query_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("nr", "vec_id"))), lambda x: x["vec_id"]).alias("ids"))
    return g.select("query_id", F.concat("ids", F.array_repeat(F.lit(-1).cast("bigint"), F.lit(keep) - F.size("ids"))).alias("ids"))


def continued(neighbours: DataFrame, n_chunks: int, retrieved: int = 2) -> DataFrame:
    """Each neighbour chunk and those after it (modulo the number of chunks); a missing neighbour stays missing."""
    return neighbours.select("query_id", "vec_id", F.explode(F.sequence(F.lit(0), F.lit(retrieved - 1))).alias("k")).withColumn("chunk", F.when(F.col("vec_id") >= 0, F.pmod(F.col("vec_id") + F.col("k"), F.lit(n_chunks))))


def merged_shards(a: DataFrame, b: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """V3: both shards; a shared id is an error."""
    if not a.join(b.select(id_col), id_col, "left_semi").isEmpty():
        raise ValueError("embedding shards overlap")
    return a.unionByName(b)


def block_of(ordinal: Column, size: int) -> Column:
    """V8."""
    return F.floor(ordinal / size).cast("bigint")


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """V9: rows that only one of two builds has."""
    return a.exceptAll(b).withColumn("side", F.lit("a")).unionByName(b.exceptAll(a).withColumn("side", F.lit("b")))


def cells(vectors: DataFrame, k: int = 16, seed: int = 1, sample: int = 50_000, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """V4, V5: (vec_id, cell): coarse cells by k-means, trained on at most `sample` rows, every row assigned."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    x = vectors.select(F.col(id_col).alias("vec_id"), array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=10).fit(x.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample))
    return model.transform(x).select("vec_id", F.col("prediction").alias("cell"))


def embedded(df: DataFrame, encoder: Callable[[list[str]], np.ndarray], id_col: str, text_col: str, batch: int = 64) -> DataFrame:
    """(id, embedding): encoder gets texts in batches sorted by length (so padding stays small) and gives a row for each.

    The model's forward pass is the caller's; a null text is an empty one.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            texts = d["text"].fillna("").tolist()
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            out: list = [None] * len(texts)
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                for i, v in zip(some, np.asarray(encoder([texts[i] for i in some]), np.float32), strict=True):
                    out[i] = v
            yield pd.DataFrame({"id": d["id"], "embedding": out})

    return df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInPandas(run, f"id {kind}, embedding array<float>")


class FlatIndex:
    """Exact search."""

    def add(self, rows: DataFrame) -> FlatIndex:
        self.rows = rows
        return self

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        return top_inner_products(queries, self.rows, k)


class CellIndex:
    """Search in the query's own coarse cell; cells are trained on a bounded sample, every row is assigned."""

    def __init__(self, n: int = 16):
        self.n = n

    def add(self, rows: DataFrame) -> CellIndex:
        self.rows = rows
        self.cells = cells(rows, self.n)
        return self

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        of = self.rows.join(self.cells, "vec_id").select("vec_id", F.col("embedding").alias("v"), "cell")
        q = of.join(queries.select("vec_id"), "vec_id", "left_semi").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), "cell")
        s = of.join(q, "cell").select("query_id", "vec_id", inner(F.col("q"), F.col("v")).alias("score"))
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


INDEXES: dict[str, Callable] = {"flat": FlatIndex, "cells": CellIndex}


def index_of(name: str, **how):
    """An index by the name of its kind."""
    if name not in INDEXES:
        raise ValueError(f"no index {name}; there are {sorted(INDEXES)}")
    return INDEXES[name](**how)
