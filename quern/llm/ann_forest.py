"""Approximate nearest neighbours (operator 4): a forest of random-projection trees, searched through one queue.

Trees are grown on at most SAMPLE rows (those with the smallest id digests): every node splits its points at the
median along the line between two centres that a few steps of 2-means find. Every row of the table is then indexed
with its leaf in each tree. A query walks all trees through one priority queue, which pops nodes by the largest
distance to a split plane on their path, until the leaves popped hold `share` of the sample; rows in those leaves are
its candidates. Queries and rows meet in a join on (tree, leaf): only candidates' distances are computed, block by
block, and each block returns the best k of a query. These are merged, each row once, and ranked by exact Euclidean
distance in double precision on the vectors as they came.

The share that a recall takes depends on the data, so it is measured: the forest's own sample is searched by brute
force for PROBES of its points, and the share is the least in whose leaves TARGET of their nearest k lie. On vectors
without cluster structure in 64 dimensions that is more than half of all rows, on clustered vectors a few percent.
A query that finds fewer than k is searched again in every leaf of one tree, which is a search of all rows; so is
every query of a table too small for trees.

Hot leaves: a leaf's rows (and the queries that visit it) are dealt out over as many slices as its count asks for, so
a block has about ROWS rows and QUERIES queries however many vectors are equal.

Edge cases: vectors that are null, zero, empty or hold null or non-finite components take no part, nor do those of
another length than the most common one, nor null ids; ties go to the smaller id; with k candidates or fewer all are
returned; rows that repeat an id are each candidates of other ids, and of a query's several vectors the least counts;
a query without candidates has no rows; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, drawn, stage

SAMPLE, LEAF, PROBES, TARGET = 16_384, 40, 128, 0.97
ROWS, QUERIES = 20_000, 2_000


class Forest:
    """Trees as heaps: node n has children 2n and 2n + 1; depth 0 is one leaf."""

    def __init__(self, sample: np.ndarray, trees: int, seed: int, k: int = 10):
        rng = np.random.default_rng(seed)
        self.depth = max(0, int(np.log2(max(1, len(sample)) / LEAF))) if len(sample) > 1000 else 0
        self.middle = sample.mean(axis=0) if len(sample) else np.zeros(0)
        sample = sample - self.middle
        self.w = np.zeros((trees, 1 << self.depth, sample.shape[1]))
        self.b = np.zeros((trees, 1 << self.depth))
        for t in range(trees):
            todo = [(np.arange(len(sample)), 1, 0)]
            while todo:
                at, node, d = todo.pop()
                if d == self.depth or not len(at):
                    continue
                w = self._line(sample[at], rng)
                way = sample[at] @ w
                self.w[t, node], self.b[t, node] = w, np.median(way)
                right = way >= self.b[t, node]
                todo += [(at[~right], 2 * node, d + 1), (at[right], 2 * node + 1, d + 1)]
        where = self._leaves(sample)
        self.members = [[np.flatnonzero(where[:, t] == leaf) for leaf in range(1 << self.depth)] for t in range(trees)]
        self.n = len(sample)
        self.share = self._share(sample, where, rng, k) if self.depth else 1.0

    @staticmethod
    def _line(x: np.ndarray, rng) -> np.ndarray:
        if len(x) < 2:
            return rng.standard_normal(x.shape[1])
        p, q = x[rng.choice(len(x), 2, replace=False)]
        for _ in range(6):
            left = ((x - p) ** 2).sum(axis=1) < ((x - q) ** 2).sum(axis=1)
            if left.all() or not left.any():
                break
            p, q = x[left].mean(axis=0), x[~left].mean(axis=0)
        w = p - q
        size = np.linalg.norm(w)
        return w / size if size > 0 else rng.standard_normal(x.shape[1])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree."""
        return self._leaves(x - self.middle)

    def _leaves(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.w)), np.int32)
        for t in range(len(self.w)):
            node = np.ones(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + (np.einsum("ij,ij->i", x, self.w[t, node]) >= self.b[t, node])
            out[:, t] = node - (1 << self.depth)
        return out

    def _popped(self, q: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf) in the order in which one queue over all trees pops the leaves of a query."""
        margin = (np.einsum("tnd,d->tn", self.w, q) - self.b).tolist()
        first, heap = 1 << self.depth, [(0.0, t, 1) for t in range(len(self.w))]
        while heap:
            far, t, node = heapq.heappop(heap)
            while node < first:  # the near side has no worse a place in the queue, so it is followed at once
                m = margin[t][node]
                near = 2 * node + (m >= 0)
                heapq.heappush(heap, (max(far, abs(m)), t, near ^ 1))
                node = near
            yield t, node - first

    def visited(self, q: np.ndarray, share: float) -> list[tuple[int, int]]:
        """The leaves that the queue pops until they hold `share` of the sample."""
        seen, count, want, out = np.zeros(self.n, bool), 0, share * self.n, []
        for t, leaf in self._popped(q - self.middle):
            out.append((t, leaf))
            at = self.members[t][leaf]
            count += int((~seen[at]).sum())
            seen[at] = True
            if count >= want:
                break
        return out

    def _share(self, sample: np.ndarray, where: np.ndarray, rng, k: int) -> float:
        """The least share of the sample whose leaves hold TARGET of the probes' nearest k."""
        needs = []
        for i in rng.choice(len(sample), min(PROBES, len(sample)), replace=False).tolist():
            d = ((sample - sample[i]) ** 2).sum(axis=1)
            d[i] = np.inf
            missing = set(np.argpartition(d, k)[:k].tolist())
            seen, count = np.zeros(self.n, bool), 0
            for t, leaf in self._popped(sample[i]):
                at = self.members[t][leaf]
                count += int((~seen[at]).sum())
                seen[at] = True
                found = [j for j in missing if where[j, t] == leaf]
                needs += [count / self.n] * len(found)
                missing.difference_update(found)
                if not missing:
                    break
        return float(np.quantile(needs, TARGET))


def _vectors(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best(r: np.ndarray, row: np.ndarray, i: np.ndarray, s: np.ndarray, k: int) -> tuple:
    order = np.lexsort((row, i, s, r))
    r, row, i, s = r[order], row[order], i[order], s[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    return tuple(x[rank < k] for x in (r, row, i, s))


def nearest_of_block(qid: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, x: np.ndarray, middle: np.ndarray, k: int) -> tuple:
    """(query number, row, id, distance) of the nearest k rows of a block for each query.

    A product of matrices, about the data's middle, leaves out what can't be among the nearest; its error is bounded by
    the vectors' own lengths. Distances are then those of the vectors as they are.
    """
    best = tuple(np.zeros(0, d) for d in (np.int64, np.int64, np.int64, np.float64))
    qc, xc = q - middle, x - middle
    own, norm = (qc**2).sum(axis=1), (xc**2).sum(axis=1)
    for a in range(0, len(q), 128):
        qa = slice(a, a + 128)
        found = []
        for lo in range(0, len(x), 2048):
            xs = slice(lo, lo + 2048)
            d2 = own[qa, None] + norm[None, xs] - 2 * (qc[qa] @ xc[xs].T)
            d2[qid[qa, None] == ids[None, xs]] = np.inf
            m = d2.shape[1]
            kth = np.partition(d2, k - 1, axis=1)[:, k - 1] if m > k else np.full(len(d2), np.inf)
            slack = 1e-12 * (own[qa] + norm[xs].max())
            r, c = np.nonzero(np.isfinite(d2) & (d2 <= (kth + slack)[:, None]))
            if len(r):
                found.append((r, rows[xs][c], ids[xs][c], np.sqrt(((q[qa][r] - x[xs][c]) ** 2).sum(axis=1))))
            if sum(len(f[0]) for f in found) > 100_000:
                found = [_best(*(np.concatenate(v) for v in zip(*found, strict=True)), k)]
        if found:
            r, row, i, s = _best(*(np.concatenate(v) for v in zip(*found, strict=True)), k)
            best = tuple(np.concatenate(v) for v in zip(best, (r + a, row, i, s), strict=True))
    return best


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>) of the rows that take part, but for their length."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.expr("id is not null and v is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x <> 0)")
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(fine)


def _index(rows: DataFrame, held) -> DataFrame:
    """(row, id, v, leaf) with the leaf of each tree."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = held.value.leaves(_vectors(b.column(1)))
            at = pa.array(np.arange(0, leaf.size + 1, leaf.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(at, pa.array(leaf.ravel()))], ["id", "v", "leaf"])

    got = arrow_map(rows, indexed, "id long, v array<double>, leaf array<int>")
    return stage(got.withColumn("row", F.monotonically_increasing_id()), "index")


def _visits(queries: DataFrame, held, share: float) -> DataFrame:
    """(id, v, tree, leaf) of the leaves that each query visits."""

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, q in enumerate(_vectors(b.column(1))):
                at = np.array(held.value.visited(q, share), np.int32).reshape(-1, 2)
                same = np.full(len(at), i)
                yield pa.RecordBatch.from_arrays([b.column(0).take(same), b.column(1).take(same), pa.array(at[:, 0]), pa.array(at[:, 1])], ["id", "v", "tree", "leaf"])

    return arrow_map(queries.select("id", "v"), walked, "id long, v array<double>, tree int, leaf int")


def _candidates(index: DataFrame, visits: DataFrame, held, k: int) -> DataFrame:
    """(query_id, row, vec_id, score): the nearest k of each block of rows and queries that share a leaf."""
    placed = index.select("row", "id", "v", F.posexplode("leaf").alias("tree", "leaf"))
    n_rows = index.select(F.posexplode("leaf").alias("tree", "leaf")).groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
    n_queries = visits.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("m"))
    # one row for each leaf of the forest, at most trees x SAMPLE / LEAF
    plan = n_queries.join(n_rows, ["tree", "leaf"]).select("tree", "leaf", F.ceil(F.col("n") / ROWS).cast("int").alias("of_rows"), F.ceil(F.col("m") / QUERIES).cast("int").alias("of_queries"))
    plan = F.broadcast(stage(plan, "leaves"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(plan, ["tree", "leaf"]).withColumn("a", F.pmod(F.xxhash64("row"), F.col("of_rows")).cast("int")).withColumn("b", every("of_queries"))
    right = visits.join(plan, ["tree", "leaf"]).withColumn("b", F.pmod(F.xxhash64("id"), F.col("of_queries")).cast("int")).withColumn("a", every("of_rows"))

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "row", "vec_id", "score"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
        if not rows.num_rows or not queries.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in kinds], names)
        qid = queries["id"].to_numpy()
        r, row, i, s = nearest_of_block(qid, _vectors(queries["v"]), rows["id"].to_numpy(), rows["row"].to_numpy(), _vectors(rows["v"]), held.value.middle, k)
        return pa.Table.from_arrays([pa.array(v, t) for v, t in zip((qid[r], row, i, s), kinds, strict=True)], names)

    key = ["tree", "leaf", "a", "b"]
    both = left.select(*key, "row", "id", "v").groupBy(*key).cogroup(right.select(*key, "id", "v").groupBy(*key))
    return both.applyInArrow(search, "query_id long, row long, vec_id long, score double")


def nearest(vectors: DataFrame, is_query: str, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 10, trees: int = 8, share: float | None = None, seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows for which the SQL condition is_query (on `id`) holds.

    share: the share of all rows that a query looks at; None measures what a recall of TARGET takes.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == common.n)
    x = np.array([r.v for r in drawn(rows, SAMPLE, "id", "v").collect()], np.float64)
    forest = Forest(x, trees if len(x) > 1000 else 1, seed, k)
    held = spark.sparkContext.broadcast(forest)
    index = _index(rows, held)
    queries = stage(index.where(is_query).groupBy("id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own")), "queries")
    n = max(1, min(queries.count() // 64, 1 + int(spark.conf.get("spark.sql.shuffle.partitions"))))
    visits = stage(_visits(queries.repartition(n, "id"), held, forest.share if share is None else share), "visits")
    found = stage(_candidates(index, visits, held, k), "found")
    most = F.least(F.lit(k), F.lit(index.count()) - F.col("own"))
    seen = found.groupBy("query_id").agg(F.size(F.collect_set("row")).alias("n"))
    short = queries.join(seen, queries["id"] == seen["query_id"], "left").where(F.coalesce("n", F.lit(0)) < most).select("id", "v")
    short = stage(short, "short")
    if not short.isEmpty():  # every leaf of the first tree: all rows
        every = short.withColumn("tree", F.lit(0)).withColumn("leaf", F.explode(F.expr(f"sequence(0, {(1 << forest.depth) - 1})")))
        found = found.unionByName(_candidates(index, every, held, k))
    once = found.groupBy("query_id", "row").agg(F.first("vec_id").alias("vec_id"), F.first("score").alias("score"))
    ranked = once.selectExpr("query_id", "cast(row_number() over (partition by query_id order by score, vec_id) as int) as rank", "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
