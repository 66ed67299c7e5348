"""Blending, splitting and sampling of corpora."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .ordinal import running


def parse_blend(spec: Sequence[str]) -> tuple[list[str], list[float] | None]:
    """B1: [w, path, w, path, ...] or plain paths; a list that mixes both forms is an error."""
    if len(spec) % 2:
        return [str(x) for x in spec], None
    numbers = []
    for w in spec[::2]:
        try:
            numbers.append(float(w))
        except ValueError:
            numbers.append(None)
    if all(w is None for w in numbers):
        return [str(x) for x in spec], None
    if any(w is None for w in numbers):
        raise ValueError("weights and paths must alternate")
    return [str(x) for x in spec[1::2]], numbers


def normalized(weights: Sequence[float]) -> list[float]:
    """B2."""
    total = float(sum(weights))
    return [w / total for w in weights]


def _picks(w: np.ndarray, count: np.ndarray, start: int, stop: int, most: np.ndarray | float) -> np.ndarray:
    """The datasets of the places from start to stop; `count`, what stands before of each dataset, is carried on."""
    out = np.empty(stop - start, np.int32)
    for i in range(start, stop):
        out[i - start] = k = int(np.argmax(np.where(count < most, w * max(i, 1) - count, -np.inf)))
        count[k] += 1
    return out


def greedy_blend(weights: Sequence[float], size: int) -> np.ndarray:
    """At step i the dataset with the largest w max(i, 1) - count, the first of equals."""
    return _picks(np.asarray(weights, float), np.zeros(len(weights)), 0, size, np.inf)


def exhaustive_blend(sizes: Sequence[int]) -> np.ndarray:
    """The same over datasets that aren't spent, with weights in proportion to sizes; every sample once."""
    n = np.asarray(sizes, np.int64)
    return _picks(n / n.sum(), np.zeros(len(n)), 0, int(n.sum()), n)


def blend_index(spark: SparkSession, picks: np.ndarray) -> DataFrame:
    """(i, dataset, sample): which sample of which dataset stands at place i."""
    nth = np.zeros(len(picks), np.int64)
    for k in np.unique(picks):
        at = picks == k
        nth[at] = np.arange(at.sum())
    return spark.createDataFrame(list(zip(range(len(picks)), picks.tolist(), nth.tolist(), strict=True)), "i long, dataset int, sample long")


def blend_ranges(spark: SparkSession, sizes: Sequence[int], exhaustive: bool = False, step: int = 20_000) -> DataFrame:
    """B3, B4 of any size: (i, dataset, sample) with as many places as samples, weights in proportion to sizes.

    A place depends on all before it, so the driver walks through them, but keeps only the counts at the start of each
    `step` places; the executors make the rows of these ranges from there.
    """
    n = np.asarray(sizes, np.int64)
    total, most = int(n.sum()), n if exhaustive else np.full(len(n), np.inf)
    w, count, starts = n / max(total, 1), np.zeros(len(n)), []
    for at in range(0, total, step):
        starts.append((at, min(total, at + step), count.astype(np.int64).tolist()))
        _picks(w, count, *starts[-1][:2], most)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            for start, stop, before in d.itertuples(index=False):
                k = _picks(w, np.array(before, float), start, stop, most)
                nth = pd.Series(k).groupby(k).cumcount().to_numpy() + np.asarray(before, np.int64)[k]
                yield pd.DataFrame({"i": np.arange(start, stop), "dataset": k, "sample": nth})

    ship(spark)
    ranges = spark.createDataFrame(starts, "start long, stop long, before array<long>").repartition(max(1, len(starts)))
    return ranges.mapInPandas(run, "i long, dataset int, sample long")


def split_matrix(spec: str) -> list[tuple[float, float]]:
    """B5: "969, 30, 1" to the bounds of three splits."""
    x = [float(v) for v in re.findall(r"[.0-9]+", spec)][:3]
    x += [0.0] * (3 - len(x))
    cum = np.cumsum([0.0, *[v / sum(x) for v in x]])
    return [(float(a), float(b)) for a, b in zip(cum[:-1], cum[1:], strict=True)]


def intersected(a: Sequence[tuple[float, float]], b: Sequence[tuple[float, float]]) -> list[tuple[float, float] | None]:
    """Each split cut down to another one's bounds, None where nothing is left."""
    return [(lo, hi) if (lo := max(x[0], y[0])) < (hi := min(x[1], y[1])) else None for x, y in zip(a, b, strict=True)]


def range_split(df: DataFrame, order: Sequence[str], spec: str) -> DataFrame:
    """Df with `split` (0, 1, 2) by position; bounds are rounded half to even."""
    n = df.count()
    case = F.lit(None).cast("int")
    for k, (a, b) in reversed(list(enumerate(split_matrix(spec)))):
        case = F.when((F.col("ord") >= round(a * n)) & (F.col("ord") < round(b * n)), F.lit(k)).otherwise(case)
    return running(df, order).withColumn("split", case)


def requested(size: Column, weight: Column, margin: float = 0.5) -> Column:
    """Samples asked of a dataset, with a margin in per cent."""
    return F.ceil(F.ceil(size * weight) * (1 + margin / 100))


def legacy_bounds(n: int, spec: str) -> list[int]:
    """Cumulative half-even rounding, and all bounds moved by the total rounding error."""
    w = normalized([float(x) for x in re.split("[,/]", spec)][:3] + [0.0] * (3 - len(re.split("[,/]", spec)[:3])))
    at = [0]
    for x in w:
        at.append(at[-1] + int(round(x * float(n))))
    return [at[0], *[x - (at[-1] - n) for x in at[1:]]]


def interleaved(parts: Sequence[DataFrame], order: Sequence[str], stop: str = "first") -> DataFrame:
    """One row of each in turn, until the first (or all) are spent; adds `place`, `dataset`."""
    least = None
    if stop == "first":
        least = min(p.count() for p in parts)
    out = None
    for k, p in enumerate(parts):
        r = running(p, order).withColumn("dataset", F.lit(k)).withColumn("place", F.col("ord") * len(parts) + k)
        r = r.where(F.col("ord") < least) if least is not None else r
        out = r if out is None else out.unionByName(r)
    return out.drop("ord")


def sequential_batches(df: DataFrame, order: Sequence[str], batch: int, ranks: int, consumed: int = 0, drop_last: bool = True) -> DataFrame:
    """Global batch, rank and place of each row that isn't consumed yet."""
    n = df.count() - consumed
    r = running(df, order).where(F.col("ord") >= consumed).withColumn("ord", F.col("ord") - consumed)
    if drop_last:
        r = r.where(F.col("ord") < n // (batch * ranks) * batch * ranks)
    return r.withColumns({"batch": F.expr(f"ord div {batch * ranks}"), "rank": F.expr(f"(ord % {batch * ranks}) div {batch}"), "place": F.expr(f"ord % {batch}")}).drop("ord")


def pooled(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """The pool each row falls into."""
    return running(df, order).withColumn("pool", F.expr(f"ord div {size}")).drop("ord")


def rotation_offsets(lengths: Sequence[int], workers: int) -> list[int]:
    """The worker that a data set begins at: the rows of those before it, modulo the workers."""
    at = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, int)
    return [int(x) % max(1, workers) for x in at]


def dealt_to_workers(df: DataFrame, order: Sequence[str], workers: int, offset: int = 0) -> DataFrame:
    """Rows in turn to workers, the first to the one at `offset`."""
    return running(df, order).withColumn("worker", F.pmod(F.col("ord") + offset, F.lit(workers)).cast("int"))


def shuffle_buffered(df: DataFrame, order: Sequence[str], size: int, seed: int = 1) -> DataFrame:
    """Df with (part, place): each range of rows, in order, goes through a buffer of `size` rows.

    A row that comes takes the place of a random one, which leaves; what is left at the end leaves in random order. A
    task holds its buffer and a batch, no more, and is seeded by its number, so a repeat gives the same.
    """
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rng, held, place = np.random.default_rng([seed, part]), [], 0
        for d in batches:
            gone = []
            for row in d.itertuples(index=False, name=None):
                if len(held) < size:
                    held.append(row)
                    continue
                k = int(rng.integers(size))
                gone.append(held[k])
                held[k] = row
            yield pd.DataFrame(gone, columns=names).assign(part=part, place=range(place, place + len(gone)))
            place += len(gone)
        rest = [held[k] for k in rng.permutation(len(held))]
        yield pd.DataFrame(rest, columns=names).assign(part=part, place=range(place, place + len(rest)))

    ship(df.sparkSession)
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.mapInPandas(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + ", part int, place long")


def epoch_of(df: DataFrame, order: Sequence[str], length: int, epoch: int) -> DataFrame:
    """The rows of a virtual epoch: `length` places on, beginning anew behind the last row; adds `place`."""
    n = df.count()
    if not n:
        return df.withColumn("place", F.lit(0).cast("long"))
    first = epoch * length
    r = running(df, order)
    turns = F.sequence(F.lit(first // n).cast("long"), F.lit((first + length - 1) // n).cast("long"))
    return r.withColumn("_turn", F.explode(turns)).withColumn("place", F.col("_turn") * n + F.col("ord") - first).where((F.col("place") >= 0) & (F.col("place") < length)).drop("_turn", "ord")
