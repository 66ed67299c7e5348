"""Jobs in blocks that can be taken up again (V7): a block of rows is one folder, written whole or not at all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def block_ranges(rows: int, size: int) -> list[tuple[str, int, int]]:
    """(name, first, after the last) of blocks of `size` rows; names have equally many digits."""
    digits = len(str(max(rows, 1))) + 1
    cuts = [(i, min(rows, i + size)) for i in range(0, rows, size)]
    return [(f"{a:0{digits}d}-{b:0{digits}d}", a, b) for a, b in cuts]


def _path(spark: SparkSession, text: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def missing_blocks(spark: SparkSession, folder: str, rows: int, size: int, valid: Callable[[DataFrame], bool] | None = None) -> list[tuple[str, int, int]]:
    """The blocks that are not there. One that was not finished or that `valid` rejects is deleted and so missing."""
    out = []
    for name, a, b in block_ranges(rows, size):
        p = _path(spark, f"{folder}/{name}")
        fs = _files(spark, p)
        there = fs.exists(p)
        ok = there and fs.exists(_path(spark, f"{folder}/{name}/_SUCCESS"))
        if ok and valid is not None:
            try:
                ok = valid(spark.read.parquet(f"{folder}/{name}"))
            except Exception:  # a block that can't be read is corrupt, whatever the reason
                ok = False
        if there and not ok:
            fs.delete(p, True)
        if not ok:
            out.append((name, a, b))
    return out


def run_blocks(df: DataFrame, folder: str, size: int, work: Callable[[DataFrame], DataFrame], ordinal: str = "ord", valid: Callable[[DataFrame], bool] | None = None) -> list[str]:
    """work() over the rows of each missing block of df, whose `ordinal` counts from 0; the names of the blocks made."""
    rows = df.count()
    todo = missing_blocks(df.sparkSession, folder, rows, size, valid)
    for name, a, b in todo:
        work(df.where((F.col(ordinal) >= a) & (F.col(ordinal) < b))).write.mode("overwrite").parquet(f"{folder}/{name}")
    return [name for name, _, _ in todo]


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """All blocks as one table."""
    return spark.read.parquet(f"{folder}/*")


def dealt_to(todo: list[tuple[str, int, int]], workers: int) -> list[list[tuple[str, int, int]]]:
    """Missing blocks in turn to workers, None standing for the places of the last round that stay empty."""
    rounds = -(-len(todo) // workers)
    return [[todo[k * workers + w] if k * workers + w < len(todo) else None for k in range(rounds)] for w in range(workers)]
