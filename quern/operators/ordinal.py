"""Row numbers and running sums over a whole table without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffle_partitions, stage


def running(df: DataFrame, order: Sequence[str], sums: dict[str, str] | None = None, ordinal: str | None = "ord", ranges: int | None = None) -> DataFrame:
    """df with `ordinal` (from 0) and, for each name in sums, the sum of that SQL expression over all rows before.

    Rows are dealt out by range of `order` (which must be unique), every range is summed, the sums of the ranges before
    are added to running sums inside the range. The ranges' sums are one row per partition. ranges: how many there are,
    if not as many as shuffle partitions; each with rows is a file of the staged table.
    """
    want = {ordinal: "1"} if ordinal else {}
    want |= sums or {}
    n = ranges or shuffle_partitions(df.sparkSession)
    dealt = df.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id())
    dealt = stage(dealt, "ranges")
    per = dealt.groupBy("_range").agg(*[F.sum(F.expr(e)).alias(f"_t_{k}") for k, e in want.items()])
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("_range", *[F.coalesce(F.sum(f"_t_{k}").over(ahead), F.lit(0)).alias(f"_t_{k}") for k in want])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.select("*", *[F.coalesce(F.sum(F.expr(e)).over(inside), F.lit(0)).alias(f"_i_{k}") for k, e in want.items()])
    out = out.join(F.broadcast(per), "_range")  # at most n rows
    return out.select(*df.columns, *[(F.col(f"_i_{k}") + F.col(f"_t_{k}")).alias(k) for k in want])
