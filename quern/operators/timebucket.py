"""Time buckets over events (S1 to S16). The same expressions run on batch and streaming tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parsed_times(t: Column) -> Column:
    """S1: "5,6,7" to whole seconds; a number is its whole part."""
    return F.transform(F.filter(F.split(t, ","), lambda x: F.trim(x) != ""), lambda x: F.floor(F.trim(x).cast("double")).cast("int"))


def bucketed(events: DataFrame, seconds: int, horizon: int | None = None, truncated: bool = True, key: str = "key", t: str = "t", value: str = "value", order: str = "ord") -> DataFrame:
    """(key, bucket, value): the last value of each bucket; events after the horizon go, or their key with them.

    t counts seconds from the key's start; the last bucket takes what lies on the horizon itself.
    """
    e = events.select(F.col(key).alias("key"), F.col(t).alias("t"), F.col(value).alias("value"), F.col(order).alias("ord"))
    if horizon is not None:
        if not truncated:
            bad = e.where(F.col("t") > horizon).select("key").distinct()
            e = e.join(bad, "key", "left_anti")
        e = e.where(F.col("t") <= horizon)
        last = (horizon - 1) // seconds
        e = e.withColumn("bucket", F.least(F.floor(F.col("t") / seconds), F.lit(last)))
    else:
        e = e.withColumn("bucket", F.floor(F.col("t") / seconds))
    return e.groupBy("key", "bucket").agg(F.max_by("value", F.struct("t", "ord")).alias("value"))


def gap_filled(buckets: DataFrame, n: Column | int, margin: int | None = None, silence: str = "</silence>") -> DataFrame:
    """A row for every bucket up to n (or to the last event and margin); empty ones hold silence."""
    last = buckets.groupBy("key").agg(F.max("bucket").alias("last"))
    size = F.lit(n) if isinstance(n, int) else n
    upto = F.least(size, F.col("last") + margin + 1) if margin is not None else size
    grid = last.select("key", F.explode(F.sequence(F.lit(0).cast("bigint"), (upto - 1).cast("bigint"))).alias("bucket"))
    return grid.join(buckets, ["key", "bucket"], "left").select("key", "bucket", F.coalesce("value", F.lit(silence)).alias("value"))


def run_weights(filled: DataFrame, first: float = 0.5, repeated: float = 0.1, spoken: float = 1.0, silence: str = "</silence>") -> DataFrame:
    """Silence right after silence weighs least."""
    before = F.lag("value").over(Window.partitionBy("key").orderBy("bucket"))
    quiet = F.col("value") == silence
    return filled.withColumn("weight", F.when(~quiet, spoken).when(before == silence, repeated).otherwise(first))


def spliced(blocks: Column, counts: Column) -> Column:
    """Each block as often as its count says."""
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), counts.alias("n")), lambda x: F.array_repeat(x["b"], x["n"])))


def adaptive_rate(duration: Column) -> Column:
    """S8."""
    return F.when(duration >= 160, 1).when(duration >= 64, 2).otherwise(4)


def even_spaced(n: Column, k: int) -> Column:
    """K places from 0 to n - 1, cut to whole numbers."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * ((n - 1) / F.lit(float(max(k - 1, 1))))).cast("int"))


def rate_spaced(duration: Column, fps: int, source_fps: int, total: Column) -> Column:
    """Frames at every 1/fps seconds, within the clip, each once."""
    n = F.greatest(F.floor(duration * fps), F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.least(F.floor(i * source_fps / F.lit(fps)), total - 1).cast("int")))


def frame_times(frames: Column, fps: float) -> Column:
    """S11."""
    return F.transform(F.array_sort(F.array_distinct(frames)), lambda f: f / F.lit(fps))


def resized(w: Column, h: Column, factor: int = 28, least: int = 56 * 56, most: int = 28 * 28 * 1280) -> tuple[Column, Column]:
    """Both sides to multiples of factor, area within the budget, aspect kept; null if one side is over 200 times the other."""
    f = F.lit(float(factor))
    near = lambda x: F.greatest(F.bround(x / f) * f, f)
    shrink, grow = F.sqrt(w * h / F.lit(float(most))), F.sqrt(F.lit(float(least)) / (w * h))
    big, small = near(w) * near(h) > most, near(w) * near(h) < least
    side = lambda x: F.when(big, F.greatest(F.floor(x / shrink / f) * f, f)).when(small, F.ceil(x * grow / f) * f).otherwise(near(x))
    ok = F.greatest(w, h) / F.least(w, h) <= 200
    return F.when(ok, side(w).cast("int")), F.when(ok, side(h).cast("int"))


def patch_grid(t: Column, h: Column, w: Column) -> Column:
    """(t, h, w) of every patch, row by row, in 2 x 2 blocks."""
    n = t * h * w
    place = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.floor(i / (h * w)).cast("int").alias("t"), F.floor(i % (h * w) / w).cast("int").alias("h"), (i % w).cast("int").alias("w")))
    keyed = F.transform(place, lambda p: F.struct(p["t"].alias("k0"), F.floor(p["h"] / 2).alias("k1"), F.floor(p["w"] / 2).alias("k2"), (p["h"] % 2).alias("k3"), (p["w"] % 2).alias("k4"), p.alias("p")))
    return F.transform(F.sort_array(keyed), lambda x: x["p"])


def video_frames(total: Column, most: int, duration: Column, fps: float) -> Column:
    """An even number of frames."""
    return (F.floor(F.floor(F.least(total.cast("double"), F.lit(float(most)), duration * fps)) / 2) * 2).cast("int")
