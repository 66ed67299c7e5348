"""Text, retrieval and classification metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalized_answer


def token_overlap(guess: Column, answer: Column) -> tuple[Column, Column, Column]:
    """Shared words (with repeats), words of the guess, words of the answer, after normalising."""
    g, a = (F.filter(F.split(normalized_answer(x), " "), lambda w: w != "") for x in (guess, answer))
    count = lambda s, w: F.size(F.filter(s, lambda x: x == w))
    both = F.aggregate(F.array_intersect(g, a), F.lit(0), lambda s, w: s + F.least(count(g, w), count(a, w)))
    return both, F.size(g), F.size(a)


def f1(guess: Column, answer: Column) -> Column:
    """A2: null (left out) for an empty answer, 0 for an empty guess or no shared word."""
    both, g, a = token_overlap(guess, answer)
    score = 2.0 * both / F.greatest(g + a, F.lit(1))
    return F.when(a == 0, F.lit(None).cast("double")).when((g == 0) | (both == 0), 0.0).otherwise(score)


def exact_match(guess: Column, answer: Column) -> Column:
    """A3."""
    return normalized_answer(guess, "") == normalized_answer(answer, "")


def contains_answer(text: Column, answer: Column) -> Column:
    """A4: the answer's words in a row in the text's."""
    pad = lambda x: F.concat(F.lit(" "), normalized_answer(x), F.lit(" "))
    return F.contains(pad(text), pad(answer))


def hit_curve(hits: DataFrame, most: int) -> DataFrame:
    """A5: from (query_id, rank, hit): for each k the share of queries with a hit at rank k or before."""
    first = hits.groupBy("query_id").agg(F.min(F.when(F.col("hit"), F.col("rank"))).alias("first"))
    n = F.array(*[F.struct(F.lit(k).alias("k")) for k in range(1, most + 1)])
    return first.select("query_id", "first", F.inline(n)).groupBy("k").agg(F.round(F.avg(F.coalesce((F.col("first") <= F.col("k")).cast("double"), F.lit(0.0))), 9).alias("accuracy"))


def perplexity(loss: Column, tokens: Column) -> Column:
    """A7."""
    return F.exp(F.least(F.lit(20.0), loss / (tokens - 1)))


def all_correct(df: DataFrame, key: str, correct: str) -> DataFrame:
    """Whether every position of a key is right."""
    return df.groupBy(key).agg(F.bool_and(correct).alias("all_correct"))


def threshold_sweep(df: DataFrame, score: str, label: str, steps: int = 100) -> DataFrame:
    """The accuracy of each threshold k / steps."""
    at = F.array(*[F.struct(F.lit(k).alias("step")) for k in range(steps)])
    x = df.select(F.col(score).alias("s"), F.col(label).alias("y"), F.inline(at))
    right = ((F.col("s") >= F.col("step") / float(steps)).cast("int") == F.col("y")).cast("double")
    return x.groupBy("step").agg(F.avg(right).alias("accuracy"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The best accuracy, at the lowest of equal thresholds."""
    return sweep.orderBy(F.desc("accuracy"), "step").limit(1)


def ensemble(predictions: DataFrame, models: int) -> DataFrame:
    """A10: from (uid, cls, score): the class with the largest mean score, the first of equals."""
    m = predictions.groupBy("uid", "cls").agg((F.sum("score") / models).alias("mean"))
    return m.groupBy("uid").agg(F.max_by("cls", F.struct("mean", -F.col("cls"))).alias("cls"), F.max("mean").alias("mean"))


def relative_difference(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """Sum |a - b| over sum |a|, 0 where that is 0, to three places."""
    x, d = F.sum(F.abs(a)), F.sum(F.abs(F.col(a) - F.col(b)))
    return pairs.groupBy(*keys).agg(F.round(F.when(x == 0, 0.0).otherwise(d / F.greatest(x, F.lit(1e-300))), 3).alias("difference"))


def in_batch_ranks(batched: DataFrame, score: Column) -> DataFrame:
    """(batch, q, rank) of every query's own item among the items of its batch, by (batch, q, qv, v) rows.

    score is an expression on qv and the other's v, given as `other`. A batch is small: it is what one step compares.
    """
    items = batched.select("batch", F.col("q").alias("item"), F.col("v").alias("other"))
    s = batched.select("batch", "q", "qv").join(items, "batch").withColumn("s", score)
    own = F.max(F.when(F.col("q") == F.col("item"), F.struct("s", (-F.col("item")).alias("i")))).over(Window.partitionBy("batch", "q"))
    return s.withColumn("own", own).groupBy("batch", "q").agg((F.count_if(F.struct("s", (-F.col("item")).alias("i")) > F.col("own")) + 1).alias("rank"))


def rank_summary(ranks: DataFrame, *tops: int) -> DataFrame:
    """The mean rank and the share of queries at rank k or before, for each k."""
    return ranks.agg(F.round(F.avg("rank"), 9).alias("mean_rank"), *[F.round(F.avg((F.col("rank") <= k).cast("double")), 9).alias(f"top{k}") for k in tops])
