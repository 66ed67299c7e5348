"""Filters and cascades over documents and urls (F*, A1, D11)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import url as U
from .ordinal import running


def first_match(*cases: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The name of the first case that holds."""
    chain = reduce(lambda c, x: c.when(F.coalesce(x[0], F.lit(False)), F.lit(x[1])), cases[1:], F.when(F.coalesce(cases[0][0], F.lit(False)), F.lit(cases[0][1])))
    return chain.otherwise(F.lit(otherwise))


def first_of_each(df: DataFrame, key: str, order: str) -> DataFrame:
    """Df with `first`, whether the row is its key's first by `order` (unique). The minimum is taken map-side."""
    least = df.groupBy(key).agg(F.min(order).alias("_least")).withColumnRenamed(key, "_key")
    return df.join(least, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn("first", F.col(order) == F.col("_least")).drop("_key", "_least")


def url_reasons(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", strict: bool = True) -> DataFrame:
    """(id, url, reason); the first of domain, extension, short, malformed, duplicate, or keep."""
    url = F.col("url")
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    tests = first_match((U.domain_blocked(url), "domain"), (U.extension_blocked(url, strict), "extension"), (U.too_short(url), "short"), (U.malformed(url), "malformed"), otherwise="keep")
    judged = base.withColumn("reason", tests)
    firsts = judged.where("reason = 'keep'").groupBy("url").agg(F.min("id").alias("_least")).withColumnRenamed("url", "_url")
    both = judged.join(firsts, (F.col("url") == F.col("_url")) & (F.col("reason") == "keep"), "left")
    late = (F.col("reason") == "keep") & (F.col("id") != F.col("_least"))
    return both.select("id", "url", F.when(late, "duplicate").otherwise(F.col("reason")).alias("reason"))


def min_token_ok(text: Column, tokens: int = 128, chars: int = 8 * 128) -> Column:
    """F8: short texts need so many tokens; longer ones are never tokenised."""
    return F.when(F.length(text) < chars, F.size(T.words(text)) >= tokens).otherwise(True)


def cleanup_reason(text: Column, lang: Column, language: str = "en") -> Column:
    """F9 after text repair: other languages, then too few tokens."""
    return first_match((lang != language, "other_language"), (~min_token_ok(text), "small"), otherwise="keep")


def counted(df: DataFrame, reason: str = "reason", text: str = "text") -> DataFrame:
    """A1: rows and characters by reason."""
    return df.groupBy(reason).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length(text)).alias("n_chars"))


def task_outcomes(docs: DataFrame, tasks: Sequence[str] = ("remove_512", "remove_256_javascript", "remove_512_non_english"), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Docs with `task` (the first that fires), `filtered`, and `cleaned` (text of what passes).

    ftfy_fix_text hides general_cleaning when both are asked for.
    """
    t, lang = F.col(text_col), F.col(lang_col)
    known = {
        "remove_512": F.length(t) < 512,
        "remove_256_javascript": (F.length(t) < 256) & F.lower(t).contains("javascript"),
        "remove_512_non_english": (F.length(t) < 512) & (lang != "en"),
    }
    cases = [(known[x], x) for x in tasks if x in known]
    df = docs.withColumn("task", first_match(*cases)) if cases else docs.withColumn("task", F.lit(None).cast("string"))
    cleaned = T.general_cleaning(t) if "general_cleaning" in tasks and "ftfy_fix_text" not in tasks else t
    filtered = F.col("task").isNotNull() | t.isNull()
    return df.withColumn("filtered", filtered).withColumn("cleaned", F.when(~filtered, cleaned))


def with_ids(docs: DataFrame, prefix: str, order: Sequence[str]) -> DataFrame:
    """prefix-%010d by position, from 1."""
    return running(docs, order).withColumn("adlr_id", F.concat(F.lit(f"{prefix}-"), F.lpad((F.col("ord") + 1).cast("string"), 10, "0"))).drop("ord")


def least_half(scored: DataFrame, score: str, id_col: str) -> DataFrame:
    """the half (rounded down) of scored rows with the least score; ties by id."""
    some = scored.where(F.col(score).isNotNull())
    nr = running(some, [score, id_col])
    return nr.where(F.col("ord") < F.lit(some.count() // 2)).drop("ord")


def score_summary(scored: DataFrame, score: str, at: float = 0.5) -> DataFrame:
    """how many, mean, deviation (of the population) and how many at the threshold or above."""
    s = F.col(score).cast("double")
    return scored.where(s.isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(s), 9).alias("mean"), F.round(F.stddev_pop(s), 9).alias("std"), F.sum((s >= at).cast("int")).cast("long").alias("n_over"))
