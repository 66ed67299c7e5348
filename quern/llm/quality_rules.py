"""Quality rules with risk-controlled thresholds (operator 6), in DataFrame operations only.

Measures are counted on whole texts. Fixed base rules reject first. Then each rule of RULES has a ladder of cutoffs,
lenient to strict, fixed in advance. All rules go down their ladders together, in STEPS steps, and at each step the
joint verdict (a document goes if any rule rejects it) is tested in every stratum (language): the labelled good
documents tell how many it would reject falsely, k of n. A step holds if the exact binomial bound shows a
false-rejection rate below `risk`: P(Bin(n, risk) <= k) <= level / strata. Steps are tested in order up to the first
that fails, which needs no correction; the strata share the level (Bonferroni). So with probability 1 - level the
rules together reject at most `risk` of the good documents of every stratum. Without enough labels no step holds and
only the base rules reject. These are fixed by contract: good documents that fail them are left out of the bound.

Edge cases: a null text has no words and fails the base rules; a null stratum is a stratum of its own; labels of
unknown documents, null labels and other columns are ignored; repeated labels count each; without labels only the base
rules reject; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, stage

SYMBOLS = "[#*$%&|<>]"
#: Steps in which the ladders of all rules go from lenient to strict.
STEPS = 10
#: name, measure in thousandths (rejected above a cutoff), cutoffs from lenient to strict
RULES: tuple[tuple[str, str, tuple[int, ...]], ...] = (
    ("symbols", "1000 * n_symbols / greatest(n_words, 1)", (2000, 1000, 700, 500, 300, 200, 150, 100, 70, 50)),
    ("repeats", "1000 * n_repeat_words / greatest(n_words, 1)", (200, 180, 160, 140, 120, 100, 80, 60, 40)),
    ("dup_lines", "1000 * n_dup_lines / greatest(n_lines, 1)", (900, 700, 500, 400, 300, 200, 150)),
    ("upper", "1000 * n_upper / greatest(word_chars, 1)", (900, 700, 500, 400, 300, 250, 200, 150)),
    ("marks", "1000 * n_marks / greatest(n_words, 1)", (2000, 1000, 700, 500, 300, 200, 100, 50)),
    ("same_next", "1000 * n_same_next / greatest(n_words, 1)", (800, 600, 400, 300, 200, 150, 100, 70)),
    ("long_words", "1000 * word_chars / greatest(n_words, 1)", (40000, 30000, 20000, 16000, 14000, 12000)),
)


def let(value: F.Column, use: Callable[[F.Column], F.Column]) -> F.Column:
    """use(value) with value computed once, not for every turn of a lambda inside."""
    return F.transform(F.array(value), use)[0]


def repeat_words(hashes: F.Column, window: int = 5) -> F.Column:
    """How many words lie in windows of `window` words that occur twice or more, from the words' hashes."""

    def covered(s: F.Column) -> F.Column:
        twice = F.filter(s, lambda e, k: F.get(s, k - 1)["g"].eqNullSafe(e["g"]) | F.get(s, k + 1)["g"].eqNullSafe(e["g"]))
        places = F.sort_array(F.transform(twice, lambda e: e["i"]))
        return let(places, lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1), x + window) - x)), F.lit(0), lambda a, x: a + x))

    def count(g: F.Column) -> F.Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(pairs, covered))

    def grams(w: F.Column) -> F.Column:
        g = F.transform(F.sequence(F.lit(1), F.size(w) - window + 1), lambda i: F.xxhash64(F.slice(w, i, window)))
        return F.when(F.size(w) < window, F.lit(0)).otherwise(let(g, count))

    return let(hashes, grams)


def without(c: F.Column, pattern: str) -> F.Column:
    return F.length(F.regexp_replace(c, pattern, ""))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_marks, n_same_next)."""
    src = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    bare = F.btrim("t", F.lit(SPACES))
    words = F.when(bare == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+", -1))
    hashes = F.transform(words, lambda x: F.xxhash64(x))
    lines = F.filter(F.split("t", "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    both = let(hashes, lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r"), F.aggregate(F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))), lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda a, x: a + x).alias("s")))
    counted = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d")))
    m = src.select("id", "stratum", "t", both.alias("b"), counted.alias("c"))
    whole = F.length("t")
    return m.select(
        "id", "stratum", F.col("b.n").cast("long").alias("n_words"), without(F.col("t"), r"[\x20\x09-\x0D]+").cast("long").alias("word_chars"),
        (whole - without(F.col("t"), SYMBOLS)).cast("long").alias("n_symbols"), F.col("c.d").cast("long").alias("n_dup_lines"), F.col("b.r").cast("long").alias("n_repeat_words"),
        F.col("c.n").cast("long").alias("n_lines"), (whole - without(F.col("t"), r"\p{Lu}+")).cast("long").alias("n_upper"), (whole - without(F.col("t"), "!+")).cast("long").alias("n_marks"), F.col("b.s").cast("long").alias("n_same_next"),
    )


#: log P(Bin(n, p) <= k) <= log(level), summed from the logarithms of the terms
_HOLDS = """
aggregate(sequence(0, k), named_struct('t', cast(0 as double), 'm', cast(-1e300 as double), 's', cast(0 as double)), (a, j) ->
  named_struct(
    't', case when j = 0 then n * ln(1 - {p}) else a.t + ln((n - j + 1) / j) + ln({p} / (1 - {p})) end,
    'm', greatest(a.m, case when j = 0 then n * ln(1 - {p}) else a.t + ln((n - j + 1) / j) + ln({p} / (1 - {p})) end),
    's', a.s * exp(a.m - greatest(a.m, case when j = 0 then n * ln(1 - {p}) else a.t + ln((n - j + 1) / j) + ln({p} / (1 - {p})) end))
         + exp((case when j = 0 then n * ln(1 - {p}) else a.t + ln((n - j + 1) / j) + ln({p} / (1 - {p})) end) - greatest(a.m, case when j = 0 then n * ln(1 - {p}) else a.t + ln((n - j + 1) / j) + ln({p} / (1 - {p})) end))),
  a -> a.m + ln(a.s) <= ln({level}))
"""


def ladder(cuts: tuple[int, ...]) -> list[float]:
    """The cutoff of every step."""
    return [float(cuts[s * len(cuts) // STEPS]) for s in range(STEPS)]


def first_rejection(rules=RULES) -> F.Column:
    """The first step at which any rule rejects, STEPS if none does."""
    steps = [F.coalesce(F.array_position(F.array(*[F.expr(f"{e} > {c}D") for c in ladder(cuts)]), True), F.lit(0)) for _, e, cuts in rules]
    return F.least(*[F.when(s > 0, s - 1).otherwise(STEPS) for s in steps], F.lit(STEPS)).cast("int")


def thresholds(m: DataFrame, labels: DataFrame, risk: float = 0.02, level: float = 0.05, rules=RULES) -> DataFrame:
    """(stratum, step): the strictest step of the ladders that holds there; strata where none does have no row."""
    good = labels.where("quality = 1").select(F.col("doc_id").alias("id"))
    seen = m.where("not base_failed").join(good, "id").withColumn("first", first_rejection(rules))
    counts = seen.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("first") <= s).cast("int").alias(f"k{s}") for s in range(STEPS)])
    counts = stage(counts, "strata")
    share = level / max(1, counts.count())
    # k counts of good documents: beyond the risk's own mean a step can't hold, so the sum stays short
    ok = F.when(F.expr(f"k > n * {risk!r}D"), F.lit(False)).otherwise(F.expr(_HOLDS.format(p=f"{risk!r}D", level=f"{share!r}D")))
    tests = counts.select("stratum", "n", F.inline(F.array(*[F.struct(F.lit(s).alias("step"), F.col(f"k{s}").alias("k")) for s in range(STEPS)]))).withColumn("ok", ok)
    fails = F.coalesce(F.min(F.when(~F.col("ok"), F.col("step"))), F.lit(STEPS))
    return tests.groupBy("stratum").agg((fails - 1).alias("step")).where("step >= 0")


def base_failed() -> F.Column:
    return F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", *, risk: float = 0.02, level: float = 0.05, rules=RULES) -> DataFrame:
    """The measures of every row with base_failed, kept, and failed_rules (names)."""
    m = stage(measures(docs, id_col, text_col, stratum_col).withColumn("base_failed", base_failed()), "measures")
    told = stage(thresholds(m, labels, risk, level, rules), "thresholds").select(F.col("stratum").alias("_s"), "step")
    small = told.count() <= 10_000  # strata; a number for each
    got = m.join(F.broadcast(told) if small else told, F.col("stratum").eqNullSafe(F.col("_s")), "left")
    over = lambda e, cuts: F.expr(e) > F.get(F.array(*[F.lit(c) for c in ladder(cuts)]), F.col("step"))
    failed = F.array_compact(F.array(*[F.when(~F.col("base_failed") & F.coalesce(over(e, cuts), F.lit(False)), F.lit(name)) for name, e, cuts in rules]))
    got = got.withColumn("failed_rules", failed)
    return got.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_s", "step")
