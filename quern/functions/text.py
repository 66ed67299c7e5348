"""Text functions: plain Column expressions, all inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's \w matches, in a form that Java and RE2 share.
W = r"[\p{L}\p{N}_]"
PUNCTUATION = r"[!-/:-@\[-`{-~]"


def words(text: Column) -> Column:
    """Lower-case words."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{W}+"), F.lit(0))


def replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    """Literal replacements, one after another."""
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def rewritten(text: Column, *pairs: tuple[str, str]) -> Column:
    """Regular-expression replacements, one after another."""
    return reduce(lambda c, p: F.regexp_replace(c, p[0], p[1]), pairs, text)


def general_cleaning(text: Column) -> Column:
    """runs of blanks, and line ends after a word, become one blank."""
    return F.regexp_replace(text, rf"({W})\n+ ?|  +", "$1 ")


# The detokenizers' replacements, in their order.
PTB = ((" '", "'"), (" \n", "\n"), ("\n ", "\n"), (" n't", "n't"), (" N ", "1 "), ("$ 1", "$1"), ("# 1", "#1"))
WIKI_NUMBERS = ((" @-@ ", "-"), (" @,@ ", ","), (" @.@ ", "."))
WIKI_STOPS = ((" : ", ": "), (" ; ", "; "), (" . ", ". "), (" ! ", "! "), (" ? ", "? "), (" , ", ", "))
WIKI_BRACKETS = (
    (r"\(\s*([^\)]*?)\s*\)", r"($1)"),
    (r"\[\s*([^\]]*?)\s*\]", r"[$1]"),
    (r"\{\s*([^\}]*?)\s*\}", r"{$1}"),
    (r"\"\s*([^\"]*?)\s*\"", r'"$1"'),
    (r"'\s*([^']*?)\s*'", r"'$1'"),
)
WIKI_REST = (("= = = =", "===="), ("= = =", "==="), ("= =", "=="), (" ° ", "°"), (" \n", "\n"), ("\n ", "\n"), (" N ", " 1 "), (" 's", "'s"))


def ptb_detokenized(text: Column) -> Column:
    """P1, treebank style."""
    return replaced(text, *PTB)


def wikitext_detokenized(text: Column) -> Column:
    """P1, encyclopedia style. The pattern with slashes is as odd as it was found."""
    t = rewritten(replaced(text, ("s '", "s'")), ("/' [0-9]/", "/'[0-9]/"))
    return replaced(rewritten(replaced(t, *WIKI_NUMBERS, *WIKI_STOPS), *WIKI_BRACKETS), *WIKI_REST)


def task_clean(text: Column) -> Column:
    """One line, single blanks, full stops closed up (three times over)."""
    return replaced(rewritten(replaced(text, ("\n", " ")), (r"\s+", " ")), *[(" . ", ". ")] * 3)


def normalized_answer(text: Column, punctuation: str = " ") -> Column:
    """Lower case, punctuation to a blank (or to nothing), no articles, single blanks."""
    t = F.split(F.regexp_replace(F.lower(text), PUNCTUATION, punctuation), r"\s+")
    return F.array_join(F.filter(t, lambda w: ~w.isin("", "a", "an", "the")), " ")


def caption_ok(text: Column) -> Column:
    """F16: no refusal at the start, no word eight times in a row, 50 to 3500 characters."""
    w = words(text)
    refusal = reduce(lambda a, b: a | b, [F.startswith(F.lower(text), F.lit(x)) for x in ("i cannot", "i can't", "i'm sorry", "i am sorry")])
    at = F.sequence(F.lit(1), F.greatest(F.size(w) - 7, F.lit(1)))
    run = (F.size(w) >= 8) & F.exists(F.transform(F.array(w), lambda x: F.exists(at, lambda i: F.size(F.array_distinct(F.slice(x, i, 8))) == 1)), lambda b: b)
    return ~refusal & ~run & F.length(text).between(50, 3500)


def sentence_ended(text: Column) -> Column:
    """A full stop unless the text ends in . ? or !"""
    return F.when(text.rlike(r"[?.!]$"), text).otherwise(F.concat(text, F.lit(".")))


def cut_to_bytes(text: Column, most: int = 20480) -> Column:
    """at most so many UTF-8 bytes, backed off to a whole character."""
    raw = F.encode(text, "UTF-8")
    part = F.substring(raw, 1, most)
    # continuation bytes at the cut: drop an unfinished character
    whole = F.try_validate_utf8 if hasattr(F, "try_validate_utf8") else None
    tries = [F.decode(part, "UTF-8")] if whole is None else [whole(F.substring(raw, 1, most - k).cast("string")) for k in range(4)]
    return F.when(F.octet_length(text) <= most, text).otherwise(F.coalesce(*tries))


def detox_text(text: Column) -> Column:
    """end markers go; blank texts become null; long ones are cut."""
    t = F.trim(F.replace(text, F.lit("<|endoftext|>"), F.lit("")))
    return F.when(F.length(t) > 0, cut_to_bytes(t))


def trailing_question_mark_dropped(text: Column) -> Column:
    """X11."""
    return F.regexp_replace(text, r"\?$", "")


def retrieval_tokens(text: Column) -> Column:
    """Runs of letters, digits and marks, or single other visible characters."""
    return F.regexp_extract_all(text, F.lit(r"[\p{M}\p{N}\p{L}]+|[^\p{C}\p{Z}]"), F.lit(0))


def format_reward(text: Column) -> Column:
    """1 for a think block followed by an answer block at the start, on one line each."""
    return F.when(text.rlike(r"^<think>[^\n]*?</think>\s*<answer>[^\n]*?</answer>"), 1.0).otherwise(0.0)


def answer_part(text: Column) -> Column:
    """The first answer block's inside, trimmed, or the whole text."""
    got = F.regexp_extract(text, r"<answer>([^\n]*?)</answer>", 1)
    return F.trim(F.when(text.rlike(r"<answer>[^\n]*?</answer>"), got).otherwise(text))
