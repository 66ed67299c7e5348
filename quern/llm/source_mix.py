"""Mixing sources to target weights (operator 3) by weighted fair queueing, in DataFrame operations only.

A source's documents are queued in shuffled order (by digest of seed and id), up to `cap` times over. Every copy is an
entry with a virtual finish time: the words its source has queued up to and with it, divided by the source's share of
the mix. The entries of all sources are dealt out and sorted by finish time as one table, their words are summed in
that order, and the mix is cut where the sum reaches the total budget. The copy of a source in service when its target
is reached is queued in packets (at most PACKETS), each an entry of its own, so the cut falls inside a document and
every source comes within a packet of its target. Targets are the weights' shares of the budget; what a source could
not fill with `cap` times its words goes to the others by weight. Entries that begin behind their source's target are
not made: those before it hold the whole budget.

Row numbers and sums over sources, documents and entries are those of `operators.ordinal.running`: rows are dealt out
by range, ranges are summed, and the sums of the ranges before are added. So no source is gathered in a task.

Edge cases: a null text has no words; a source that is null is a source, last in order; no words at all give targets
of 0; ties of the digest go by row digest; repeated rows are queued each; null ids are shuffled by row digest; other
columns, whatever their names, are kept by `mixed_documents`; a lost task or a second run gives the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordinal import running
from ..session import shuffle_partitions
from .common import HEAVY, WORD, fresh, join_counted, row_digest, stage

#: Packets of the copy that is in service when its source has its target.
PACKETS = 1024

#: Copies of rows alike in every column are made so many at a time.
BLOCK = 1_000


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """(source, source_size, docs, nr, before, target, budget) from (source, source_size, docs).

    nr: the source's place; before: words of the sources before it. The level is where the water stands: sources whose
    cap lies below it are full, the others hold their weight's share. sizes is read twice and best a staged table.
    """
    # few sources need no more than one range, and so one file
    n = min(shuffle_partitions(sizes.sparkSession), 1 + sizes.count() // HEAVY)
    w = F.array(*[F.lit(float(x)) for x in weights])
    t = running(sizes.withColumn("none", F.col("source").isNull()), ["none", "source"], {"before": "source_size"}, "nr", n).drop("none")
    t = stage(t.withColumn("weight", F.get(w, F.col("nr") % len(weights))).withColumn("most", F.lit(cap) * F.col("source_size")).withColumn("level", F.col("most") / F.col("weight")), "sources")
    budget, all_weights = t.agg(F.sum("source_size"), F.sum("weight")).first()
    t = running(t, ["level", "nr"], {"full_before": "most", "weight_before": "weight"}, None, n)
    t = stage(t.withColumn("rate", (F.lit(budget).cast("long") - F.col("full_before")) / (F.lit(all_weights) - F.col("weight_before"))), "rates")
    water = t.where("rate <= level").agg(F.max("rate")).first()[0]
    share = F.lit(float(water)) * F.col("weight") if water is not None else F.col("most").cast("double")
    return t.select("source", "source_size", "docs", "nr", "before", F.least(F.col("most").cast("double"), share).alias("target"), F.lit(budget).cast("long").alias("budget"))


def fair_queue(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", *, weights: Sequence[float] = (1, 2, 3), cap: int = 3, seed: int = 1) -> DataFrame:
    """(id, source, rd, size, source_size, target, taken) of every row of docs.

    taken: words of the row in the mix, repeats counted; rd: digest of the whole row.
    """
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    items = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), size.alias("size"), row_digest(docs).alias("rd"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.concat(F.lit("null:"), F.col("rd").cast("string")))))
    items = stage(items.select("*", digest.alias("digest"), F.monotonically_increasing_id().alias("row")), "items")
    sizes = items.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = source_targets(stage(sizes, "sizes"), weights, cap)

    # nulls are no join keys, so a source goes by its name with a mark before it
    named = lambda df: df.withColumn("name", F.coalesce(F.concat(F.lit("+"), "source"), F.lit("-"))).drop("source")
    told = join_counted(named(items), stage(named(targets), "targets"), ["name"], "docs", items.count())
    queued = running(told.drop("name", "docs"), ["nr", "digest", "id", "rd", "row"], {"words_before": "size"}, None)
    queued = queued.withColumn("start", F.col("words_before") - F.col("before"))

    copies = queued.withColumn("r", F.explode(F.expr(f"sequence(0, {cap - 1})"))).withColumn("start", F.col("start") + F.col("r") * F.col("source_size"))
    copies = copies.where("size > 0 and start < target")
    width = F.when(F.col("start") + F.col("size") <= F.col("target"), F.col("size")).otherwise(F.ceil(F.col("size") / PACKETS))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.col("width")))
    entries = copies.withColumn("width", width.cast("long")).select("row", "nr", "start", "size", "target", "budget", "width", at.alias("at"))
    entries = entries.withColumn("words", F.least("width", F.col("size") - F.col("at"))).where("start + at < target")
    finish = (F.col("start") + F.col("at") + F.col("words")).cast("double") * F.col("budget") / F.col("target")
    queue = entries.select("row", "nr", "words", "budget", (F.col("start") + F.col("at")).alias("start"), finish.alias("finish"))
    queue = running(queue, ["finish", "nr", "start"], {"served": "words"}, None)
    taken = queue.select("row", F.greatest(F.lit(0), F.least(F.col("words"), F.col("budget") - F.col("served"))).alias("taken")).groupBy("row").agg(F.sum("taken").alias("taken"))
    out = told.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    return out.select("id", F.when(F.col("name") != "-", F.substring("name", 2, 1 << 30)).alias("source"), "rd", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """docs as often as the mix takes them, a row for each copy; the copy in service at the cut is cut at that word.

    Columns are those of docs. Rows that are alike in every column share what they are taken.
    """
    q = fair_queue(docs, id_col, source_col, text_col, **how).where("taken > 0")
    key, size, full, part, block, left = (fresh(docs, f"_{x}") for x in ("key", "size", "full", "part", "block", "left"))
    of = lambda i, d: F.struct(F.coalesce(i.cast("string"), F.lit("")), d)
    # only the copy at its source's cut is not whole
    plan = q.groupBy(of(F.col("id"), F.col("rd")).alias(key)).agg(F.max("size").alias(size), F.sum(F.expr("taken div size")).alias(full), F.max(F.expr("taken % size")).alias(part), F.count(F.lit(1)).alias("same"))
    plan = stage(plan, "plan")
    keyed = docs.withColumn(key, of(F.col(f"`{id_col}`"), row_digest(docs)))
    took = keyed.join(plan.where("same = 1").drop("same"), key).drop(key)
    many = plan.where("same > 1").drop("same")
    if not many.isEmpty():  # of rows alike in every column one stands for all; its copies are dealt out in blocks
        once = keyed.join(many.select(key), key, "left_semi").groupBy(key).agg(*[F.first(F.col(f"`{c}`")).alias(c) for c in docs.columns])
        blocks = once.join(many, key).drop(key).withColumn(block, F.explode(F.expr(f"sequence(0L, `{full}`, {BLOCK}L)")))
        blocks = blocks.withColumn(part, F.when(F.col(block) == 0, F.col(part)).otherwise(0)).withColumn(full, F.least(F.lit(BLOCK), F.col(full) - F.col(block)))
        took = took.unionByName(blocks.drop(block).repartition(shuffle_partitions(docs.sparkSession)))
    copies = took.withColumn(left, F.explode(F.expr(f"concat(array_repeat(`{size}`, cast(`{full}` as int)), filter(array(`{part}`), x -> x > 0))")))
    text = F.col(f"`{text_col}`").cast("string")
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col(left).cast("int")), "")
    kept = F.when(F.col(left) == F.col(size), F.col(f"`{text_col}`")).otherwise(cut)
    return copies.select(*[kept.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
