"""Chat formatting of logged conversations (operator 5), in DataFrame operations only.

Logs snapshot a conversation after every turn, so most records are beginnings of longer ones. Every turn has the
rolling hash of the turns up to it: the exclusive or of 128-bit digests of (place, role, text), a running window over
the conversation's turns, so a conversation of any length costs one pass. A conversation whose last hash is the hash
of an inner turn of another is such a beginning and goes by an anti-join; of equal conversations the smallest id stays.
Both sides of the anti-join are distinct before it (counted map-side), so a first turn that a third of all logs share
is one row. What stays is gathered and rendered turn by turn.

Edge cases: turns come in order of (turn, role, text), nulls first, so ties and repeated turns are ordered; a null role
or text is not the same as an empty one for the collapse and renders as empty; rows with a null conversation id are
left out; an empty table gives none; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turn_prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, k, n, a, b) for every turn of (conv_id, x): its place, how many there are, and the rolling hash."""
    order = Window.partitionBy("conv_id").orderBy("x")
    t = turns.withColumn("k", F.row_number().over(order))
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    told = [F.coalesce(F.concat(F.lit("+"), F.col(f"x.{c}")), F.lit("-")) for c in ("role", "text")]
    lanes = [F.bit_xor(F.xxhash64(F.lit(seed), F.col("k"), *told)).over(so_far).alias(name) for name, seed in (("a", 11), ("b", 77))]
    return t.select("conv_id", "k", F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n"), *lanes)


def maximal_conversations(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns) of the conversations that are no beginning of another; turns: array of (turn, role, text)."""
    rows = chats.select(F.col(conv_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")).alias("x")).where("conv_id is not null")
    marks = stage(turn_prefix_hashes(rows), "turns")
    whole = marks.where("k = n").groupBy("n", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    inner = marks.where("k < n").select(F.col("k").alias("n"), "a", "b").distinct()
    stay = whole.join(inner, ["n", "a", "b"], "left_anti").select("conv_id")
    return rows.join(stay, "conv_id", "left_semi").groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("turns"))


def rendered(turns: str) -> F.Column:
    """The turns in tagged form, one block for each."""
    return F.expr(f"array_join(transform({turns}, x -> concat('{OPEN}', coalesce(x.role, ''), '\\n', coalesce(x.text, ''), '{CLOSE}\\n')), '')")


def format_chats(chats: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, n_turns, text) of every maximal conversation."""
    return maximal_conversations(chats, **columns).select("conv_id", F.size("turns").cast("long").alias("n_turns"), rendered("turns").alias("text"))
