"""Conversation operators (V-A*): nested arrays of (role, content), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: What stands for an image in rendered text.
VISION = "<|vision_start|><|image_pad|><|vision_end|>"


def gathered(chats: DataFrame) -> DataFrame:
    """(conv_id, m): the turns of a conversation in order, as an array of (turn, role, content)."""
    x = F.struct("turn", "role", F.col("text").alias("content"))
    return chats.groupBy("conv_id").agg(F.sort_array(F.collect_list(x)).alias("m"))


def alpaca_unified(df: DataFrame, instruction: str, query: str, response: str) -> DataFrame:
    """V-A1: prompt, response and d_len; empty parts are left out and the join character isn't counted."""
    parts = F.filter(F.array(F.col(instruction), F.col(query)), lambda x: F.length(F.coalesce(x, F.lit(""))) > 0)
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    size = F.aggregate(parts, F.lit(0), lambda a, x: a + F.length(x)) + F.length(F.coalesce(F.col(response), F.lit("")))
    return df.withColumns({"prompt": F.array(message("user", F.array_join(parts, "\n"))), "response": F.array(message("assistant", F.col(response))), "d_len": size.cast("long")})


def sharegpt_unified(convs: DataFrame) -> DataFrame:
    """V-A2: system (first system message), prompt, response, d_len; broken alternation keeps the row with nothing in it."""
    first = F.array_position(F.transform("m", lambda x: x["role"]), "system")
    rest = F.when(first > 0, F.concat(F.slice("m", F.lit(1), (first - 1).cast("int")), F.slice("m", (first + 1).cast("int"), F.size("m")))).otherwise(F.col("m"))
    c = convs.select("conv_id", F.when(first > 0, F.element_at("m", first.cast("int"))["content"]).otherwise("").alias("system"), rest.alias("r"))
    turn = F.transform("r", lambda x, i: F.when(i % 2 == 0, x["role"].isin("user", "observation")).otherwise(x["role"].isin("assistant", "function")))
    ok = (F.size("r") % 2 == 0) & F.forall(turn, lambda b: b)
    c = c.withColumn("r", F.when(ok, F.transform("r", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))).otherwise(F.expr("cast(array() as array<struct<role:string,content:string>>)")))
    d_len = F.aggregate("r", F.lit(0), lambda a, x: a + F.length(x["content"])).cast("long")
    return c.select("conv_id", "system", F.slice("r", F.lit(1), F.greatest(F.size("r") - 1, F.lit(0))).alias("prompt"), F.when(F.size("r") > 0, F.slice("r", F.size("r"), F.lit(1))).otherwise(F.col("r")).alias("response"), d_len.alias("d_len"))


def rendered(m: Column, prefix: str = "", separator: str = "\n", user: str = "User: {}", assistant: str = "Assistant: {}") -> Column:
    """V-A4: turns by template; user and assistant turns alternate, pairs are parted by the separator."""

    def fill(form: str, x: Column) -> Column:
        a, b = form.split("{}")
        return F.concat(F.lit(a), x, F.lit(b))

    one = F.transform(m, lambda x, i: F.concat(F.when((i % 2 == 0) & (i > 0), F.lit(separator)).otherwise(""), F.when(i % 2 == 0, fill(user, x["content"])).otherwise(fill(assistant, x["content"])), F.lit("\n")))
    return F.concat(F.lit(prefix), F.array_join(one, ""))


def chatml(m: Column, system: str = "You are a helpful assistant.") -> Column:
    """V-A5: tagged form; a default system unless the first turn is one; image marks become the vision triple."""
    body = F.array_join(F.transform(m, lambda x: F.concat(F.lit("<|im_start|>"), x["role"], F.lit("\n"), x["content"], F.lit("<|im_end|>\n"))), "")
    head = F.when(F.get(m, F.lit(0))["role"] == "system", "").otherwise(f"<|im_start|>system\n{system}<|im_end|>\n")
    return F.replace(F.concat(head, body), F.lit("<image>"), F.lit(VISION))


def budgeted(source: Column, target: Column, cutoff: int | Column) -> tuple[Column, Column]:
    """V-A6: how much of source and target stays within cutoff: short sides first, else in proportion."""
    cutoff = F.lit(cutoff) if isinstance(cutoff, int) else cutoff
    share = F.floor(cutoff.cast("double") * (target / F.greatest(source + target, F.lit(1))))
    room = F.when(target * 2 < cutoff, cutoff).when(source * 2 < cutoff, cutoff - source).otherwise(share)
    t = F.least(room, target)
    return F.least(F.greatest(cutoff - t, F.lit(0)), source).cast("long"), t.cast("long")


def supervised(pairs: Column, most: int, on_prompt: bool = False, eos: int | None = None, ignore: int = -100) -> Column:
    """V-A7: (ids, labels, loss_mask) of an array of (source, target) id arrays within `most`.

    One fold over the turns deals the budget out (the rule of V-A6 on what is left) and leaves each turn's two lengths;
    the rest is slices. eos asks for the efficient form: a later turn's source begins with it as a label, and one
    stands at the end.
    """
    # what is used, and the (source, target) lengths kept so far; a turn with no room left ends the fold
    begin = F.struct(F.lit(int(eos is not None)).cast("long").alias("used"), F.expr("cast(array() as array<struct<s:bigint,t:bigint>>)").alias("kept"))

    def turn(a: Column, x: Column) -> Column:
        s, t = budgeted(F.size(x["source"]), F.size(x["target"]), F.lit(most).cast("long") - a["used"])
        grown = F.struct((a["used"] + s + t).alias("used"), F.concat(a["kept"], F.array(F.struct(s.alias("s"), t.alias("t")))).alias("kept"))
        return F.when(a["used"] >= most, a).otherwise(grown)

    kept = F.aggregate(pairs, begin, turn, lambda a: a["kept"])
    cut = F.transform(F.array(kept), lambda k: F.transform(F.slice(pairs, F.lit(1), F.size(k)), lambda x, i: F.struct(F.slice(x["source"], F.lit(1), k[i]["s"].cast("int")).alias("s"), F.slice(x["target"], F.lit(1), k[i]["t"].cast("int")).alias("t"))))[0]

    def hidden(s: Column, i: Column) -> Column:
        blank = lambda n: F.array_repeat(F.lit(ignore), n.cast("int"))
        if on_prompt:
            return s
        if eos is None:
            return blank(F.size(s))
        # a later turn's mark stands even where its source was cut to nothing
        return F.when(i > 0, F.concat(F.array(F.lit(eos)), blank(F.greatest(F.size(s) - 1, F.lit(0))))).otherwise(blank(F.size(s)))

    tail = F.array(F.lit(eos)) if eos is not None else F.expr("cast(array() as array<int>)")
    ids = F.concat(F.flatten(F.transform(cut, lambda x: F.concat(x["s"], x["t"]))), tail)
    labels = F.concat(F.flatten(F.transform(cut, lambda x, i: F.concat(hidden(x["s"], i), x["t"]))), tail)
    return F.struct(ids.alias("ids"), labels.alias("labels"), F.transform(labels, lambda x: (x != ignore).cast("int")).alias("loss_mask"))


def first_pair(m: Column) -> tuple[Column, Column]:
    """V-A8: the first user and the first assistant content."""
    get = lambda role: F.get(F.filter(m, lambda x: x["role"] == role), F.lit(0))["content"]
    return get("user"), get("assistant")


def fitted_rounds(m: Column, limit: int) -> Column:
    """V-A9: whole question-answer rounds from the start while their characters fit."""
    sums = F.aggregate(m, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x["content"]))))
    fit = F.size(F.filter(sums, lambda s: s <= limit)) - 1
    return F.slice(m, F.lit(1), fit - F.pmod(fit, F.lit(2)))


def context_rows(chats: DataFrame, role: str = "assistant", joiner: str = " [SEP] ") -> DataFrame:
    """V-A10: for each turn of the role but the first turn: what came before, joined, and the turn itself."""
    g = gathered(chats).select("conv_id", F.col("m").alias("all"), F.posexplode("m").alias("i", "x")).where((F.col("i") > 0) & (F.col("x.role") == role))
    before = F.array_join(F.transform(F.slice("all", F.lit(1), F.col("i")), lambda x: x["content"]), joiner)
    return g.select("conv_id", F.col("x.turn").alias("turn"), before.alias("context"), F.col("x.content").alias("response"))


def role_mapped(role: Column, text: Column) -> tuple[Column, Column]:
    """Human and gpt by their usual names; image marks with their line ends become the vision triple."""
    name = F.when(role == "human", "user").when(role == "gpt", "assistant").otherwise(role)
    return name, F.regexp_replace(text, "\n?<image>\n?", VISION)


def question_prompt(m: Column) -> Column:
    """Question: ... Answer: ... lines of earlier rounds."""
    return F.array_join(F.transform(m, lambda x, i: F.when(i % 2 == 0, F.concat(F.lit("Question: "), x["content"])).otherwise(F.concat(F.lit(" Answer: "), x["content"], F.lit("\n")))), "")


def dialogue_examples(dialogues: DataFrame, topics: DataFrame, seen_data: bool = False) -> DataFrame:
    """V-A11: from (id, topic, context array, knowledge, response): (id, topic, instance, dialog, known).

    Without a passage, with brackets in it or without its topic in it a row goes (the last two not for seen data). Rows
    of a topic in topics(topic) are prompts of that topic (known); the others go if the knowledge is of more than 20
    words or begins with It or This.
    """
    last = F.slice("context", F.greatest(F.size("context") - 2, F.lit(1)), F.lit(3))
    k = F.col("knowledge")
    fine = k != "no_passages_used"
    if not seen_data:
        fine = fine & ~k.rlike(r"[()]") & F.contains(k, F.col("topic"))
    instance = F.concat(F.lit("( "), F.element_at(last, -1), F.lit(" ) "), F.col("topic"), F.lit(" => "), k)
    dialog = F.concat(F.lit("") if seen_data else F.concat(F.lit("( "), F.col("topic"), F.lit(" ) ")), F.array_join(last, " "))
    d = dialogues.where(fine & (F.size("context") > 0)).join(topics.select("topic").distinct().withColumn("known", F.lit(True)), "topic", "left")
    d = d.withColumn("known", F.coalesce("known", F.lit(False)))
    short = F.size(F.filter(F.split(F.trim(k), r"\s+"), lambda w: w != "")) <= 20
    return d.where(F.col("known") | (short & ~k.rlike("^([Ii]t|[Tt]his)"))).select("id", "topic", instance.alias("instance"), dialog.alias("dialog"), "known")


def preference_row(prompt: Column, chosen: Column, rejected: Column) -> tuple[Column, Column, Column]:
    """V-A12: the tagged prompt, open for an answer, and both answers with their end mark."""
    tagged = F.concat(F.lit("<|im_start|>user\n"), prompt, F.lit("<|im_end|>\n<|im_start|>assistant\n"))
    return tagged, *(F.concat(x, F.lit("<|im_end|>\n")) for x in (chosen, rejected))
