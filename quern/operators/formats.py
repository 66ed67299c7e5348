"""Conversation formats and chat templates by name (V-A3, V-A4), and rows for trainers."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chat as C


@dataclass(frozen=True)
class Format:
    """V-A3: how a data set's columns and tags are named; `kind` is alpaca or sharegpt."""

    kind: str
    columns: Mapping[str, str]
    tags: Mapping[str, str] = field(default_factory=dict)


#: Tags where a configuration names none.
TAGS = {"role_tag": "role", "content_tag": "content", "user_tag": "user", "assistant_tag": "assistant", "observation_tag": "observation", "function_tag": "function", "system_tag": "system"}


def formats(config: str) -> dict[str, Format]:
    """The formats of a JSON text {name: {format, columns, tags}}; an unknown kind is an error."""
    out = {}
    for name, x in json.loads(config).items():
        if x["format"] not in ("alpaca", "sharegpt"):
            raise ValueError(f"{name}: no format {x['format']}")
        out[name] = Format(x["format"], x["columns"], TAGS | x.get("tags", {}))
    return out


def unified(df: DataFrame, form: Format, id_col: str) -> DataFrame:
    """(id_col, system, prompt, response, d_len) of a data set in one of the formats."""
    if form.kind == "alpaca":
        c = form.columns
        none = F.lit("")
        named = df.select(id_col, F.col(c["prompt"]).alias("_p"), (F.col(c["query"]) if "query" in c else none).alias("_q"), F.col(c["response"]).alias("_r"), (F.col(c["system"]) if "system" in c else none).alias("system"))
        return C.alpaca_unified(named, "_p", "_q", "_r").select(id_col, "system", "prompt", "response", "d_len")
    t = form.tags
    roles = {t[f"{x}_tag"]: x for x in ("user", "assistant", "observation", "function", "system")}
    role = lambda x: F.coalesce(*[F.when(x[t["role_tag"]] == k, F.lit(v)) for k, v in roles.items()], F.lit("unknown"))
    m = F.transform(F.col(form.columns["messages"]), lambda x: F.struct(role(x).alias("role"), x[t["content_tag"]].alias("content")))
    return C.sharegpt_unified(df.select(F.col(id_col).alias("conv_id"), m.alias("m"))).withColumnRenamed("conv_id", id_col)


@dataclass(frozen=True)
class Template:
    """V-A4: {} stands for the content; begins: whether the beginning token stands before all ("prefix") or each question ("user")."""

    user: str = "{}"
    assistant: str = "{}"
    system: str = "{}"
    separator: str = ""
    default_system: str = ""
    begins: str = ""
    stop: str = ""
    efficient_eos: bool = False
    system_in_user: bool = False


_LLAMA3 = Template(
    user="<|start_header_id|>user<|end_header_id|>\n\n{}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
    system="<|start_header_id|>system<|end_header_id|>\n\n{}<|eot_id|>",
    begins="prefix",
    stop="<|eot_id|>",
)
_CHATML = Template(
    user="<|im_start|>user\n{}<|im_end|>\n<|im_start|>assistant\n",
    system="<|im_start|>system\n{}<|im_end|>\n",
    separator="\n",
    default_system="You are a helpful assistant.",
    stop="<|im_end|>",
)
# The templates' names and strings.
TEMPLATES: dict[str, Template] = {
    "empty": Template(efficient_eos=True),
    "default": Template(user="Human: {}\nAssistant:", system="{}\n", separator="\n"),
    "alpaca": Template(
        user="### Instruction:\n{}\n\n### Response:\n",
        separator="\n\n",
        default_system="Below is an instruction that describes a task. Write a response that appropriately completes the request.\n\n",
    ),
    "baichuan": Template(user="<reserved_102>{}<reserved_103>", efficient_eos=True),
    "baichuan2": Template(user="<reserved_106>{}<reserved_107>", efficient_eos=True),
    "llama2": Template(user="[INST] {} [/INST]", system="<<SYS>>\n{}\n<</SYS>>\n\n", begins="user", system_in_user=True),
    "llama2_zh": Template(
        user="[INST] {} [/INST]",
        system="<<SYS>>\n{}\n<</SYS>>\n\n",
        default_system="You are a helpful assistant. 你是一个乐于助人的助手。",
        begins="user",
        system_in_user=True,
    ),
    "llama3": _LLAMA3,
    "llama3.1": _LLAMA3,
    "mistral": Template(user="[INST] {} [/INST]", begins="prefix"),
    "qwen": _CHATML,
    "qwen2-vl": _CHATML,
    "deepseek": Template(user="User: {}\n\nAssistant:", system="{}\n\n", begins="prefix"),
    "deepseek3": Template(user="<｜User｜>{}<｜Assistant｜>", begins="prefix"),
}


def register(name: str, template: Template) -> None:
    """Another template; a name that is taken is an error."""
    if name in TEMPLATES:
        raise ValueError(f"there is a template {name}")
    TEMPLATES[name] = template


def _filled(form: str, content: Column) -> Column:
    before, after = form.split("{}")
    return F.concat(F.lit(before), content, F.lit(after))


def rendered_turns(m: Column, template: str, bos: str = "<s>", eos: str = "</s>") -> Column:
    """V-A4: the text of every turn of an array of (role, content); of an odd list the first is the system's.

    Turn 0 is prefix, system and question, a later question has the separator before it, and an answer ends with eos
    unless the template leaves that to the packing (efficient_eos).
    """
    t = TEMPLATES[template]
    odd = F.size(m) % 2 == 1
    system = F.when(odd, F.get(m, F.lit(0))["content"]).otherwise(t.default_system)
    system = F.when(F.coalesce(F.length(system), F.lit(0)) > 0, _filled(t.system, system)).otherwise("")
    rest = F.when(odd, F.slice(m, F.lit(2), F.greatest(F.size(m) - 1, F.lit(0)))).otherwise(m)
    first = F.lit(bos if t.begins == "prefix" else "")
    each = F.lit(bos if t.begins == "user" else "")

    def turn(x: Column, i: Column) -> Column:
        head = F.when(i == 0, first).when(i % 2 == 0, F.lit(t.separator)).otherwise("")
        if t.system_in_user:
            question = F.concat(head, each, _filled(t.user, F.concat(F.when(i == 0, system).otherwise(""), x["content"])))
        else:
            question = F.concat(head, F.when(i == 0, system).otherwise(""), each, _filled(t.user, x["content"]))
        answer = F.concat(_filled(t.assistant, x["content"]), F.lit("" if t.efficient_eos else eos))
        return F.when(i % 2 == 0, question).otherwise(answer)

    return F.transform(rest, turn)


def padded_batch(ids: Column, length: Column, value: int, left: bool = False) -> Column:
    """Ids filled up to the longest of its batch."""
    fill = F.array_repeat(F.lit(value), F.greatest(length - F.size(ids), F.lit(0)).cast("int"))
    return F.concat(fill, ids) if left else F.concat(ids, fill)


def collated(rows: DataFrame, batch: str, ids: str, pad: int = 0, left: bool = False) -> DataFrame:
    """Rows with input_ids and attention_mask as long as the longest of the row's batch."""
    longest = rows.groupBy(batch).agg(F.max(F.size(ids)).alias("_longest"))
    both = rows.join(longest, batch)
    mask = padded_batch(F.transform(ids, lambda x: F.lit(1)), F.col("_longest"), 0, left)
    return both.withColumns({"input_ids": padded_batch(F.col(ids), F.col("_longest"), pad, left), "attention_mask": mask}).drop("_longest")


def group_prompts(convs: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What group-relative training asks for: the turns up to the last answer as the prompt, that answer as the solution."""
    m = F.col("m")
    body = F.slice(m, F.lit(1), F.greatest(F.size(m) - 1, F.lit(0)))
    return convs.where(F.element_at(m, -1)["role"] == "assistant").select(id_col, F.transform(body, lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("prompt"), F.element_at(m, -1)["content"].alias("solution"))
