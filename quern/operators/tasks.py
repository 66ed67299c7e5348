"""Benchmark loaders (C3): what each named set's rows give to the n-gram dictionary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The column (or path) that holds a set's text; coqa's is a list.
TASKS: dict[str, str] = {
    "lambada": "text",
    "squad": "question",
    "natural_questions": "question.text",
    "triviaqa": "question",
    "webqa": "question",
    "race": "question",
    "drop": "question",
    "coqa": "questions",
    "piqa": "goal",
}


def task_texts(rows: DataFrame, task: str) -> DataFrame:
    """(task, text) of a set's rows; an unknown name is an error, rows without the text are left out."""
    if task not in TASKS:
        raise ValueError(f"no task {task}; there are {sorted(TASKS)}")
    c: Column = F.col(TASKS[task])
    got = rows.select(F.lit(task).alias("task"), (F.explode(c) if task == "coqa" else c).alias("text"))
    return got.where("text is not null")


def load_tasks(spark: SparkSession, paths: dict[str, str], reader: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """(task, text) of several sets, {task: path of its JSON lines}; another reader may give the rows."""
    read = reader or spark.read.json
    out = None
    for task, path in paths.items():
        t = task_texts(read(path), task)
        out = t if out is None else out.union(t)
    if out is None:
        raise ValueError("no tasks")
    return out
