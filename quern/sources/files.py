"""Text and table formats (IO1 to IO7, IO13, IO18, X9). All reading goes through Spark, so any store works."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = {x: x for x in ("csv", "json", "orc", "parquet")} | {"jsonl": "json", "txt": "text"}


def jsonl(spark: SparkSession, path: str, schema: str | None = None) -> tuple[DataFrame, DataFrame]:
    """IO1, IO3, M1: (rows, broken lines). Blank lines are skipped; .gz is read as it is; lines that don't parse are kept apart."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    if schema is None:
        sample = spark.read.json(path)
        schema = sample.drop("_corrupt_record").schema.simpleString()
    parsed = lines.select("value", F.from_json("value", f"{_fields(schema)}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}).alias("r"))
    return parsed.where("r._broken is null").select("r.*").drop("_broken"), parsed.where("r._broken is not null").select("value")


def _fields(schema: str) -> str:
    return schema[7:-1] if schema.startswith("struct<") else schema


def json_auto(spark: SparkSession, path: str) -> DataFrame:
    """IO2: .jsonl (and .jsonl.gz) by line, any other as one document whose root is a list."""
    name = path.removesuffix(".gz")
    if name.endswith(".jsonl"):
        return spark.read.json(path)
    root = spark.read.option("wholetext", "true").text(path).select(F.trim("value").alias("v"))
    if not root.where(~F.startswith("v", F.lit("["))).isEmpty():
        raise ValueError(f"{path}: the root must be a list")
    return spark.read.option("multiLine", "true").json(path)


def load(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """IO4: files of one type among csv, json, jsonl, parquet, txt and orc; a mix is an error."""
    kinds = {os.path.splitext(p.removesuffix(".gz"))[1].lstrip(".").lower() for p in paths}
    if len(kinds) != 1:
        raise ValueError(f"files must share one type, not {sorted(kinds)}")
    kind = kinds.pop()
    if kind not in FORMATS:
        raise ValueError(f"no reader for .{kind}")
    r = spark.read.options(**({"header": "true"} | options if kind == "csv" else options))
    return r.format(FORMATS[kind]).load(paths)


def url_list(spark: SparkSession, folder: str) -> DataFrame:
    """IO5: stripped lines of every *.txt in a folder."""
    return spark.read.option("pathGlobFilter", "*.txt").text(folder).select(F.trim("value").alias("url"))


def tsv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """IO6: tab-separated values; columns c0, c1, ... by position."""
    df = spark.read.csv(path, sep="\t", header=header, quote="", enforceSchema=True)
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pair_classification(df: DataFrame, a: int = 8, b: int = 9, test_columns: int = 10, test_label: str = "contradiction") -> DataFrame:
    """IO6: uid, two texts and the label in the last column; a file of `test_columns` columns has no labels."""
    n = len(df.columns)
    label = F.lit(test_label) if n == test_columns else F.col(f"c{n - 1}")
    return df.select(F.col("c0").cast("long").alias("uid"), F.trim(f"c{a}").alias("text_a"), F.trim(f"c{b}").alias("text_b"), label.alias("label"))


def passages(df: DataFrame) -> DataFrame:
    """IO6: doc_id, text, title."""
    return df.select(F.col("c0").cast("long").alias("doc_id"), F.col("c1").alias("text"), F.col("c2").alias("title"))


def multiple_choice(articles: DataFrame) -> DataFrame:
    """IO7: from article, questions, options and answers: a row for each option; a blank in the question takes the option."""
    q = articles.select("article", F.posexplode(F.arrays_zip("questions", "options", "answers")).alias("q", "z"))
    o = q.select("article", "q", "z.questions", (F.ascii("z.answers") - 65).alias("label"), F.posexplode("z.options").alias("option", "text"))
    full = F.when(F.contains("questions", F.lit("_")), F.replace("questions", F.lit("_"), F.col("text"))).otherwise(F.concat_ws(" ", "questions", "text"))
    return o.select("article", "q", "option", full.alias("qa"), "label")


def merged_json(spark: SparkSession, folder: str) -> DataFrame:
    """IO13: the parsed rows of every *.json in a folder."""
    return spark.read.option("pathGlobFilter", "*.json").option("mode", "DROPMALFORMED").json(folder)


def tar_counts(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """IO18: (tar, n) of `name.tar : n` lines."""
    form = r"^\s*(\S+\.tar)\s*:\s*(\d+)\s*$"
    return lines.where(F.col(line_col).rlike(form)).select(F.regexp_extract(line_col, form, 1).alias("tar"), F.regexp_extract(line_col, form, 2).cast("long").alias("n"))


def python_strings(text: Column) -> Column:
    """The quoted strings of a Python list literal; nothing is evaluated."""
    found = F.regexp_extract_all(text, F.lit(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*["]"""), F.lit(0))
    inner = lambda x: F.substring(x, F.lit(2), F.length(x) - 2)
    return F.transform(found, lambda x: F.regexp_replace(inner(x), r"\\(.)", "$1"))


def questions(df: DataFrame) -> DataFrame:
    """(question, answers) of tab-separated questions with a Python list of answers, as read by tsv."""
    return df.select(F.col("c0").alias("question"), python_strings(F.col("c1")).alias("answers"))


def retrieval_samples(rows: DataFrame) -> DataFrame:
    """(question, answers, positive, hard_negatives, negatives) of supervised JSON rows; the first positive counts."""
    normal = F.regexp_replace("question", r"\?$", "")
    return rows.select(normal.alias("question"), "answers", F.get("positive_ctxs", F.lit(0)).alias("positive"), F.col("hard_negative_ctxs").alias("hard_negatives"), F.col("negative_ctxs").alias("negatives"))
