"""Paths in object stores and other Hadoop file systems (IO12), seen from the driver."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SCHEMES = ("s3", "s3a", "s3n")


def is_object_path(path: str) -> bool:
    return path.split("://", 1)[0] in SCHEMES and "://" in path


def split_path(path: str) -> tuple[str, str]:
    """Bucket and key; anything else than an object path is an error."""
    if not is_object_path(path):
        raise ValueError(f"{path} is no object path")
    bucket, _, key = path.split("://", 1)[1].partition("/")
    return bucket, key


def _at(spark: SparkSession, path: str) -> tuple:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def fetched(spark: SparkSession, path: str, folder: str) -> str:
    """A copy of a file in a shared folder, made once: what is there already is taken, a part is never seen."""
    target = f"{folder.rstrip('/')}/{path.rstrip('/').rpartition('/')[2]}"
    if not os.path.exists(target):
        os.makedirs(folder, exist_ok=True)
        p, fs = _at(spark, path)
        part = f"{target}.part"
        fs.copyToLocalFile(False, p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(part), True)
        os.replace(part, target)
    return target
