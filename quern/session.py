"""Session settings and table loading."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", app: str = "quern", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in (SETTINGS | {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": os.environ.get("QUERN_DRIVER_MEMORY", "8g")} | extra).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder (any path that Spark reads)."""
    return dealt_out(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def dealt_out(df: DataFrame) -> DataFrame:
    """df, or its rows dealt out evenly if its scan has some splits but fewer than the cluster has cores.

    A file of one row group is one task however many splits it has. A table with that few splits is small against the
    cluster; larger ones are read where they lie, and one split is not worth a shuffle.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if 1 < df.rdd.getNumPartitions() < n else df


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where the setting is absent, a local session gets a folder under /tmp; a cluster without it is an error, as
    executors would write where nobody else can read.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        return f"/tmp/checkpoints/{spark.sparkContext.applicationId}"
    raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/quern/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application; Python stages import it there."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = str(Path(__file__).resolve().parent)
    path = os.path.join(tempfile.mkdtemp(prefix="quern-"), "quern.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)
