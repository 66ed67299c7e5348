"""Event-time buckets on streams (S2, S3, S14 to S16): the state is one row for each open key and bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def tumbling(events: DataFrame, width: str = "5 seconds", late: str = "10 minutes") -> DataFrame:
    """The last event of each user and bucket; what comes later than `late` behind the newest event is dropped (S3)."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    got = e.groupBy("user_id", F.window("ts", width).alias("w")).agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("value"), F.count(F.lit(1)).alias("n"))
    return got.select("user_id", F.col("w.start").alias("start"), "value", "n")


def run_to_table(df: DataFrame, name: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Everything there is, then stop; progress lies in the checkpoint folder, so a restart goes on from there."""
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def run_to_parquet(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q
