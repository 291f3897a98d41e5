"""Progress as an append-only stream (an extension): status events in, a current-status table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def status_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema("id long, status string, at timestamp").parquet(path)


def maintain(events: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch becomes one partition named by its epoch, overwritten on
    replay, so a batch that runs twice counts once."""

    def put(batch: DataFrame, epoch: int) -> None:
        last = batch.groupBy("id").agg(F.max_by("status", "at").alias("status"))
        last.write.mode("overwrite").parquet(f"{table}/epoch={epoch}")

    return events.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("at", late).groupBy(F.window("at", window), "status").agg(F.count("*").alias("n"))
