"""Shards in the order of arrival, kept over a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import shards

MANIFEST = "id long, shard long"


def epochs(spark: SparkSession, table: str) -> list[int]:
    """Epochs that are complete: their counter is there, which is written last."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/counters")
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found = [s.getPath() for s in fs.listStatus(at)]
    done = [p for p in found if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().removeprefix("epoch=")) for p in done)


def manifest(spark: SparkSession, table: str, before: int | None = None) -> DataFrame:
    """(id, shard) of all complete epochs, or of those before one."""
    wanted = [f"{table}/shards/epoch={e}" for e in epochs(spark, table) if before is None or e < before]
    return spark.read.schema(MANIFEST).parquet(*wanted) if wanted else spark.createDataFrame([], MANIFEST)


def assign_batch(batch: DataFrame, epoch: int, table: str, files_per_shard: int, arrival: str) -> None:
    """Give a batch's new ids their shards, in order of arrival, after those of earlier epochs.

    An epoch reads what epochs before it left and overwrites its own output, so one that
    runs again gives the same shards and uses up no places."""
    spark = batch.sparkSession
    first = batch.where(F.col("id").isNotNull()).groupBy("id").agg(F.min(arrival).alias(arrival))
    new = first.join(manifest(spark, table, epoch), "id", "left_anti")
    done = [e for e in epochs(spark, table) if e < epoch]
    index, count = spark.read.schema("current long, filled long").parquet(f"{table}/counters/epoch={done[-1]}").first() if done else (0, 0)
    none = spark.createDataFrame([], MANIFEST)
    placed = shards.by_count(new, none, files_per_shard, index, count, arrival=arrival).select("id", "shard")
    placed.repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{table}/shards/epoch={epoch}")
    added = spark.read.schema(MANIFEST).parquet(f"{table}/shards/epoch={epoch}").count()
    if added:
        total = index * files_per_shard + count + added
        index, count = (total - 1) // files_per_shard, (total - 1) % files_per_shard + 1
    spark.createDataFrame([(index, count)], "current long, filled long").coalesce(1).write.mode("overwrite").parquet(f"{table}/counters/epoch={epoch}")


def assign(arrivals: DataFrame, table: str, checkpoint: str, files_per_shard: int, arrival: str = "arrival") -> StreamingQuery:
    """Assign a stream of (id, arrival) to shards; ``table`` holds the manifest by epoch and a counter.

    Defined cases: an id that comes again keeps its shard; of an id's rows in a batch the
    first to arrive counts; of ties the smaller id goes first; rows without id get no
    shard, rows without arrival come first; an empty batch changes nothing."""

    def put(batch: DataFrame, epoch: int) -> None:
        assign_batch(batch, epoch, table, files_per_shard, arrival)

    return arrivals.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
