"""Shard assignment by id and by count, and shard statistics."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import floor_div, shard_name


def by_id(items: DataFrame, files_per_shard: int, key: str = "id") -> DataFrame:
    return items.withColumn("shard", shard_name(F.col(key), files_per_shard))


def global_rank(df: DataFrame, key: str, name: str = "rank", ties: tuple[str, ...] = ()) -> DataFrame:
    """Rank from 0 in ascending order of a numeric key, then of ``ties``, without a one-partition window: buckets
    of the sorted key are counted first and their offsets joined back.

    Buckets are ranges between quantiles of the key, so outliers don't crowd the
    rest into one; the bounds are constants of the plan, the same in both uses."""
    spark = df.sparkSession
    side = max(2, math.isqrt(4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = df.approxQuantile(key, [i / side**2 for i in range(1, side**2)], 1 / (4 * side**2))
    if not found:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    bounds = sorted({int(x) for x in found})
    # two short searches instead of one long one
    runs = [bounds[i : i + side] for i in range(0, len(bounds), side)]
    above = lambda among: F.size(F.filter(among, lambda x: x <= F.col(key)))
    bucketed = df.withColumn("_run", above(F.array(*[F.lit(r[0]).cast("bigint") for r in runs])))
    inner = F.get(F.array(*[F.array(*[F.lit(x).cast("bigint") for x in r]) for r in runs]), F.col("_run") - 1)
    bucketed = bucketed.withColumn("_b", F.when(F.col("_run") == 0, 0).otherwise(F.col("_run") * (side + 1) + above(inner))).drop("_run")
    sizes = bucketed.groupBy("_b").agg(F.count("*").alias("_n"))
    # as many rows as buckets, a fixed number
    before = sizes.withColumn("_o", F.coalesce(F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inner = F.row_number().over(Window.partitionBy("_b").orderBy(key, *ties)) - 1
    return bucketed.join(F.broadcast(before), "_b").withColumn(name, (F.col("_o") + inner).cast("bigint")).drop("_b", "_o")


def by_count(items: DataFrame, assigned: DataFrame, files_per_shard: int, current_index: int = 0, current_count: int = 0, key: str = "id", arrival: str | None = None) -> DataFrame:
    """Known ids keep their shard; new ids fill the current shard, then the next ones, in
    the order of ``arrival``, a number (of ties the smaller id first).

    Rows of a table have no order of their own: without ``arrival`` it is that of the ids."""
    if current_count >= files_per_shard:
        current_index, current_count = current_index + 1, 0
    known = items.join(assigned.select(key, "shard"), key, "left")
    old = known.where(F.col("shard").isNotNull())
    new = global_rank(known.where(F.col("shard").isNull()).drop("shard"), arrival or key, ties=(key,) if arrival else ())
    shard = F.lit(current_index) + floor_div(F.col("rank") + current_count, files_per_shard)
    return old.withColumn("shard", F.col("shard").cast("bigint")).unionByName(new.withColumn("shard", shard.cast("bigint")).drop("rank"))


def fill_statistics(assigned: DataFrame) -> DataFrame:
    per = assigned.groupBy("shard").agg(F.count("*").alias("n"))
    return per.agg(F.count("*").alias("n_shards"), F.sum("n").alias("n_files"), F.min("n").alias("min_files"), F.max("n").alias("max_files"), F.avg("n").alias("avg_files"))
