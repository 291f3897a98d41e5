"""Connected components of an edge table by alternating star contractions.

Each round is two aggregations and two equi-joins; nothing is collected. The
edge table of a round is written to the shared folder, so lineage stays short
and a lost executor costs one round's tasks. Aggregates are grouped by the node
and a hash of it, so that a join by node doesn't take over their partitioning: a
hot node only makes a partition of an ordinary inner join large, which adaptive
execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, remove


def _write(edges: DataFrame, path: str) -> tuple[DataFrame, tuple]:
    spark = edges.sparkSession
    edges.write.parquet(path)
    back = spark.read.schema(edges.schema).parquet(path)
    mark = back.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.shiftright(F.xxhash64("v", "u"), 24))).first()
    return back, tuple(mark)


def least_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """(key, least value), in a partitioning that no join by the key can take over."""
    return df.groupBy(key, F.xxhash64(key).alias("_h")).agg(F.min(value).alias(name)).drop("_h")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node reachable."""
    spark = edges.sparkSession
    pair = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    at = fresh_path(spark, "edges")
    current, mark = _write(pair, at)
    while mark[0]:
        both = current.unionAll(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = least_by(both, "u", "v", "m").select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        star_at = fresh_path(spark, "edges")
        large, _ = _write(large, star_at)
        low = least_by(large, "u", "v", "m")
        moved = large.join(low, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()
        then, seen, at = at, mark, fresh_path(spark, "edges")
        current, mark = _write(small, at)
        remove(spark, then)
        remove(spark, star_at)
        if mark == seen:
            break
    leaves = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.unionAll(leaves.select(F.col("root").alias("node"), "root").distinct())
