"""Rewriting many Parquet files as few of a wanted size."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import open_at

#: Files whose offsets are broadcast (some 200 bytes each); more are joined by a shuffle.
BROADCAST_FILES = 100_000
SIZES = T.StructType([T.StructField("path", T.StringType()), T.StructField("rows", T.LongType()), T.StructField("bytes", T.LongType())])


def footers(spark: SparkSession, path: str) -> DataFrame:
    """(path, rows, bytes) of Parquet files from their footers, read by executors; bytes as stored."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for at in batch["path"]:
                with open_at(at) as source:
                    meta = pq.read_metadata(source)
                groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
                found.append((at, meta.num_rows, sum(g.column(c).total_compressed_size for g in groups for c in range(g.num_columns))))
            yield pd.DataFrame(found, columns=SIZES.names)

    return listed.mapInPandas(run, SIZES)


def compact_files(spark: SparkSession, path: str, target: str, file_bytes: int = 512 << 20, codec: str = "zstd") -> int:
    """Files of about ``file_bytes`` each, as stored before; returns how many.

    All rows lie on one line of bytes, file after file, a row as long as its file's
    average, and the line is cut into equal bins. A file over the size is so split
    between bins and small ones share one; a bin is a task. The offsets, a row a file,
    come from sums over groups of files, not from one task; they go to the rows, which
    are shuffled once, to their bins.
    """
    sizes = footers(spark, path).where("rows > 0")
    total, many = sizes.agg(F.sum("bytes"), F.count("*")).first()
    if not total:
        spark.read.option("recursiveFileLookup", "true").parquet(path).write.mode("overwrite").option("compression", codec).parquet(target)
        return 0
    bins = max(1, round(total / file_bytes))
    placed = _offsets(sizes).select(F.col("path").alias("_path"), "before", (F.col("bytes") / F.col("rows")).alias("each"))
    rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    # a listing's path isn't URL-encoded as the one of a row is
    at = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    at = F.regexp_replace(at, "^file:/+", "/")
    whole = F.struct(*[F.col(f"`{n}`") for n in rows.columns])  # names of the rows may be any
    marked = rows.select(whole.alias("_values"), at.alias("_path"), F.col("_metadata.row_index").alias("_row"))
    placed = placed.withColumn("_path", F.regexp_replace("_path", "^file:/+", "/"))
    joined = marked.join(F.broadcast(placed) if many <= BROADCAST_FILES else placed, "_path")
    place = F.least(F.floor((F.col("before") + F.col("_row") * F.col("each")) * bins / total), F.lit(bins - 1)).cast("int")
    joined.select("_values", place.alias("_bin")).repartitionById(bins, "_bin").select("_values.*").write.mode("overwrite").option("compression", codec).parquet(target)
    return bins


def _offsets(sizes: DataFrame) -> DataFrame:
    """Files with the bytes ``before`` them, in order of a hash of the path: sums within
    groups of files, and the sums of 256 groups before."""
    from pyspark.sql import Window

    grouped = sizes.withColumn("_g", F.pmod(F.xxhash64("path"), F.lit(256)))
    upto = Window.partitionBy("_g").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    whole = grouped.groupBy("_g").agg(F.sum("bytes").alias("_n"))
    start = whole.withColumn("_start", F.coalesce(F.sum("_n").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = grouped.withColumn("_in", F.coalesce(F.sum("bytes").over(upto), F.lit(0)))
    return inside.join(F.broadcast(start), "_g").withColumn("before", F.col("_start") + F.col("_in")).drop("_g", "_start", "_in")
