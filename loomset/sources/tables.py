"""Parquet and CSV sources."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.filters import ColumnBinding
from .files import open_at


def _existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that are there, one look each."""
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    return [p for p in paths if hadoop(p).getFileSystem(conf).exists(hadoop(p))]


def schema_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """The files at the given paths, those of one schema together; footers are read by executors.

    As many groups come back as there are schemas, with the files' names, as every
    scan's list of files does."""

    def footer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kinds = []
            for at in batch["path"]:
                with open_at(at) as source:
                    kinds.append("\n".join(f"{f.name}\0{f.type}" for f in pq.read_schema(source)))
            yield pd.DataFrame({"path": batch["path"], "kind": kinds})

    there = _existing(spark, paths)
    if not there:
        raise FileNotFoundError(f"none of {len(paths)} paths exists")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there).select("path")
    # many small looks: dealt by number, as a listing is packed by bytes
    spread = files.repartition(max(1, min(spark.sparkContext.defaultParallelism, len(there))))
    kinds = spread.mapInPandas(footer, "path string, kind string").groupBy("kind").agg(F.sort_array(F.collect_list("path")).alias("files"))
    return [r.files for r in kinds.orderBy("kind").collect()]


def parquet_union(spark: SparkSession, paths: list[str], binding: ColumnBinding, number_policy: str = "zero") -> DataFrame:
    """Several files or folders, cast to canonical types before the union: one scan per
    schema, however many files. Missing paths are skipped, none left is an error."""
    found = [binding.canonical(spark.read.parquet(*group), number_policy) for group in schema_groups(spark, paths)]
    if not found:  # folders without a file
        raise FileNotFoundError(f"no file at {len(paths)} paths")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def parquet_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names from the footers, subfolders included; no data is read."""
    return spark.read.option("recursiveFileLookup", "true").parquet(path).schema.names


def parquet_directory(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


def csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, empty values kept as empty strings."""
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"', nullValue="\0", emptyValue="")
    return raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])
