"""Saved state: archive index caches, shard manifests and scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import IMAGE_EXTENSIONS


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: below ``spark.checkpoint.dir``; a local
    master without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="loomset-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/scratch/{uuid.uuid4().hex}/{name}"


def index_cache(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, archive, inner_path) as :func:`loomset.sinks.outputs.write_index_cache` left it."""
    return spark.read.schema("image_id long, archive string, inner_path string").parquet(path)


def cached_index(texts: DataFrame) -> DataFrame:
    """The same from cache files of the replaced tools: {"image_to_tar": {key: archive}} texts.

    The id is the key up to its first dot; keys that are no number are left out.
    Of keys with one id the last in the file wins.
    """
    entries = texts.select(F.posexplode(F.from_json("text", "image_to_tar map<string,string>")["image_to_tar"]).alias("pos", "key", "archive"))
    rows = entries.select(F.regexp_extract("key", r"\A([^.]*)", 1).try_cast("bigint").alias("image_id"), "archive", "pos").where(F.col("image_id").isNotNull())
    last = rows.groupBy("image_id").agg(F.max_by("archive", F.struct("pos", "archive")).alias("archive"))
    return last.withColumn("inner_path", F.lit(None).cast("string"))


def shard_manifest(texts: DataFrame) -> DataFrame:
    """(id, shard) from manifest files of the replaced tools: {"id_to_shard": {id: shard}} texts."""
    entries = texts.select(F.explode(F.from_json("text", "id_to_shard map<string,bigint>")["id_to_shard"]).alias("id", "shard"))
    return entries.select(F.col("id").try_cast("bigint").alias("id"), "shard").where(F.col("id").isNotNull())


def rebuilt_manifest(files: DataFrame) -> DataFrame:
    """(id, shard) of the images in an inventory's shard_* folders; of an id in several the last folder by name."""
    rows = files.where(F.col("ext").isin(*IMAGE_EXTENSIONS) & F.col("stem").rlike(r"\A\d+\z"))
    rows = rows.select(F.col("stem").cast("bigint").alias("id"), F.regexp_extract("shard", r"\Ashard_(\d+)\z", 1).try_cast("bigint").alias("number"), F.col("shard").alias("folder"))
    return rows.where(F.col("number").isNotNull()).groupBy("id").agg(F.max_by("number", "folder").alias("shard"))


def manifest_state(manifest: DataFrame) -> tuple[int, int]:
    """(current shard, files in it): the last shard in use, where new files go on."""
    last = manifest.groupBy("shard").agg(F.count("*").alias("n")).orderBy(F.desc("shard")).first()
    return (int(last["shard"]), int(last["n"])) if last else (0, 0)
