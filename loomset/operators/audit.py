"""Validity of files, shard audits and action plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import IMAGE_EXTENSIONS


def invalid_reason(size: Column, width: Column, height: Column, error: Column, min_size: int = 1000, min_side: int = 64, stat_error: Column | None = None, damage: Column | None = None) -> Column:
    """The first failing check as text, null for a valid file.

    ``stat_error``: why the size couldn't be read; ``error``: why the file is no image
    (not_an_image, decompression_bomb, invalid_image_...); ``damage``: what a look at
    the whole content found, reported as invalid_image_... after the size checks.
    """
    none = F.lit(None).cast("string")
    stat_error, damage = none if stat_error is None else stat_error, none if damage is None else damage
    return (
        F.when(stat_error.isNotNull(), F.concat(F.lit("stat_error_"), stat_error))
        .when(size.isNull(), "file_not_found")
        .when(size < min_size, F.format_string("too_small_%sbytes", size))
        .when(error.isNotNull(), error)
        .when((width < min_side) | (height < min_side), F.format_string("dimensions_%sx%s", width, height))
        .when(damage.isNotNull(), F.concat(F.lit("invalid_image_"), damage))
    )


def by_shard(files: DataFrame) -> DataFrame:
    """Counts per shard and, with a null shard, over all; total_issues leaves unknown files out."""
    count = lambda name: F.count(F.when(F.col("class") == name, 1)).alias(name)
    kinds = ["valid", "corrupt", "orphan_image", "orphan_json", "unknown"]
    out = files.rollup("shard").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), *map(count, kinds))
    return out.withColumn("total_issues", F.col("corrupt") + F.col("orphan_image") + F.col("orphan_json"))


def top_reasons(files: DataFrame, k: int = 10) -> DataFrame:
    per = files.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))
    return per.orderBy(F.desc("n"), "reason").limit(k)


def outcome_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


def payload_ok(content: Column, md5: Column | None = None, minimum: int = 100) -> Column:
    long = F.octet_length(content) >= minimum
    return long if md5 is None else long & F.coalesce(F.lower(F.md5(content)) == F.lower(md5), F.lit(True))


def stored_ok(size: Column, expected: Column, actual_md5: Column, md5: Column, tolerance: int = 100, minimum: int = 100) -> Column:
    """Near the expected size if there is one, of the given MD5 if there is one, else not tiny."""
    near = F.coalesce(F.abs(size - expected) <= tolerance, F.lit(True))
    return F.when(md5.isNotNull(), near & (F.lower(actual_md5) == F.lower(md5))).otherwise(near & (size >= minimum))


def file_action(files: DataFrame, destination: DataFrame) -> DataFrame:
    """none for other types, delete for names the destination has, move for unreadable or not square, else none."""
    there = destination.select("name").distinct().withColumn("_there", F.lit(True))
    joined = files.join(there, "name", "left")
    action = (
        F.when(~F.lower("ext").isin(*IMAGE_EXTENSIONS), "none").when(F.col("_there"), "delete")
        .when(F.col("error").isNotNull() | (F.col("w") != F.col("h")), "move").otherwise("none")
    )
    return joined.withColumn("action", action).drop("_there")


def removal_statistics(outcomes: DataFrame) -> DataFrame:
    """One row over executed removals (id, kind image or json, size, outcome): what went, its bytes, its ids, failures."""
    done, image = F.col("outcome") == "done", F.col("kind") == "image"
    return outcomes.agg(
        F.count(F.when(done & image, 1)).alias("removed_images"), F.count(F.when(done & (F.col("kind") == "json"), 1)).alias("removed_jsons"),
        F.coalesce(F.sum(F.when(done & image, F.col("size"))), F.lit(0)).cast("bigint").alias("removed_size"),
        F.countDistinct(F.when(done & image, F.col("id"))).alias("removed_ids"), F.count(F.when(F.col("outcome").startswith("failed"), 1)).alias("failures"),
    )


def with_sidecar_path(pictures: DataFrame, inventory: DataFrame) -> DataFrame:
    """Pictures of an inventory with json_path, the .json of the same folder and stem, null without one."""
    found = inventory.where(F.col("ext") == ".json").groupBy("dir", "stem").agg(F.min("path").alias("json_path"))
    return pictures.join(found, ["dir", "stem"], "left")


def removal_plan(classes: DataFrame, orphans: bool = True) -> DataFrame:
    gone = ["corrupt", *(["orphan_image", "orphan_json"] if orphans else [])]
    return classes.where(F.col("class").isin(*gone)).withColumn("action", F.lit("delete"))
