"""Projections of items to sidecar and training records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values


def joined_tags(*cols: Column) -> Column:
    """Present columns joined by a space; nulls are left out, empty strings are not."""
    return F.regexp_replace(F.concat_ws(" ", *cols), r"(?U)^\s+|\s+\z", "")


def sidecar(df: DataFrame, id_col: str, url_col: str, rating_col: str, tag_cols: list[str]) -> DataFrame:
    """filename (id and extension), four-class rating, joined tags."""
    return df.select(
        F.concat(F.col(id_col).cast("string"), values.extension(F.col(url_col))).alias("filename"),
        values.rating4(F.col(rating_col)).alias("rating"),
        joined_tags(*[F.col(c).cast("string") for c in tag_cols]).alias("tags"),
    )


def sidecar_direct(df: DataFrame, name_col: str, rating_col: str, tags_col: str) -> DataFrame:
    """The same from ready columns, with the three-class rating."""
    return df.select(F.col(name_col).alias("filename"), values.rating3(F.col(rating_col)).alias("rating"), F.col(tags_col).alias("tags"))


def training_record(file_name: Column, artist: Column, tag_string: Column) -> list[Column]:
    """file_name, tags (the artist as one entry, then the tags, comma-joined), empty caption."""
    first = F.when(F.coalesce(artist, F.lit("")) != "", F.array(F.translate(artist, "_", " "))).otherwise(F.array().cast("array<string>"))
    rest = F.array_remove(F.split(F.coalesce(tag_string, F.lit("")), r"(?U)\s+"), "")
    return [file_name.alias("file_name"), F.array_join(F.concat(first, rest), ", ").alias("tags"), F.lit("").alias("caption")]


def with_sidecar(images: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Images (dir, stem, ext) with json_name, the .json of the same folder and stem, null without one."""
    found = sidecars.where(F.col("ext") == ".json").select("dir", "stem", F.concat("stem", "ext").alias("json_name")).distinct()
    return images.join(found, ["dir", "stem"], "left")


def rename_plan(files: DataFrame, suffix: str) -> DataFrame:
    """(dir, stem, ext, json_name) with a sidecar -> new names; stems that end in the suffix stay out."""
    return files.where(~F.col("stem").endswith(suffix) & F.col("json_name").isNotNull()).select(
        "dir", F.concat("stem", "ext").alias("old_name"), F.concat("stem", F.lit(suffix), "ext").alias("new_name"),
        "json_name", F.concat("stem", F.lit(suffix + ".json")).alias("new_json_name"),
    )
