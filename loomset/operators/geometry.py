"""Square crop regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def crop_regions(w: Column, h: Column, overlap: float = 0.18, threshold: float = 1.3, cover_edge: bool = False) -> Column:
    """array<struct<x, y, side>>: one centred square for nearly square images, else
    overlapping squares along the long axis; ``cover_edge`` adds the far edge."""
    side, long = F.least(w, h), F.greatest(w, h)
    step = F.greatest(F.lit(1), F.floor(side * F.lit(1 - overlap)).cast("int"))
    count = F.ceil((long - side) / step).cast("int")
    starts = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda i: F.least(long - side, i * step))
    if cover_edge:
        starts = F.concat(starts, F.array(long - side))
    wide = w >= h
    many = F.transform(F.array_distinct(starts), lambda o: F.struct(F.when(wide, o).otherwise(0).cast("int").alias("x"), F.when(wide, 0).otherwise(o).cast("int").alias("y"), side.cast("int").alias("side")))
    one = F.array(F.struct(F.floor((w - side) / 2).cast("int").alias("x"), F.floor((h - side) / 2).cast("int").alias("y"), side.cast("int").alias("side")))
    return F.when(long < side * F.lit(threshold), one).otherwise(many)


def explode_crops(images: DataFrame, w: str = "w", h: str = "h", **options) -> DataFrame:
    """A row per crop, numbered from 1; other columns are carried along."""
    rois = images.withColumn("_r", crop_regions(F.col(w), F.col(h), **options))
    out = rois.select("*", F.posexplode("_r").alias("_p", "_c"))
    return out.withColumns({"crop": (F.col("_p") + 1).cast("int"), "x": F.col("_c.x"), "y": F.col("_c.y"), "side": F.col("_c.side")}).drop("_r", "_p", "_c")


def crop_files(images: DataFrame, **options) -> DataFrame:
    """A row per crop of images (dir, stem, ext, w, h, json_name): its file name, its region,
    and the name of its copy of the sidecar, null where the original has none."""
    rows = explode_crops(images, **options)
    numbered = F.concat("stem", F.lit("_"), F.col("crop").cast("string"))
    return rows.select(
        "dir", "stem", "crop", F.concat(numbered, "ext").alias("image_name"), "x", "y", "side",
        "json_name", F.when(F.col("json_name").isNotNull(), F.concat(numbered, F.lit(".json"))).alias("json_copy"),
    )


def crop_eligible(w: Column, h: Column, minimum: int = 1024) -> Column:
    """Not square at full size already, and not too small."""
    return ~((w == h) & (w >= minimum)) & (F.least(w, h) >= minimum)


def originals_with_crop(originals: DataFrame, crops: DataFrame) -> DataFrame:
    """Originals (stem, ext) whose first crop (name) exists."""
    key = F.concat(F.col("stem"), F.lit("_1"), F.col("ext"))
    return originals.withColumn("name_1", key).join(crops.select(F.col("name").alias("name_1")), "name_1", "left_semi").drop("name_1")
