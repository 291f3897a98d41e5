"""The difference of two tag datasets as a review sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tags, values


def _side(df: DataFrame, tag_cols: tuple[str, ...], order: str | None) -> DataFrame:
    text = next((F.col(c) for c in tag_cols if c in df.columns), F.lit(""))
    name = F.col("file_name")
    norm = values.base_name(name).alias("file_norm")
    first = F.struct((F.col(order) if order else F.lit(0)).alias("at"), name.alias("file_name"))
    names = df.select(norm, first.alias("_f")).groupBy("file_norm").agg(F.min("_f")["file_name"].alias("file_name"))
    # each token of a name once, by hash aggregates, before names gather theirs
    once = df.select(norm, F.explode(tags.token_set(text)).alias("_t")).distinct()
    gathered = once.groupBy("file_norm").agg(F.sort_array(F.collect_list("_t")).alias("tokens"))
    return names.join(gathered, "file_norm", "left").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))


def tag_delta(a: DataFrame, b: DataFrame, order: str | None = None) -> DataFrame:
    """file_name, original_tags, added, removed per normalised file name of either side;
    the name shown is the first in ``order``, else the smallest."""
    left, right = _side(a, ("tags",), order), _side(b, ("tag", "tags"), order)
    both = left.join(right.select("file_norm", F.col("tokens").alias("other")), "file_norm", "full_outer")
    none = F.array().cast("array<string>")
    old, new = F.coalesce("tokens", none), F.coalesce("other", none)
    return both.select(
        F.coalesce(F.nullif(F.trim("file_name"), F.lit("")), "file_norm").alias("file_name"),
        F.array_join(old, " ").alias("original_tags"),
        tags.sorted_tokens(F.array_except(new, old)).alias("added"),
        tags.sorted_tokens(F.array_except(old, new)).alias("removed"),
    )


def review_sheet(delta: DataFrame) -> DataFrame:
    return delta.orderBy(F.asc_nulls_last("file_name"))
