"""Resolving items to archives and archive members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values


def resolve(items: DataFrame, index: DataFrame, url_col: str = "url", key: str = "id") -> DataFrame:
    """Items with archive and inner_path from the index, else from a .tar in the URL; null where neither has it."""
    last = index.groupBy(F.col("image_id").alias(key)).agg(F.max_by(F.struct("archive", "inner_path"), F.struct("archive_rank", "archive", "inner_path")).alias("_at"))
    archive, inner = values.archive_in_url(F.col(url_col))
    return items.join(last, key, "left").withColumns(
        {"archive": F.coalesce("_at.archive", archive), "inner_path": F.when(F.col("_at").isNotNull(), F.col("_at.inner_path")).otherwise(inner)}
    ).drop("_at")


def resolve_by_name(items: DataFrame, archives: DataFrame, key: str = "id") -> DataFrame:
    """The guess by archive name: it contains the id, or the id's first three digits.

    A heuristic with false positives, so it is a call of its own. Substrings of
    each archive's digits meet the ids by equality, not by comparing all pairs.
    """
    name = F.col("archive")
    longest = F.length(name)
    pieces = F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), longest), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(19), longest - i + 1)), lambda n: F.substring(name, i, n))))))
    parts = archives.where(longest > 0).select("archive", pieces.alias("_p")).where(F.col("_p").rlike(r"^\d+\z"))
    first = parts.groupBy("_p").agg(F.min("archive").alias("_a"))
    text = F.col(key).cast("string")
    whole = items.withColumn("_t", text).join(first.select(F.col("_p").alias("_t"), F.col("_a").alias("_whole")), "_t", "left").drop("_t")
    head = whole.withColumn("_t", F.substring(text, 1, 3)).join(first.select(F.col("_p").alias("_t"), F.col("_a").alias("_head")), "_t", "left").drop("_t")
    return head.withColumn("archive", F.least("_whole", "_head")).drop("_whole", "_head")


def group_counts(resolved: DataFrame) -> DataFrame:
    """Items per archive, in order of the archive."""
    return resolved.where(F.col("archive").isNotNull()).groupBy("archive").agg(F.count("*").alias("n_items")).orderBy("archive")


def index_statistics(index: DataFrame) -> DataFrame:
    return index.agg(F.countDistinct("archive").alias("n_archives"), F.countDistinct("image_id").alias("n_ids"))


def extraction_order(resolved: DataFrame) -> DataFrame:
    """Each archive's items together and sorted, so it is opened once."""
    return resolved.repartition("archive").sortWithinPartitions("archive", "id")


def _digit_pieces(text: Column) -> Column:
    """Distinct digit strings of up to 19 digits inside a text."""
    runs = F.regexp_extract_all(text, F.lit(r"(\d+)"), 1)
    cuts = lambda r: F.flatten(F.transform(F.sequence(F.lit(1), F.length(r)), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(19), F.length(r) - i + 1)), lambda n: F.substring(r, i, n))))
    return F.array_distinct(F.flatten(F.transform(runs, cuts)))


def match_members(wanted: DataFrame, members: DataFrame, extensions: list[str] = values.IMAGE_EXTENSIONS, substring: bool = True) -> DataFrame:
    """(id, archive, member, strategy) for each wanted (id, archive, inner_path) with a member.

    In order: the full name; the full name with each extension instead of its
    own; the id with each extension; with ``substring`` the first member by
    position whose name holds the id's digits. A null inner path is the id with
    .jpg. All are equi-joins: digit pieces of names meet ids, not all pairs.
    """
    text = F.col("id").cast("string")
    name = F.coalesce("inner_path", F.concat(text, F.lit(".jpg")))
    stem = F.regexp_replace(name, r"([^/.][^/]*)\.[^./]*\z", "$1")
    tries = [(1, 0, name), *[(r, e, F.concat(base, F.lit(x))) for r, base in ((2, stem), (3, text)) for e, x in enumerate(extensions)]]
    keys = wanted.select("id", "archive", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(e).alias("e"), n.alias("member")) for r, e, n in tries])).alias("t")).select("id", "archive", "t.*")
    there = members.groupBy("archive", "member").agg(F.min("pos").alias("pos"))
    found = keys.join(there, ["archive", "member"]).groupBy("id", "archive").agg(F.min_by(F.struct("member", F.col("r").alias("strategy")), F.struct("r", "e")).alias("m"))
    found = found.select("id", "archive", "m.member", "m.strategy")
    if not substring:
        return found
    pieces = there.select("archive", "member", "pos", F.explode(_digit_pieces(F.col("member"))).alias("text"))
    first = pieces.groupBy("archive", "text").agg(F.min_by("member", "pos").alias("member"))
    rest = wanted.select("id", "archive", text.alias("text")).distinct().join(found, ["id", "archive"], "left_anti")
    return found.unionByName(rest.join(first, ["archive", "text"]).select("id", "archive", "member", F.lit(4).alias("strategy")))


def last_writer(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One value per key, from its last row in ``order``."""
    return rows.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value))


def first_by_extension(sidecars: DataFrame, images: DataFrame, extensions: list[str] = values.IMAGE_EXTENSIONS) -> DataFrame:
    """Each sidecar's image of the same (dir, stem): the first extension in the list."""
    rank = F.array_position(F.array(*map(F.lit, extensions)), F.lower("ext"))
    best = images.withColumn("_r", rank).where("_r > 0").groupBy("dir", "stem").agg(F.min_by("name", F.struct("_r", "name")).alias("image"))
    return sidecars.join(best, ["dir", "stem"], "left")


def numbered(df: DataFrame, by: list[str], order: list[str], name: str = "pos") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
