"""What is selected against what is complete, on disk, missing or orphaned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .audit import stored_ok


def pending(items: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Items that no completed id matches."""
    return items.join(done.select(key), key, "left_anti")


def adopt(items: DataFrame, on_disk: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Items already on disk but not marked complete: to be marked."""
    return items.join(done.select(key), key, "left_anti").join(on_disk.select(key), key, "left_semi")


def reconcile(completed: DataFrame, missing: DataFrame, on_disk: DataFrame, key: str = "id") -> DataFrame:
    """Every id once, with its state: verified, missing, recovered, still_missing or untracked."""
    flags = ("c", "m", "d")
    parts = [t.select(key).withColumn(f, F.lit(f)) for t, f in zip((completed, missing, on_disk), flags)]
    tagged = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    seen = tagged.groupBy(key).agg(*[F.max(f).isNotNull().alias(f) for f in flags])
    state = (
        F.when(F.col("c") & F.col("d"), "verified").when(F.col("c"), "missing")
        .when(F.col("m") & F.col("d"), "recovered").when(F.col("m"), "still_missing").otherwise("untracked")
    )
    return seen.select(key, state.alias("state"))


def next_progress(states: DataFrame, key: str = "id", adopt_untracked: bool = False, drop_missing: bool = True) -> DataFrame:
    """(id, status) after a validation: completed or missing."""
    done = ["verified", "recovered", *(["untracked"] if adopt_untracked else []), *([] if drop_missing else ["missing"])]
    status = F.when(F.col("state").isin(*done), "completed").when(F.col("state").isin("missing", "still_missing"), "missing")
    return states.select(key, status.alias("status")).where(F.col("status").isNotNull())


def validation_counts(completed: DataFrame, missing: DataFrame, on_disk: DataFrame, key: str = "id") -> DataFrame:
    """One row: how many ids are marked complete and found, gone, found though listed as
    missing, on disk without a mark, and still missing."""
    flags = ("c", "m", "d")
    parts = [t.select(key, *[F.lit(1 if g == f else 0).alias(g) for g in flags]) for t, f in zip((completed, missing, on_disk), flags)]
    seen = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy(key).agg(*[(F.max(f) == 1).alias(f) for f in flags])
    c, m, d = (F.col(f) for f in flags)
    cells = {"marked_complete": c, "verified": c & d, "missing": c & ~d, "recovered": c & d & m, "untracked": d & ~c, "still_missing": m & ~c & ~d}
    return seen.agg(*[F.count(F.when(test, 1)).alias(name) for name, test in cells.items()])


def completed_after_cleanup(completed: DataFrame, removed: DataFrame, key: str = "id") -> DataFrame:
    """Completed ids without those whose files were removed: these are fetched again."""
    return completed.join(removed.select(key), key, "left_anti")


def invalid_sample(completed: DataFrame, metadata: DataFrame, stored: DataFrame, sample: int = 1000) -> DataFrame:
    """Of the first ``sample`` completed ids those with metadata (id, md5) whose stored file (id, size, actual_md5) fails.

    The sample is the feature: a quick check before work goes on.
    """
    some = completed.select("id").distinct().orderBy("id").limit(sample)
    known = some.join(metadata.select("id", "md5"), "id").join(stored.select("id", "size", "actual_md5"), "id", "left")
    good = stored_ok(F.col("size"), F.lit(None).cast("bigint"), F.col("actual_md5"), F.col("md5"))
    return known.where(~F.coalesce(good, F.lit(False))).select("id")


def orphans(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose (directory, stem) ``right`` lacks."""
    return left.join(right.select(*keys), keys, "left_anti")


def pair_classes(images: DataFrame, sidecars: DataFrame, key: str = "id", valid: str = "valid") -> DataFrame:
    """valid, corrupt, orphan_image or orphan_json for every id of either side."""
    both = images.select(key, F.col(valid).alias("_v")).withColumn("_i", F.lit(True)).join(sidecars.select(key).withColumn("_j", F.lit(True)), key, "full_outer")
    kind = F.when(F.col("_i").isNull(), "orphan_json").when(F.col("_j").isNull(), "orphan_image").when(F.col("_v"), "valid").otherwise("corrupt")
    return both.select(key, kind.alias("class"))
