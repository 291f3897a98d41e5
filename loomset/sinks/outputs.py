"""Sidecars, JSONL, CSV, Parquet, progress tables and guarded file actions."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .compaction import compact_files


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_sharded_json(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard, a JSON line per item, committed as a whole."""
    df.repartition(shard).write.mode("overwrite").partitionBy(shard).json(path)


def write_sidecars(df: DataFrame, fetch_open: Callable[[str], object], folder: str) -> DataFrame:
    """A JSON file per row, ``{shard}/{id}.json``: written under a temporary name, then renamed.

    ``df`` has shard, id and json. ``fetch_open`` gives the file system (an
    ``fsspec``- or ``pyarrow``-like object) on the executor. Writing again gives
    the same file, so a retried task is harmless. Returns (id, bytes).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, made = fetch_open(folder), None
        for batch in batches:
            sizes = []
            for shard, item, text in zip(batch["shard"], batch["id"], batch["json"]):
                if shard != made:
                    fs.create_dir(f"{folder}/{shard}", recursive=True)
                    made = shard
                at, data = f"{folder}/{shard}/{item}.json", text.encode()
                with fs.open_output_stream(at + ".tmp") as out:
                    out.write(data)
                fs.move(at + ".tmp", at)
                sizes.append(len(data))
            yield pd.DataFrame({"id": batch["id"], "bytes": sizes})

    return df.select("shard", "id", "json").repartition("shard").mapInPandas(run, "id long, bytes long")


def write_pairs(df: DataFrame, fetch_open: Callable[[str], object], folder: str, shared: bool = False) -> DataFrame:
    """Image and sidecar of an item: both temporary files first, then both renames.

    Tasks that write into one shard wait for each other at every change of its folder. With
    ``shared``, for shards that many tasks write into, the temporary files are in a hidden
    folder of the task's own; for others a rename inside one folder costs less."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, made, drafts = fetch_open(folder), None, f"{folder}/.pairs-{uuid.uuid4().hex}"
        if shared:
            fs.create_dir(drafts, recursive=True)
        for batch in batches:
            for shard, item, ext, content, text in zip(batch["shard"], batch["id"], batch["ext"], batch["content"], batch["json"]):
                if shard != made:
                    fs.create_dir(f"{folder}/{shard}", recursive=True)
                    made = shard
                names = {f"{item}{ext}": bytes(content), f"{item}.json": text.encode()}
                draft = drafts if shared else f"{folder}/{shard}"
                for name, data in names.items():
                    with fs.open_output_stream(f"{draft}/{name}.tmp") as out:
                        out.write(data)
                for name in names:
                    fs.move(f"{draft}/{name}.tmp", f"{folder}/{shard}/{name}")
            yield batch[["id"]]
        if shared:
            fs.delete_dir(drafts)

    return df.select("shard", "id", "ext", "content", "json").mapInPandas(run, "id long")


def write_review(df: DataFrame, path: str) -> None:
    """Comma-separated with a header; quotes are doubled, empty and null values are blank."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').option("emptyValue", "").csv(path)


def compact_parquet(df: DataFrame, path: str, target_bytes: int = 512 << 20, total_bytes: int | None = None) -> None:
    """Zstd Parquet in as few files as the target size allows.

    Without a known size the rows are written as they come, beside the path, and their
    files compacted by size (:func:`loomset.sinks.compaction.compact_files`)."""
    if total_bytes is not None:
        files = max(1, -(-total_bytes // target_bytes))
        df.repartition(files).write.mode("overwrite").option("compression", "zstd").parquet(path)
        return
    draft = f"{path.rstrip('/')}.draft"
    df.write.mode("overwrite").option("compression", "zstd").parquet(draft)
    compact_files(df.sparkSession, draft, path, target_bytes)
    at = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(draft)
    at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_index_cache(index: DataFrame, path: str) -> None:
    """The archive index as a table sorted by id, so that lookups prune row groups."""
    index.select("image_id", "archive", "inner_path").repartitionByRange("image_id").sortWithinPartitions("image_id").write.mode("overwrite").parquet(path)


def write_manifest(assigned: DataFrame, path: str) -> None:
    """(id, shard) sorted by id; shard counts and the current shard follow from it."""
    assigned.select("id", "shard").repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(path)


def write_progress(status: DataFrame, path: str) -> None:
    """(status, id) in order of both: sorted id lists as a table, not as one row each."""
    status.select("status", "id").distinct().repartitionByRange("status", "id").sortWithinPartitions("status", "id").write.mode("overwrite").parquet(path)


def append_status(rows: DataFrame, path: str) -> None:
    """(id, status, batch) appended; the table is its own history."""
    rows.select("id", "status", "batch").write.mode("append").parquet(path)


def current_status(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema("id long, status string, batch long").parquet(path)
    return rows.groupBy("id").agg(F.max_by("status", F.struct("batch", "status")).alias("status"))


def run_plan(plan: DataFrame, act: Callable[[str, str, str | None], None], commit: bool = False) -> DataFrame:
    """Apply a plan of (action, path, target) on the executors; a dry run, the
    default, only reports. Each row's outcome is returned; errors don't stop it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for action, path, target in zip(batch["action"], batch["path"], batch["target"]):
                try:
                    if commit and action != "none":
                        act(action, path, target)
                    out.append("done" if commit else "planned")
                except OSError as e:
                    out.append(f"failed: {e}")
            yield batch.assign(outcome=out)

    return plan.select("action", "path", "target").mapInPandas(run, "action string, path string, target string, outcome string")


def write_counted(results: DataFrame, path: str) -> dict[str, int]:
    """Write results (status, bytes, ...) and count them on the way, in the same job:
    rows and bytes of each of completed, failed, skipped and not_found."""
    seen = Observation()
    cells = []
    for name in ("completed", "failed", "skipped", "not_found"):
        mine = F.col("status") == name
        cells += [F.count(F.when(mine, 1)).alias(name), F.coalesce(F.sum(F.when(mine, F.col("bytes"))), F.lit(0)).cast("long").alias(f"{name}_bytes")]
    results.observe(seen, *cells).write.mode("overwrite").parquet(path)
    return seen.get


def fetch_items(items: DataFrame, fetch: Callable[[int], bytes | None], retries: int = 3, wait: float = 0.5) -> DataFrame:
    """(id, status, content): a pluggable fetch, retried, one status per item.

    Before the n-th further try it waits n times ``wait`` seconds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item in batch["id"]:
                status, content = "failed", None
                for attempt in range(retries):
                    try:
                        if attempt:
                            time.sleep(wait * attempt)
                        content = fetch(int(item))
                        status = "not_found" if content is None else "completed"
                        break
                    except OSError:
                        continue
                rows.append((item, status, content))
            yield pd.DataFrame(rows, columns=["id", "status", "content"])

    return items.select("id").mapInPandas(run, "id long, status string, content binary")
