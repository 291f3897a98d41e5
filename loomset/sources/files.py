"""File inventories, JSON trees, archive members, manifests and progress files."""

from __future__ import annotations

import io
import os
import struct
import tarfile
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import IMAGE_EXTENSIONS, id_from_key, id_from_name
from . import state


# fixed value: pixels beyond which an image counts as a decompression bomb
MOST_PIXELS = 2 * (1024 * 1024 * 1024 // 4 // 3)


#: Folders that a task lists.
FOLDERS_A_TASK = 100
#: Entries, or bytes of contents, that a task hands over at a time.
_ROWS, _BYTES = 10_000, 16 << 20


def _folder(path: str) -> str | None:
    """A folder's path as Spark's listings give it; None for what only Spark's own listing
    takes: stores that ``pyarrow.fs`` doesn't open, patterns, single files, relative paths."""
    if path.startswith(("file:", "/")):
        at = "/" + path.removeprefix("file:").strip("/")
        return f"file:{at}".rstrip("/") if os.path.isdir(at) else None
    try:
        store, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
        return path.rstrip("/") if store.get_file_info(name).type == fs.FileType.Directory else None
    except (ValueError, OSError):
        return None


def _entries(folder: str) -> Iterator[tuple[str, bool, int]]:
    """(path, whether a folder, size) of what Spark's listings show of a folder; one by
    one where the store is local."""
    if folder.startswith("file:"):
        with os.scandir(folder.removeprefix("file:") or "/") as found:
            for entry in found:
                try:
                    inner = entry.is_dir()
                    size = 0 if inner else entry.stat().st_size
                except FileNotFoundError:  # gone since
                    continue
                yield entry.name, inner, size
    else:
        store, name = fs.FileSystem.from_uri(quote(folder, safe="/:@"))
        for info in store.get_file_info(fs.FileSelector(name)):
            yield info.base_name, info.type == fs.FileType.Directory, info.size or 0


def _hidden(name: str) -> bool:
    """As Spark's listings have it."""
    hidden = name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")
    return hidden and not name.startswith(("_common_metadata", "_metadata"))


def _list(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for folder in batch["path"]:
            rows = []
            for name, inner, size in _entries(folder):
                if not _hidden(name):
                    rows.append((f"{folder}/{name}", inner, size))
                if len(rows) >= _ROWS:
                    yield pd.DataFrame(rows, columns=["path", "folder", "size"])
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=["path", "folder", "size"])


def _found(spark: SparkSession, root: str, recursive: bool) -> DataFrame:
    """(path, size) of the files below a folder as they are now. Tasks list the folders of
    a level and write what they find to a scratch table, where the next level's are read."""
    at, kind, level = state.scratch(spark, "listing"), "path string, folder boolean, size long", 0
    folders, many = spark.createDataFrame([(root,)], "path string"), 1
    while many:
        tasks = max(-(-many // FOLDERS_A_TASK), min(many, spark.sparkContext.defaultParallelism))
        rows = folders.repartition(tasks, "path").mapInPandas(_list, kind)
        # the files of few folders are dealt out, for what is done with them next
        rows = rows.repartition("path") if many < 2 * spark.sparkContext.defaultParallelism else rows
        rows.write.parquet(f"{at}/{level}")
        folders = spark.read.schema(kind).parquet(f"{at}/{level}").where("folder").select("path")
        many, level = folders.count() if recursive else 0, level + 1
    return spark.read.schema(kind).parquet(*[f"{at}/{k}" for k in range(level)]).where("NOT folder").select("path", "size")


def inventory(spark: SparkSession, path: str, recursive: bool = False, glob: str | None = None) -> DataFrame:
    """(path, dir, shard, name, stem, ext, size) of files as they are now; contents are not read.

    Executors list the folders, level by level; one folder is listed by one task. What
    :func:`_folder` can't take is listed by Spark, with all files in the driver's memory
    and empty ones left out."""
    root = _folder(path)
    if root is None:
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        files = reader.load(path).select("path", F.col("length").alias("size"))
    else:
        files = _found(spark, root, recursive)
    name = F.substring_index("path", "/", -1)  # no pattern: one that ends at the end is tried at every letter
    if root is not None and glob:
        files = files.where(name.rlike(f"^(?:{spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern.compile(glob).pattern()})\\z"))
    ext = F.lower(F.regexp_extract(name, r".(\.[^.]*)\z", 1))
    folder = F.left("path", F.length("path") - F.length(name) - 1)
    return files.select(
        "path", folder.alias("dir"), F.substring_index(folder, "/", -1).alias("shard"), name.alias("name"),
        F.when(ext == "", name).otherwise(F.regexp_replace(name, r"\.[^.]*\z", "")).alias("stem"), ext.alias("ext"), "size",
    )


def listed(files: DataFrame, extensions: list[str]) -> DataFrame:
    """Visible files of the given extensions, by name."""
    return files.where(F.col("ext").isin(*extensions) & ~F.col("name").startswith(".")).orderBy("name")


def shard_ids(files: DataFrame, kind: str = "image") -> DataFrame:
    """(id, shard) of digit-named files in shard_* folders: kind image, json or any."""
    exts = {"image": IMAGE_EXTENSIONS, "json": [".json"], "any": None}[kind]
    rows = files.where(F.col("shard").rlike(r"^shard_") & F.col("stem").rlike(r"^\d+\z"))
    rows = rows if exts is None else rows.where(F.col("ext").isin(*exts))
    return rows.select(F.col("stem").cast("bigint").alias("id"), "shard").distinct()


def json_texts(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(path, text) per JSON file, byte-order mark removed; opened on executors where they can list the folder."""
    if _folder(path) is None:
        reader = spark.read.option("wholetext", "true").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.json")
        found = reader.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    else:
        found = texts_of(inventory(spark, path, recursive).where(F.col("name").endswith(".json")).select("path"))
    return found.select("path", F.regexp_replace("text", "^﻿", "").alias("text"))


def open_at(path: str):
    """A seekable stream of a file by the path that Spark's listings give, which is not URL-encoded."""
    if path.startswith(("file:", "/")):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    store, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return store.open_input_file(name)


def tar_members(spark: SparkSession, path: str, glob: str = "*.tar", stream: bool = True) -> DataFrame:
    """(archive, member, size, pos, image_id) of each regular member, read archive by archive.

    Executors open archives and skip from header to header, whatever their size.
    ``stream=False`` hands whole archives (under 2 GB) over from Spark's reader, for
    stores that only Spark reaches.
    """
    return members_of(spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", *([] if stream else ["content"])))


def members_of(archives: DataFrame) -> DataFrame:
    """The same of given archives: (path) or (path, content)."""

    def rows(at: str, source) -> pd.DataFrame:
        with tarfile.open(fileobj=source) as tar:
            found = [(at.rsplit("/", 1)[-1], m.name, m.size, i) for i, m in enumerate(tar) if m.isfile()]
        return pd.DataFrame(found, columns=["archive", "member", "size", "pos"])

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at, *content in batch.itertuples(index=False):
                if content:
                    yield rows(at, io.BytesIO(content[0]))
                else:
                    with open_at(at) as source:
                        yield rows(at, source)

    found = archives.mapInPandas(members, "archive string, member string, size long, pos long")
    return found.withColumn("image_id", id_from_name(F.col("member")))


def manifest_entries(texts: DataFrame, archive: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """(archive, image_id, inner_path) and the columns ``keep`` from the five shapes of JSON manifest.

    {"files": {name: ...}}, {"files": [name]}, {name: {...}}, {id or name: path}, [name].
    Names without a number yield nothing, and neither does text that is no JSON.
    """
    v = F.try_parse_json("text")
    files = F.try_variant_get(v, "$.files", "variant")
    base = texts.select(archive.alias("archive"), *keep, files.isNotNull().alias("_files"), F.coalesce(files, v).alias("_v"))
    entries = base.lateralJoin(base.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    rows = entries.select("archive", *keep, "_files", "key", F.try_variant_get("value", "$", "string").alias("text"), F.schema_of_variant("value").alias("kind"))
    said = F.when(F.col("kind") == "STRING", F.col("text"))
    name = F.coalesce("key", said)
    path = F.when(F.col("key").isNotNull() & ~F.col("_files"), F.coalesce(said, "key")).otherwise(name)
    found = rows.select("archive", *keep, id_from_name(name).alias("image_id"), path.alias("inner_path"))
    return found.where(F.col("image_id").isNotNull() & F.col("inner_path").isNotNull())


#: Names of an archive's manifest in order of preference, after the archive's name without its ending.
MANIFESTS = (".json", "_manifest.json", "_files.json")


def texts_of(found: DataFrame, path: str = "path") -> DataFrame:
    """Rows with the ``text`` of their file, opened on an executor; bytes that are no UTF-8 are replaced."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, held, start = [], 0, 0
            for k, at in enumerate(batch[path], 1):
                with open_at(at) as source:
                    data = source.read()
                texts.append(data.decode("utf-8", "replace"))
                held += len(data)
                if held >= _BYTES or k == len(batch):
                    yield batch.iloc[start:k].assign(text=texts)
                    texts, held, start = [], 0, k

    return found.mapInPandas(run, T.StructType([*found.schema.fields, T.StructField("text", T.StringType())]))


def archive_index(spark: SparkSession, path: str, glob: str = "*.tar", scan: bool = True) -> DataFrame:
    """(archive, image_id, inner_path): of each archive the first of its manifests that yields
    entries, else, with ``scan``, its members by their headers.

    Only manifests that stand beside an archive are read, and only archives without a
    usable one are opened."""
    archives = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", F.regexp_extract("path", r"([^/]*)\z", 1).alias("archive"))
    base = F.regexp_replace("path", r"\.[^./]*\z", "")
    tries = archives.select("archive", F.posexplode(F.array(*[F.concat(base, F.lit(m)) for m in MANIFESTS])).alias("rank", "path"))
    there = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path).select("path")
    read = texts_of(tries.join(there, "path").select("path", "archive", "rank"))
    entries = manifest_entries(read, F.col("archive"), keep=("rank",))
    # the least rank with entries: a row an archive, however many entries one has
    best = entries.groupBy("archive").agg(F.min("rank").alias("rank"))
    chosen = entries.join(best, ["archive", "rank"]).select("archive", "image_id", "inner_path")
    if not scan:
        return chosen
    rest = members_of(archives.join(best, "archive", "left_anti").select("path"))
    return chosen.unionByName(rest.where(F.col("image_id").isNotNull()).select("archive", "image_id", F.col("member").alias("inner_path")))


def progress(spark: SparkSession, path: str) -> DataFrame:
    """(id, status) from a progress file; a missing key is an empty list."""
    raw = spark.read.schema("completed_ids array<bigint>, missing_ids array<bigint>").option("multiLine", "true").json(path)
    parts = [raw.select(F.explode(c).alias("id"), F.lit(s).alias("status")) for c, s in (("completed_ids", "completed"), ("missing_ids", "missing"))]
    return parts[0].unionByName(parts[1]).distinct()


def _probe(data: bytes) -> tuple[int | None, int | None, str | None]:
    """Width and height from a PNG, GIF, JPEG or WebP header."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n":
            return *struct.unpack(">II", data[16:24]), None
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return *struct.unpack("<HH", data[6:10]), None
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            if data[12:16] == b"VP8X":
                return int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1, None
            if data[12:16] == b"VP8L":
                n = int.from_bytes(data[21:25], "little")
                return (n & 0x3FFF) + 1, (n >> 14 & 0x3FFF) + 1, None
            w, h = struct.unpack("<HH", data[26:30])
            return w & 0x3FFF, h & 0x3FFF, None
        if data[:2] == b"\xff\xd8":
            at = 2
            while at + 9 < len(data):
                marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
                if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h, None
                at += 2 + size
        return None, None, "not_an_image"
    except struct.error:
        return None, None, "not_an_image"


_PROBED = T.StructType([T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_PROBED)
def image_probe(content: pd.Series) -> pd.DataFrame:
    """Size of an image from its header bytes, or why it can't be told."""
    rows = [_probe(bytes(c)) if c is not None else (None, None, "file_not_found") for c in content]
    bomb = lambda r: (r[0], r[1], "decompression_bomb") if r[0] and r[0] * r[1] > MOST_PIXELS else r
    return pd.DataFrame([bomb(r) for r in rows], columns=["width", "height", "error"])
