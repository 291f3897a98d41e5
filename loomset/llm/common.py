"""Helpers shared by the operators of this subpackage.

Two things live here: the shared folder (tables and files that any executor
can read again after another one is lost) and splitting of text columns into
words, in chunks of bounded size.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The six white-space characters of the contracts: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\f\r"


# ---------------------------------------------------------------- shared folder
def shared_dir(spark: SparkSession) -> str:
    """The folder every executor shares: ``spark.checkpoint.dir`` of the session.

    Only a local master without that setting gets a folder of its own (tests);
    a cluster without it is an error, because a machine-local folder would not
    be visible to the other executors.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loomset-shared-")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_ROOTS: dict[tuple[str, str], str] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder for an intermediate.

    An application has one folder for these, removed when the driver's JVM ends;
    what shall outlive it is written to a path of the caller's own.
    """
    key = (spark.sparkContext.applicationId, shared_dir(spark))
    if key not in _ROOTS:
        _ROOTS[key] = f"{shared_dir(spark)}/loomset/{uuid.uuid4().hex}"
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_ROOTS[key])
        fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    return f"{_ROOTS[key]}/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Spark's own file system layer."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


# ------------------------------------------------------------------ binary files
def write_blobs(df: DataFrame, column: str, path: str, magic: bytes) -> None:
    """One binary file per row, written and committed by Spark on any store.

    The text writer copies a string's bytes unchanged and ends each row with
    ``lineSep``; with one row per file and the format's own last four bytes as
    that separator the files are exactly ``blob + magic``.
    """
    (
        df.select(F.col(column).cast("string"))
        .write.option("maxRecordsPerFile", 1)
        .option("encoding", "ISO-8859-1")
        .option("lineSep", magic.decode("latin-1"))
        .text(path)
    )


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the files that :func:`write_blobs` made."""
    # an empty first partition leaves an empty file
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).where(F.col("length") > 0)


def list_blobs(spark: SparkSession, path: str) -> list[str]:
    """Their URIs; as many as shards, never as rows."""
    return sorted(r.path for r in read_blobs(spark, path).select("path").collect())


def read_head(uri: str, size: int) -> bytes:
    """The first bytes of a shared file."""
    if uri.startswith(("file:", "/")):  # a path as Spark lists it, not URL-encoded
        with open("/" + uri.removeprefix("file:").lstrip("/"), "rb") as f:
            return f.read(size)
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(quote(uri, safe="/:@"))
    with store.open_input_file(at) as f:
        return f.read(size)


_OPEN: dict[str, np.ndarray] = {}


def map_blob(uri: str) -> np.ndarray:
    """A memory-mapped view of a shared file, opened once per Python worker.

    A file of a store without a mounted path is read through ``pyarrow.fs`` and
    held in memory; no local folder takes part.
    """
    if uri not in _OPEN:
        if uri.startswith(("file:", "/")):  # a path as Spark lists it, not URL-encoded
            handle = open("/" + uri.removeprefix("file:").lstrip("/"), "rb")
        else:
            from pyarrow import fs

            store, at = fs.FileSystem.from_uri(quote(uri, safe="/:@"))
            with store.open_input_file(at) as src:
                _OPEN[uri] = np.frombuffer(src.read(), np.uint8)
            return _OPEN[uri]
        size = os.fstat(handle.fileno()).st_size
        _OPEN[uri] = np.frombuffer(mmap.mmap(handle.fileno(), size, access=mmap.ACCESS_READ), np.uint8) if size else np.zeros(0, np.uint8)
        handle.close()
    return _OPEN[uri]


# -------------------------------------------------------------- columns and ids
def ascii_lower(col: Column) -> Column:
    """A-Z only; the quick built-in serves where both agree (ASCII texts)."""
    return F.when(F.length(col) == F.octet_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % k


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ------------------------------------------------------------------------- words
#: Bytes of text worked on at once: memory follows this, not a batch or a text.
CHUNK_BYTES = 1 << 21
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS.encode())] = True
#: Bytes with A-Z lower-cased; and with all ASCII but letters and digits blanked as well.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_LETTERS = _LOWER.copy()
_LETTERS[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool, bool]]:
    """(number of the first text, offsets, bytes, opens, closes) of pieces, one per text from it on.

    A text over the limit comes in several chunks of one piece each, cut after a
    blank; only a single word that long is kept whole. ``opens`` and ``closes`` tell
    whether the chunk begins and ends with its texts. Null is empty.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    _, off, buf = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = min(n, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        if j > i:
            yield i, offsets[i : j + 1] - offsets[i], data[offsets[i] : offsets[j]], True, True
            i = j
            continue
        start, end = int(offsets[i]), int(offsets[i + 1])
        while start < end:
            stop = min(start + limit, end)
            if stop < end:
                before = np.flatnonzero(_BLANK[data[max(start, stop - (1 << 16)) : stop]])
                if len(before):
                    stop = max(start, stop - (1 << 16)) + int(before[-1]) + 1
                else:
                    while stop < end and not _BLANK[data[stop]]:
                        after = np.flatnonzero(_BLANK[data[stop : min(end, stop + (1 << 16))]])
                        stop = stop + int(after[0]) if len(after) else min(end, stop + (1 << 16))
            yield i, np.array([0, stop - start], np.int64), data[start:stop], start == offsets[i], stop == end
            start = stop
        i += 1


def split_words(offsets: np.ndarray, data: np.ndarray, letters_only: bool = False) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """(number of each word's form in order, the distinct forms, words per piece).

    Words are runs of anything but the six blanks, A-Z lower-cased, or with
    ``letters_only`` runs of letters, digits and non-ASCII bytes. Forms are told
    apart by their bytes, never by a hash alone.
    """
    table = _LETTERS if letters_only else _LOWER
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(table[data])])
    lists = pc.ascii_split_whitespace(pieces.view(pa.large_string()))
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    sums = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    bounds = lists.offsets.to_numpy()
    coded = words.filter(full).dictionary_encode()
    forms = coded.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
    return coded.indices.to_numpy(), forms, np.diff(sums[bounds - bounds[0]])


def word_hashes(texts: pa.Array, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit XXH3 of all words in order, words per text), for features that are hashed anyway."""
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(texts), np.int64)
    for first, offsets, data, *_ in text_chunks(texts):
        index, forms, sizes = split_words(offsets, data, letters_only)
        known = np.fromiter(map(xxhash.xxh3_64_intdigest, forms), np.uint64, len(forms))
        hashes.append(known[index])
        counts[first : first + len(sizes)] += sizes
    return np.concatenate(hashes), counts


def distinct(x: np.ndarray) -> np.ndarray:
    """Ascending distinct values, by sorting."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(batch: pa.RecordBatch, column: int, limit: int = 4 * CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a batch with about ``limit`` bytes of a text column each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, bytes) of a text column; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, off, buf = texts.buffers()
    offsets = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]
