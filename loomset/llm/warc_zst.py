"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of about ``FRAME_BYTES``. A bundle
is those frames, a skippable frame that maps record identifiers to (frame,
offset inside the decompressed frame, length), and the seekable format's seek
table as a last skippable frame with its footer. Plain zstd tools read the
records; a reader that wants one record decompresses one frame.

Every record has an identifier of its own: page id, a hash of url and payload, and
a number that tells equal rows apart. Readers go by the index: ``records`` takes a
frame's records at their offsets, ``get`` decompresses one frame, and
``fetch_records`` does so on the executors for any table of identifiers.

Equal payloads of at least ``MIN_DUPLICATE`` bytes are stored once: the record
with the smallest page id is the response, the others are revisit records that
name it, its digest and the payload's length. Digests are grouped by a partial
aggregate and joined back without the payloads, so a payload that a
third of all pages share moves only its 64 digits, and the join that brings them
back is one that adaptive execution may split.

Defined cases: null html is an empty payload; null page ids are written with an
empty page id, never deduplicated; repeated page ids each get a record (of equal
payloads one row is the response, all others revisit it, wholly equal rows too);
null urls give an empty target; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, map_blob, read_blobs, write_blobs

#: Fixed values of the seekable format (magic numbers, little-endian).
SKIPPABLE_SEEK, SKIPPABLE_INDEX, FOOTER_MAGIC = 0x184D2A5E, 0x184D2A5D, struct.pack("<I", 0x8F92EAB1)
FRAME_BYTES, BUNDLE_BYTES, MIN_DUPLICATE = 1 << 18, 8 << 20, 100
_ENTRY = np.dtype([("frame", "<u4"), ("offset", "<u4"), ("length", "<u4")])


def record_id(page_id: int | None, row: int, nth: int) -> str:
    return f"{'' if page_id is None else page_id}:{row & (1 << 64) - 1:016x}:{nth}"


def record(key: str, url: str, payload: bytes, digest: str, size: int, refers_to: str | None) -> bytes:
    """One WARC record; ``key`` and ``refers_to`` are record identifiers."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{key}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        payload = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, where the next record starts)."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(headers["Content-Length"])
    return headers, data[stop + 4 : stop + 4 + size], stop + 4 + size + 4


class BundleWriter:
    """Collects records; ``finish`` gives the bundle without its last four bytes."""

    def __init__(self, level: int = 3):
        self.zstd, self.frames, self.table, self.ids, self.where = zstandard.ZstdCompressor(level=level), [], [], [], []
        self.open, self.held, self.size = [], 0, 0

    def add(self, key: str, data: bytes) -> None:
        self.ids.append(key)
        self.where.append((len(self.frames), self.held, len(data)))
        self.open.append(data)
        self.held += len(data)
        if self.held >= FRAME_BYTES:
            self._close()

    def _close(self) -> None:
        if self.open:
            frame = self.zstd.compress(b"".join(self.open))
            self.frames.append(frame)
            self.table.append((len(frame), self.held))
            self.size += len(frame)
            self.open, self.held = [], 0

    def finish(self) -> bytes:
        self._close()
        names = json.dumps(self.ids).encode()
        index = self.zstd.compress(struct.pack("<II", len(self.ids), len(names)) + names + np.array(self.where, _ENTRY).tobytes())
        # every frame before the seek table has an entry, the index as one of no content
        table = [*self.table, (len(index) + 8, 0)]
        seek = b"".join(struct.pack("<II", *x) for x in table) + struct.pack("<IB", len(table), 0)
        return b"".join([*self.frames, struct.pack("<II", SKIPPABLE_INDEX, len(index)), index, struct.pack("<II", SKIPPABLE_SEEK, len(seek) + 4), seek])


class Bundle:
    """Frame-wise and record-wise reader of a bundle's bytes (or memory map)."""

    def __init__(self, data: bytes | np.ndarray):
        self.data = memoryview(data)
        if bytes(self.data[-4:]) != FOOTER_MAGIC:
            raise ValueError("no seek table: not a bundle, or cut short")
        (count,) = struct.unpack("<I", self.data[-9:-5])
        table = np.frombuffer(self.data[len(self.data) - 9 - 8 * count : len(self.data) - 9], "<u4").reshape(-1, 2).astype(np.int64)
        #: Where the frames of records begin, and last the index.
        self.starts = np.concatenate([[0], np.cumsum(table[:-1, 0])])
        self.zstd = zstandard.ZstdDecompressor()
        self._index = None

    def frame(self, i: int) -> bytes:
        return self.zstd.decompress(self.data[self.starts[i] : self.starts[i + 1]])

    def scan(self) -> Iterator[tuple[dict[str, str], bytes]]:
        """All records one after the other, without the index."""
        for i in range(len(self.starts) - 1):
            data, at = self.frame(i), 0
            while at < len(data):
                headers, payload, at = parse(data, at)
                yield headers, payload

    def records(self, keys: list[str] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
        """All records, or those of some identifiers, by the index; a frame is decompressed once."""
        index = self.index()
        spots = sorted((*index[k][:2], k) for k in (index if keys is None else keys))
        frame, data = -1, b""
        for i, offset, key in spots:
            if i != frame:
                frame, data = i, self.frame(i)
            headers, payload, _ = parse(data, offset)
            if headers["WARC-Record-ID"] != f"<urn:page:{key}>":
                raise ValueError(f"the index leads to another record than {key}")
            yield headers, payload

    def index(self) -> dict[str, tuple[int, int, int]]:
        """Record identifier -> (frame, offset inside the frame, length)."""
        if self._index is None:
            at = int(self.starts[-1])
            _, size = struct.unpack("<II", self.data[at : at + 8])
            raw = self.zstd.decompress(self.data[at + 8 : at + 8 + size])
            n, names = struct.unpack("<II", raw[:8])
            where = np.frombuffer(raw[8 + names :], _ENTRY, n)
            self._index = {k: tuple(map(int, w)) for k, w in zip(json.loads(raw[8 : 8 + names]), where)}
            if len(self._index) != n:
                raise ValueError("record identifiers repeat")
        return self._index

    def get(self, key: str) -> tuple[dict[str, str], bytes]:
        frame, offset, _ = self.index()[key]
        return parse(self.frame(frame), offset)[:2]


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, row, nth, url, html (null for revisits), digest, size, refers_to, refers_row per row."""
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), html.alias("html"),
        F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("size"),
    )
    rows = rows.withColumn("row", F.xxhash64("url", "html"))
    named = rows.where(F.col("page_id").isNotNull())
    marks = named.where(F.col("size") >= MIN_DUPLICATE).select("digest", "page_id", "row")
    # several rows may repeat an id: the smallest row mark of the smallest id is the response
    # grouped by a hash as well, so that the join has a partitioning of its own and a hot digest may be split
    first = marks.groupBy("digest", F.xxhash64("digest").alias("h")).agg(F.min(F.struct("page_id", "row")).alias("f"), F.count("*").alias("n")).where("n > 1").select("digest", "f")
    twice = marks.join(first, "digest").select("page_id", "row", F.col("f.page_id").alias("refers_to"), F.col("f.row").alias("refers_row")).distinct()
    nth = F.row_number().over(Window.partitionBy("page_id", "row").orderBy("size")) - 1
    joined = named.withColumn("nth", nth.cast("long")).join(twice, ["page_id", "row"], "left")
    response = (F.col("page_id") == F.col("refers_to")) & (F.col("row") == F.col("refers_row")) & (F.col("nth") == 0)
    again = F.col("refers_to").isNotNull() & ~response
    cut = [F.when(again, F.col(c)).alias(c) for c in ("refers_to", "refers_row")]
    joined = joined.select("page_id", "row", "nth", "url", F.when(~again, F.col("html")).alias("html"), "digest", "size", *cut)
    nameless = rows.where(F.col("page_id").isNull()).withColumns({"nth": F.monotonically_increasing_id(), "refers_to": F.lit(None).cast("long"), "refers_row": F.lit(None).cast("long")})
    return joined.unionByName(nameless.select(*joined.columns))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Bundles of about BUNDLE_BYTES under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = BundleWriter()
        for batch in batches:
            for columns in zip(*(c for c in batch.columns)):
                page_id, row, nth, url, html, digest, size, refers_to, refers_row = (x.as_py() for x in columns)
                key = record_id(page_id, row, nth)
                out.add(key, record(key, url, (html or "").encode(), digest, size, None if refers_to is None else record_id(refers_to, refers_row, 0)))
                if out.size >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_pydict({"bundle": pa.array([out.finish()], pa.binary())})
                    out = BundleWriter()
        if out.ids:
            yield pa.RecordBatch.from_pydict({"bundle": pa.array([out.finish()], pa.binary())})

    write_blobs(plan_records(pages, id_col, url_col, html_col).mapInArrow(run, "bundle binary"), "bundle", path, FOOTER_MAGIC)


_FIELDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "record_id": pa.string(), "url": pa.string(), "payload": pa.binary()}
_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string"


def _page(urn: str) -> int | None:
    found = urn.removeprefix("<urn:page:").split(":")[0]
    return int(found) if found else None


def _read(bundle: Bundle, with_payload: bool, keys: list[str] | None = None) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def pack() -> pa.RecordBatch:
        names = list(_FIELDS)[: 8 if with_payload else 7]
        return pa.RecordBatch.from_arrays([pa.array(c, _FIELDS[n]) for c, n in zip(zip(*rows), names)], names)

    for headers, payload in bundle.records(keys):
        size, digest = int(headers["WARC-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha256:")
        kind, own = headers["WARC-Type"], headers["WARC-Record-ID"]
        if kind == "response" and (len(payload), hashlib.sha256(payload).hexdigest()) != (size, digest):
            raise ValueError(f"payload of {own} does not match its digest")
        refers = _page(headers["WARC-Refers-To"]) if kind == "revisit" else None
        row = (_page(own), size, digest, kind, refers, own.removeprefix("<urn:page:").removesuffix(">"), headers["WARC-Target-URI"])
        rows.append((*row, payload) if with_payload else row)
        if len(rows) == 2000:
            yield pack()
            rows = []
    if rows:
        yield pack()


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, record_id, url [, payload] per record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from _read(Bundle(content.as_buffer()), with_payload)

    return read_blobs(spark, path).select("content").mapInArrow(run, _SCHEMA + ", payload binary" * with_payload)


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, uri, frame, offset, length) of every record, from the bundles' index frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                found = Bundle(map_blob(uri)).index()
                where = list(zip(*found.values()))
                yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([uri] * len(found)), *(pa.array(w, pa.int64()) for w in where)], ["record_id", "uri", "frame", "offset", "length"])

    return read_blobs(spark, path).select("path").mapInArrow(run, "record_id string, uri string, frame long, offset long, length long")


def fetch_records(index: DataFrame) -> DataFrame:
    """The records of some rows of an index, payloads included: only their frames are decompressed."""
    placed = index.select("uri", "record_id").repartition("uri").sortWithinPartitions("uri")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uris, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(uris):
                stop = at
                while stop < len(uris) and uris[stop] == uris[at]:
                    stop += 1
                yield from _read(Bundle(map_blob(uris[at])), True, keys[at:stop])
                at = stop

    return placed.mapInArrow(run, _SCHEMA + ", payload binary")


def archive_and_read(pages: DataFrame) -> DataFrame:
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
