"""Looking at the whole of an image file, in pieces of bounded size.

Three looks, as the image library of the replaced tools takes them: opening reads
headers up to the picture data; verifying reads a PNG's chunks to the end and checks
their sums; loading needs the picture data to be complete. Pixels of other formats
aren't decoded: a GIF's or JPEG's data counts as complete if its blocks or segments
reach their end, a WebP's if the container's lengths hold.

Defined cases: a null or unreadable file is file_not_found; an empty file is no
image; what follows the end of a picture is not looked at.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import MOST_PIXELS, open_at

PIECE = 1 << 20
FOUND = T.StructType(
    [T.StructField(n, T.IntegerType()) for n in ("width", "height")] + [T.StructField(n, T.StringType()) for n in ("error", "damage", "unreadable")]
)

# fixed values: names of the errors that the replaced tools report
NOT_AN_IMAGE, BOMB, NOT_FOUND, TRUNCATED, BROKEN = "not_an_image", "decompression_bomb", "file_not_found", "OSError", "SyntaxError"
# fixed values: channels of PNG colour types; start, step of its seven interlaced passes
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
_PASSES = [(0, 8, 0, 8), (4, 8, 0, 8), (0, 4, 4, 8), (2, 4, 0, 4), (0, 2, 2, 4), (1, 2, 0, 2), (0, 1, 1, 2)]


class Refused(Exception):
    """Opening fails: the reason."""


def _take(source: BinaryIO, size: int) -> bytes:
    """``size`` bytes or the error that a header cut short gives."""
    data = source.read(size)
    if len(data) < size:
        raise Refused(NOT_AN_IMAGE)
    return data


def _pieces(source: BinaryIO, size: int) -> Iterator[bytes]:
    """``size`` bytes in pieces; fewer at the end of the file."""
    while size > 0:
        data = source.read(min(size, PIECE))
        if not data:
            return
        size -= len(data)
        yield data


def _skip(source: BinaryIO, size: int, error: str) -> None:
    for data in _pieces(source, size):
        size -= len(data)
    if size > 0:
        raise Refused(error)


# ---------------------------------------------------------------------------- PNG
def _raw_size(width: int, height: int, depth: int, colour: int, interlaced: bool) -> int:
    """Bytes of the filtered rows."""
    bits, total = depth * _CHANNELS.get(colour, 1), 0
    for x, dx, y, dy in _PASSES if interlaced else [(0, 1, 0, 1)]:
        w, h = -(-(width - x) // dx), -(-(height - y) // dy)
        if w > 0 and h > 0:
            total += h * (1 + (w * bits + 7) // 8)
    return total


def _png(source: BinaryIO) -> tuple[int, int, str | None, str | None]:
    """After the signature."""
    size = header = None
    name, length = b"", 0
    while True:  # opening: chunks before the picture, whole and with right sums
        length, name = struct.unpack(">I4s", _take(source, 8))
        if not re.match(rb"\w{4}", name):
            raise Refused(NOT_AN_IMAGE)
        if name in (b"IDAT", b"IEND"):
            break
        total, kept = zlib.crc32(name), b""
        left = length
        for data in _pieces(source, length):
            total, left = zlib.crc32(data, total), left - len(data)
            kept = kept or data[:13]
        if left:
            raise Refused(f"invalid_image_{TRUNCATED}")
        if struct.unpack(">I", _take(source, 4))[0] != total:
            raise Refused(NOT_AN_IMAGE)
        if name == b"IHDR":
            if length < 13:
                raise Refused("invalid_image_ValueError")
            size, header = struct.unpack(">II", kept[:8]), kept
    if size is None or not all(size):
        raise Refused(NOT_AN_IMAGE)
    damage = unreadable = None
    inflate, made = zlib.decompressobj(), 0
    while name != b"IEND":  # verifying: the rest of the chunks; loading: the rows in them
        total, left = zlib.crc32(name), length
        for data in _pieces(source, length):
            total, left = zlib.crc32(data, total), left - len(data)
            while name == b"IDAT" and data and not unreadable and not inflate.eof:
                try:
                    made += len(inflate.decompress(data, PIECE))
                except zlib.error:
                    unreadable = TRUNCATED
                data = inflate.unconsumed_tail
        tail = source.read(4)
        if left:
            damage = TRUNCATED
        elif len(tail) < 4 or struct.unpack(">I", tail)[0] != total:
            damage = BROKEN
        if damage:
            break
        head = source.read(8)
        if len(head) < 8:
            damage = TRUNCATED
            break
        length, name = struct.unpack(">I4s", head)
        if not re.match(rb"\w{4}", name):
            damage = BROKEN
            break
    try:
        made += len(inflate.flush())
    except zlib.error:
        unreadable = TRUNCATED
    if made < _raw_size(*size, header[8], header[9], bool(header[12])):
        unreadable = TRUNCATED
    return *size, damage, unreadable


# --------------------------------------------------------------------------- JPEG
def _jpeg(source: BinaryIO) -> tuple[int, int, str | None, str | None]:
    """After the first marker; segments until the scan, then its data until the end mark."""
    size, mark = None, _take(source, 1)
    while True:
        while mark != b"\xff":
            mark = _take(source, 1)
        code = _take(source, 1)[0]
        if code in (0x00, 0xFF):
            mark = b"\xff" if code else _take(source, 1)
            continue
        if code == 0xD9 or 0xD0 <= code <= 0xD8 or code == 0x01:
            mark = _take(source, 1)
            continue
        length = struct.unpack(">H", _take(source, 2))[0] - 2
        if 0xC0 <= code <= 0xCF and code not in (0xC4, 0xC8, 0xCC):
            body = source.read(length)
            if len(body) < length:
                raise Refused(f"invalid_image_{TRUNCATED}")
            if length < 6:
                raise Refused(NOT_AN_IMAGE)
            height, width = struct.unpack(">HH", body[1:5])
            size = width, height
        else:
            _skip(source, length, f"invalid_image_{TRUNCATED}")
        if code == 0xDA:
            break
        mark = _take(source, 1)
    if size is None or not all(size):
        raise Refused(NOT_AN_IMAGE)
    last = b""
    while data := source.read(PIECE):
        if b"\xff\xd9" in last + data:
            return *size, None, None
        last = data[-1:]
    return *size, None, TRUNCATED


# ---------------------------------------------------------------------------- GIF
def _gif(source: BinaryIO) -> tuple[int, int, str | None, str | None]:
    """After the signature; blocks up to the first picture, then its sub-blocks."""
    width, height, flags, _, _ = struct.unpack("<HHBBB", _take(source, 7))
    if flags & 0x80:
        _skip(source, 3 << ((flags & 7) + 1), NOT_AN_IMAGE)
    if not (width and height):
        raise Refused(NOT_AN_IMAGE)
    while True:
        kind = source.read(1)
        if kind in (b"", b";"):  # no picture
            raise Refused(NOT_AN_IMAGE)
        if kind == b"!":
            _take(source, 1)
            while size := _take(source, 1)[0]:
                _skip(source, size, NOT_AN_IMAGE)
        elif kind == b",":
            flags = _take(source, 9)[8]
            if flags & 0x80:
                _skip(source, 3 << ((flags & 7) + 1), NOT_AN_IMAGE)
            _take(source, 1)
            break
    while True:
        size = source.read(1)
        if not size:
            return width, height, None, TRUNCATED
        if not size[0]:
            return width, height, None, None
        if len(source.read(size[0])) < size[0]:
            return width, height, None, TRUNCATED


# --------------------------------------------------------------------------- WebP
def _webp(source: BinaryIO, total: int) -> tuple[int, int, str | None, str | None]:
    """After the container's head of 12 bytes; ``total`` bytes follow its length field."""
    size, left = None, total - 4
    while left >= 8:
        kind, length = struct.unpack("<4sI", _take(source, 8))
        padded = length + (length & 1)
        if padded > left - 8 + 1:
            raise Refused(NOT_AN_IMAGE)
        head = _take(source, min(length, 10))
        if size is None and kind == b"VP8X" and length >= 10:
            size = int.from_bytes(head[4:7], "little") + 1, int.from_bytes(head[7:10], "little") + 1
        elif size is None and kind == b"VP8L" and length >= 5:
            n = int.from_bytes(head[1:5], "little")
            size = (n & 0x3FFF) + 1, (n >> 14 & 0x3FFF) + 1
        elif size is None and kind == b"VP8 " and length >= 10:
            w, h = struct.unpack("<HH", head[6:10])
            size = w & 0x3FFF, h & 0x3FFF
        _skip(source, padded - len(head), NOT_AN_IMAGE)
        left -= 8 + padded
    if size is None or not all(size):
        raise Refused(NOT_AN_IMAGE)
    return *size, None, None


def verify(source: BinaryIO) -> tuple[int | None, int | None, str | None, str | None, str | None]:
    """(width, height, error, damage, unreadable) of a stream.

    ``error``: why it can't be opened; ``damage``: what verifying finds; ``unreadable``:
    what loading finds; each null if nothing is wrong."""
    try:
        head = source.read(3)
        if head == b"\xff\xd8\xff":
            found = _jpeg(io.BufferedReader(_Again(source, b"\xff"), PIECE))
        elif head == b"GIF" and source.read(3) in (b"87a", b"89a"):
            found = _gif(source)
        elif head == b"\x89PN" and source.read(5) == b"G\r\n\x1a\n":
            found = _png(source)
        elif head == b"RIF" and source.read(1) == b"F":
            total = struct.unpack("<I", _take(source, 4))[0]
            if _take(source, 4) != b"WEBP":
                raise Refused(NOT_AN_IMAGE)
            found = _webp(source, total)
        else:
            raise Refused(NOT_AN_IMAGE)
    except Refused as e:
        return None, None, str(e), None, None
    width, height, damage, unreadable = found
    return width, height, BOMB if width * height > MOST_PIXELS else None, damage, unreadable


class _Again(io.RawIOBase):
    """A stream with some bytes put back before it."""

    def __init__(self, source: BinaryIO, before: bytes):
        self.source, self.before = source, before

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.before or self.source.read(len(into))
        self.before = b""
        into[: len(data)] = data
        return len(data)


_NOTHING = (None, None, NOT_FOUND, None, None)


def verified_files(files: DataFrame, path: str = "path") -> DataFrame:
    """The rows with what :func:`verify` finds, each file opened and read on an executor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for at in batch[path]:
                try:
                    with open_at(at) as source:
                        rows.append(verify(source))
                except (OSError, AttributeError):  # gone, or no path
                    rows.append(_NOTHING)
            found = pd.DataFrame(rows, columns=FOUND.names, index=batch.index)
            yield pd.concat([batch, found.astype({"width": "Int32", "height": "Int32"})], axis=1)

    return files.mapInPandas(run, T.StructType([*files.schema.fields, *FOUND.fields]))


@F.pandas_udf(FOUND)
def verified_content(content: pd.Series) -> pd.DataFrame:
    """What :func:`verify` finds in binary values."""
    rows = [verify(io.BytesIO(c)) if c is not None else _NOTHING for c in content]
    return pd.DataFrame(rows, columns=FOUND.names).astype({"width": "Int32", "height": "Int32"})
