"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

The rank file is read once where the plan is built and shipped as one broadcast
of fixed size (under 1 MB), so no executor needs the path. Texts longer than
``SAFE_CHARS`` are cut at safe boundaries, places where the splitting pattern
always ends a match, so the pieces' ids concatenate to the text's ids. A run
without such a boundary (a million blanks overflow the library's regex engine)
is split by the ``regex`` module and each match encoded on its own, the same
ids again. Decoding returns raw bytes; ids need not form valid UTF-8.

Defined cases: null text is encoded as empty (no ids, no bytes); an unknown id
is an error; rows are neither dropped nor reordered, null and repeated document
ids included, and no column but the id and the text is looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest text handed to the library whole.
SAFE_CHARS = 50_000


def load_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


class Codec:
    """Encode and decode by a rank file's bytes and a splitting pattern."""

    def __init__(self, ranks: bytes, pattern: str, safe_chars: int = SAFE_CHARS):
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.safe_chars = safe_chars
        #: After a visible character and before a blank, or between a letter and a digit.
        self.boundary = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")

    def pieces(self, text: str) -> Iterator[str]:
        """Cuts of about safe_chars at safe boundaries; a longer one has none inside."""
        start = 0
        while len(text) - start > self.safe_chars:
            cut = self.boundary.search(text, start + self.safe_chars // 2)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if len(text) <= self.safe_chars:
            return self.encoding.encode_ordinary(text)
        out: list[int] = []
        for piece in self.pieces(text):
            if len(piece) <= self.safe_chars:
                out += self.encoding.encode_ordinary(piece)
            else:
                for match in self.pattern.finditer(piece):
                    out += self.encoding._encode_single_piece(match.group())
        return out

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


_CODECS: dict[tuple, Codec] = {}


def codec_of(ranks: bytes, pattern: str) -> Codec:
    """One codec per Python worker and rank file."""
    key = (hash(ranks), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """(doc_id, ids array<int> [, decoded binary]) per row, without a shuffle."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks.value, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids = [codec.encode(t) for t in batch.column(1).to_pylist()]
                columns = {"doc_id": batch.column(0), "ids": pa.array(ids, pa.list_(pa.int32()))}
                if decode:
                    columns["decoded"] = pa.array([codec.decode(x) for x in ids], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return picked.mapInArrow(run, f"doc_id {id_type}, ids array<int>" + ", decoded binary" * decode)


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded binary) from (doc_id, ids); null ids decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(ranks_path))
    picked = encoded.select("doc_id", "ids")
    id_type = picked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks.value, pattern)
        for batch in batches:
            out = [codec.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "decoded": pa.array(out, pa.binary())})

    return picked.mapInArrow(run, f"doc_id {id_type}, decoded binary")
