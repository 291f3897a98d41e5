"""Token-id files with fixed-width bit packing.

Each id takes the fewest bits that hold the vocabulary. A shard file is

    header   64 bytes: magic, version, width, documents, ids, documents a block,
             first document id
    doc ids  int64 for each document, ascending
    lengths  uint32 ids of each document
    blocks   uint64 pairs (first id, byte offset) for every block of documents
    payload  the packed ids, each block starting on a byte
    b"BPK1"

so numpy unpacks a block, or one document of it, without the rest. Documents are
range-partitioned and sorted by id; a task writes shards of ``SHARD_IDS`` ids.
Global starts are prefix sums over the shard headers, a table as long as there
are shards, read from the first bytes of each file.

The tokenizer drops white space, so ids of a text are the ids of its blank-
separated words in turn: a bounded memo per Python worker keeps the ids of words
seen under their bytes, and only new words go to the tokenizers library, those
of plain letters straight to its model. Texts are taken in chunks of
``ENCODE_BYTES``, long ones cut at blanks, and a shard in
the making is held as two bytes an id, so memory follows neither the batch nor
the longest text (but for its ids).

Defined cases: null text has only the end id; null document ids come first and
are kept; repeated ids are written in order of their text; an id outside the
vocabulary is an error; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, read_blobs, read_head, split_words, text_chunks, write_blobs

MAGIC = b"BPK1"
HEAD = struct.Struct("<4sHHQQQq24x")
#: Ids in one shard file, and documents in one block.
SHARD_IDS, BLOCK_DOCS = 1 << 22, 64
#: Words whose ids a worker remembers in each of two generations, and the longest of them in bytes.
MEMO_WORDS, MEMO_BYTES = 200_000, 64
_NULL_ID = -(1 << 63)
#: Marks that may end a word: visible ASCII but letters, digits and the apostrophe, which letters may follow.
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27)
_PLAIN = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
_ENDS, _STARTS = np.zeros(256, bool), np.zeros(256, bool)
_ENDS[[*_PLAIN, *range(0x41, 0x5B)]] = _STARTS[list(_MARKS)] = True
#: Letters of ASCII and Latin-1: composed already, each with one lower-case letter.
_PLAIN_WORD = re.compile("[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch
#: The byte-level alphabet: visible Latin-1 stands for itself, other bytes for 256, 257, ... in turn.
_SHOWN = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_PROBES = ["word", "stra\u00dfe", "\u00e9t\u00e9", "ma\u00f1ana", "z", "\u00ff\u00e0x", "\u00c9t\u00c0\u00de"]
#: Unknown words that go to the tokenizers library in one call, and bytes of text that are encoded at once.
LEARN_WORDS, ENCODE_BYTES = 64, 2 << 20


# ----------------------------------------------------------------------- packing
def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Little-endian bit order, id after id; padded to a whole byte."""
    ids = np.ascontiguousarray(ids, np.uint32)
    if len(ids) and int(ids.max()) >> width:
        raise ValueError(f"an id needs more than {width} bits")
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    out = []
    for at in range(0, len(ids), 1 << 16):  # a multiple of 8 ids: whole bytes
        bits = (ids[at : at + (1 << 16), None] >> np.arange(width, dtype=np.uint32)) & 1
        out.append(np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes())
    return b"".join(out)


def unpack(data: bytes | np.ndarray, width: int, start: int, count: int) -> np.ndarray:
    """Ids start .. start + count - 1 of a packed block."""
    raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
    if width in (8, 16, 32):
        size = width // 8
        return raw[start * size : (start + count) * size].view(f"<u{size}").astype(np.uint32)
    bit = (np.arange(start, start + count, dtype=np.uint64)) * np.uint64(width)
    first, last = start * width // 8, -(-(start + count) * width // 8)
    part = np.zeros(last - first + 8, np.uint8)
    part[: last - first] = raw[first:last]
    words = np.lib.stride_tricks.as_strided(part.view(np.uint8), shape=(len(part) - 7, 8), strides=(1, 1))
    at = (bit >> np.uint64(3)).astype(np.int64) - first
    value = words[at].copy().view("<u8").ravel() >> (bit & np.uint64(7))
    return (value & np.uint64((1 << width) - 1)).astype(np.uint32)


class ShardWriter:
    """Collects documents' ids, two or four bytes each; ``finish`` gives the file without its closing magic."""

    def __init__(self, width: int):
        self.width, self.doc_ids, self.lengths, self.parts, self.held = width, [], [], [], 0

    def add(self, doc_ids: list[int], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.lengths += lengths.tolist()
        self.parts.append(ids)
        self.held += len(ids)

    def finish(self) -> bytes:
        lengths = np.array(self.lengths, "<u4")
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        ids = np.concatenate([np.zeros(0, np.uint16), *self.parts])
        head = HEAD.pack(MAGIC, 1, self.width, len(lengths), len(ids), BLOCK_DOCS, self.doc_ids[0] if self.doc_ids else 0)
        blocks, payload, size = [], [], 0
        for at in range(0, len(lengths), BLOCK_DOCS):
            first, stop = starts[at], starts[min(at + BLOCK_DOCS, len(lengths))]
            blocks.append((first, size))
            payload.append(pack(ids[first:stop], self.width))
            size += len(payload[-1])
        return b"".join([head, np.array(self.doc_ids, "<i8").tobytes(), lengths.tobytes(), np.array(blocks, "<u8").tobytes(), *payload])


class Shard:
    """Random access to a shard file's bytes (read or memory-mapped)."""

    def __init__(self, data: bytes | np.ndarray):
        raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        magic, _, self.width, self.n, self.ids, self.block_docs, self.first = HEAD.unpack(raw[: HEAD.size].tobytes())
        if magic != MAGIC or raw[-4:].tobytes() != MAGIC:
            raise ValueError("not a token shard, or cut short")
        at = HEAD.size
        self.doc_ids = np.frombuffer(raw[at : at + 8 * self.n].tobytes(), "<i8")
        at += 8 * self.n
        self.lengths = np.frombuffer(raw[at : at + 4 * self.n].tobytes(), "<u4").astype(np.int64)
        at += 4 * self.n
        n_blocks = -(-self.n // self.block_docs)
        self.blocks = np.frombuffer(raw[at : at + 16 * n_blocks].tobytes(), "<u8").reshape(-1, 2).astype(np.int64)
        self.payload = raw[at + 16 * n_blocks : -4]
        self.starts = np.cumsum(self.lengths) - self.lengths

    def document(self, i: int) -> np.ndarray:
        first, offset = self.blocks[i // self.block_docs]
        return unpack(self.payload[offset:], self.width, int(self.starts[i] - first), int(self.lengths[i]))

    def block(self, k: int) -> list[np.ndarray]:
        """The documents of one block, unpacked together."""
        first, offset = self.blocks[k]
        sizes = self.lengths[k * self.block_docs : (k + 1) * self.block_docs]
        return np.split(unpack(self.payload[offset:], self.width, 0, int(sizes.sum())), np.cumsum(sizes)[:-1])


# --------------------------------------------------------------------- tokenising
class WordMemo:
    """Ids of blank-separated words, by a tokenizers file.

    The ids of words seen are kept under the word's bytes, so a hit is the word
    itself; a word that ends in marks like a full stop, before which the tokenizer
    always splits, is put together from its parts. Unknown words go to the
    library, many to a call. Texts that hold a special token's string are cut
    there, as the library cuts them.
    """

    def __init__(self, spec: bytes, limit: int = MEMO_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_str(spec.decode()), limit
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.special = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, sorted(self.special))) + b")") if self.special else None
        # a lone digit is a token of its own: "0" parts the words of one call
        mark = self._library("0")
        self.mark = int(mark[0]) if len(mark) == 1 else None
        # words of plain letters go to the model itself, if this file's rules leave them whole
        self.model, self.code = self.tokenizer.model, {2: "H", 4: "I"}[self.kind.itemsize]
        self.direct = True
        self.direct = all(self._direct(w.encode()) == self._library(w).tobytes() for w in _PROBES)

    def _library(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _direct(self, word: bytes) -> bytes | None:
        """Ids of a word of plain lower-case letters, None for others."""
        if not self.direct:
            return None
        if word.isalpha():
            text = word.decode()
        else:
            text = word.decode()
            if not _PLAIN_WORD(text):
                return None
            text = text.lower().encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array(self.code, [t.id for t in self.model.tokenize(text)]).tobytes()

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words by the library."""
        plain = [w for w in words if b"0" not in w] if self.mark is not None else []
        out: dict[bytes, bytes] = {}
        for at in range(0, len(plain), LEARN_WORDS):
            some = plain[at : at + LEARN_WORDS]
            ids = self._library(b" 0 ".join(some).decode())
            cuts = np.flatnonzero(ids == self.mark)
            out |= {w: ids[i:j].tobytes() for w, i, j in zip(some, [0, *(cuts + 1)], [*cuts, len(ids)], strict=True)}
        return out | {w: self._library(w.decode()).tobytes() for w in words if w not in out}

    def _forms(self, forms: list[bytes]) -> list[bytes]:
        """Ids of each distinct word, as bytes."""
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        young, old, late = self.young, self.old, []
        found = list(map(young.get, forms))
        tokenize, code, direct = self.model.tokenize, self.code, self.direct
        for k in [k for k, ids in enumerate(found) if ids is None]:
            word = forms[k]
            ids = old.get(word)
            if ids is None:
                base, tail = word, b""
                if word[-1] in _MARKS:
                    base = word.rstrip(_MARKS)
                    if base and (base[-1] in _PLAIN or _PLAIN_WORD(base.decode())):
                        tail = word[len(base) :]
                        ids = young.get(base) or old.get(base)
                    else:
                        base = word
                if ids is None:
                    if direct and base.isalpha():
                        ids = array(code, [t.id for t in tokenize(base.decode())]).tobytes()
                    else:
                        ids = self._direct(base)
                more = young.get(tail) if tail else b""
                if ids is None or more is None:
                    late.append((k, base, tail))
                    continue
                if tail and len(base) <= MEMO_BYTES:
                    young[base] = ids
                ids += more
            found[k] = ids
            if len(word) <= MEMO_BYTES:
                young[word] = ids
        known = self._learn(list({p: None for _, *parts in late for p in parts if p}))
        for k, base, tail in late:
            found[k] = known[base] + (known[tail] if tail else b"")
            for w, ids in ((forms[k], found[k]), (base, known[base]), (tail, known.get(tail))):
                if w and len(w) <= MEMO_BYTES:
                    young[w] = ids
        return found

    def _words(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, ids per piece)."""
        # a blank between an ASCII letter or digit and a mark: fewer forms, the same tokens
        cuts = np.flatnonzero(_ENDS[data[:-1]] & _STARTS[data[1:]]) + 1
        index, forms, counts = split_words(offsets + np.searchsorted(cuts, offsets), np.insert(data, cuts, 0x20))
        ids = self._forms(forms)
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // self.kind.itemsize
        first, flat = np.cumsum(size, dtype=np.int32) - size, np.frombuffer(b"".join(ids), self.kind)
        wide = size[index]
        ends = np.cumsum(wide, dtype=np.int32)  # a chunk has fewer ids than bytes
        out = flat[np.repeat(first[index] - (ends - wide), wide) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        return out, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])])

    def encode(self, texts: pa.Array, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, ids per piece, ids): pieces of one text each, from that text on.

        A long text comes in several pieces; after the last piece of every text stands the end id.
        """
        end = np.array([end_id], self.kind)
        for first, offsets, data, _, closes in text_chunks(texts, ENCODE_BYTES):
            pa.default_memory_pool().release_unused()  # what the chunk before took
            if self.cut is not None and self.cut.search(data.tobytes()):
                for k in range(len(offsets) - 1):
                    parts = []
                    for part in self.cut.split(data[offsets[k] : offsets[k + 1]].tobytes()):
                        raw = np.frombuffer(part, np.uint8)
                        parts.append(np.array([self.special[part]], self.kind) if part in self.special else self._words(np.array([0, len(raw)]), raw)[0])
                    ids = np.concatenate([*parts, *([end] if closes else [])])
                    yield first + k, np.array([len(ids)]), ids
                continue
            ids, sizes = self._words(offsets, data)
            if closes:
                out = np.full(len(ids) + len(sizes), end_id, self.kind)
                inner = np.ones(len(out), bool)
                inner[np.cumsum(sizes + 1) - 1] = False
                out[inner] = ids
                ids, sizes = out, sizes + 1
            yield first, sizes, ids


_MEMOS: dict[int, WordMemo] = {}


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> None:
    """Shard files under ``path``, ids in ascending order of the document id."""
    with open(tokenizer_path, "rb") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # a piece of the text is a key as well, so that rows of one id may be split
    ordered = picked.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 16)).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _MEMOS.get(hash(spec.value)) or WordMemo(spec.value)
        _MEMOS[hash(spec.value)] = memo
        out, pack_all = ShardWriter(width_of(memo.vocabulary)), lambda w: pa.RecordBatch.from_pydict({"shard": pa.array([w.finish()], pa.binary())})
        for batch in batches:
            names = [_NULL_ID if i is None else i for i in batch.column(0).to_pylist()]
            done = 0  # documents of this batch that were begun
            for first, sizes, ids in memo.encode(batch.column(1), end_id):
                if first < done:  # goes on with the last document
                    out.lengths[-1] += int(sizes[0])
                    out.parts.append(ids)
                    out.held += len(ids)
                    continue
                if out.held >= shard_ids:
                    yield pack_all(out)
                    out = ShardWriter(out.width)
                out.add(names[first : first + len(sizes)], sizes, ids)
                done = first + len(sizes)
        if out.lengths:
            yield pack_all(out)

    write_blobs(ordered.mapInArrow(run, "shard binary"), "shard", path, MAGIC)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, shard, local_start, n_tokens, ids_crc32 [, ids] from the files, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(np.frombuffer(content.as_buffer(), np.uint8))
                step = shard.block_docs * 16
                for at in range(0, shard.n, step):
                    some = range(at, min(at + step, shard.n))
                    ids = [x for k in range(at // shard.block_docs, -(-some.stop // shard.block_docs)) for x in shard.block(k)]
                    columns = {
                        "doc_id": pa.array([None if shard.doc_ids[i] == _NULL_ID else int(shard.doc_ids[i]) for i in some], pa.int64()),
                        "shard": pa.array([name] * len(some)),
                        "position": pa.array(list(some), pa.int64()),
                        "local_start": pa.array(shard.starts[at : at + len(some)]),
                        "n_tokens": pa.array(shard.lengths[at : at + len(some)]),
                        "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array(ids, pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, shard string, position long, local_start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return read_blobs(spark, path).select("path", "content").mapInArrow(run, schema)


def ids_inside(uri: str) -> int:
    """The number of ids in a shard file, by its header."""
    return HEAD.unpack(read_head(uri, HEAD.size))[4]


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 for every document in the files."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [ids_inside(uri) for uri in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"shard": batch.column(0), "ids": pa.array(ids, pa.int64())})

    # parts are in order of their number, files of a part in order of theirs
    shards = read_blobs(spark, path).select("path").mapInArrow(heads, "shard string, ids long")
    shards = shards.select("shard", "ids", F.regexp_extract("shard", r"part-(\d+)", 1).cast("long").alias("part"), F.regexp_extract("shard", r"-c(\d+)\.[^/]*$", 1).cast("long").alias("piece"))
    within = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each writing task, so this window is small
    parts = shards.groupBy("part").agg(F.sum("ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    base = shards.withColumn("inside", F.coalesce(F.sum("ids").over(within), F.lit(0))).join(parts, "part").select("shard", (F.col("before") + F.col("inside")).alias("base"))
    return read_tokens(spark, path).join(base, "shard").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_index(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    spark, path = docs.sparkSession, fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, path, end_id)
    return token_index(spark, path)
