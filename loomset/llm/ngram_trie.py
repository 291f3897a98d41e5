"""LM scoring with an Elias-Fano n-gram trie.

The model is an interpolated trigram model with absolute discounting:

    p(c | a, b) = max(n(a, b, c) - D, 0) / n(a, b, *) + gamma(a, b) * p(c | b)
    p(c | b)    = max(n(b, c) - D, 0) / n(b, *) + gamma(b) * p(c)
    p(c)        = (n(c) + 1) / (N + V + 1)
    gamma(h)    = D * (kinds of tokens after h) / n(h, *), 1 for a history never seen

over the training documents, each text between two start marks and one end token.
Every n-gram is kept. Each history's probabilities sum to one, up to quantisation,
which rounds the discounted parts down.

Levels are files in the shared folder that workers memory-map when a lookup
needs them:

* words: shards of the sorted 64-bit halves of the words' 128-bit hashes (XXH3),
  Elias-Fano, with the other halves beside them for an exact match, and counts as
  Elias-Fano prefix sums. A word's id is its rank over all shards;
* n-grams: shards of a trie. The first level holds the distinct first words
  (Elias-Fano); the second, for each of them, the ranges of its successors; the
  third, for each node of the second, the range of its own. Successors are
  Elias-Fano coded as (parent's rank, word id): the unary high parts are the
  monotone pointers to each parent's range, the low parts the word ids relative
  to their context, found by a successor search inside that range. Probabilities
  are 16 bits of log10, discounted, beside the nodes;
* back-off: gamma of every word, 16 bits, by id; that of a pair follows from 16
  bits beside its node (the mass its successors hold).

N-grams go to shards by a hash of their first two words, as sorted arrays packed
by the task that counted them, so a shuffle row is a task's share of a shard and
not one n-gram. The number of shards follows the number of training tokens:
``SHARD_TOKENS`` each on average. A pair of two words that each have over
1/``HOT_SHARE`` of all tokens is spread over ``SALTS`` shards by its third word;
successors of a hot first word are spread by the second anyway. Levels grow with
the corpus and are never collected or broadcast; only the list of their files is.

Defined cases: null or empty text is the end token alone; a null id is never
held out; without training rows N = V = 0 and every token has probability 1;
repeated rows count and are scored once each; other columns are ignored. More
than 2**31 - 4 distinct words, or 2**32 occurrences of one n-gram in a task, are
an error, not an overflow.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, fresh_path, list_blobs, map_blob, mix, split_words, text_chunks, write_blobs

MAGIC = b"EFT2"
#: The discount with the least log loss on fold 3 after training on folds 0, 1, 4, 5 and 6 of sf0.1.
D = 0.75
#: log10 probabilities from -16 to 0 in 65,535 steps.
_STEP = 16 / 65535
#: Training tokens in one shard of n-grams, tokens that a task counts before it packs them, bytes of text scored at once.
SHARD_TOKENS, TASK_TOKENS, SCORE_BYTES = 2_000_000, 2_000_000, 4 << 20
#: Distinct words that a task counts before it packs them.
TASK_WORDS = 300_000
#: A word is hot from this part of all tokens on; pairs of hot words are spread over so many shards.
HOT_SHARE, SALTS = 256, 16
_U, _LOW = np.uint64, (1 << 32) - 1
#: Ids of words and marks: two of them are one signed number of 64 bits.
MOST_IDS = 1 << 31
#: The token after the last word of a text; no word can contain a line feed.
END = b"\n"


# -------------------------------------------------------------------- Elias-Fano
#: Place of the k-th set bit of a byte, at byte * 8 + k.
_IN_BYTE = np.zeros(256 * 8, np.int64)
for _b in range(256):
    for _k, _at in enumerate(i for i in range(8) if _b >> i & 1):
        _IN_BYTE[_b * 8 + _k] = _at


def _select_in_word(x: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Place of the rank-th (from 0) set bit of each word: counts by bytes, then a table."""
    s = x - ((x >> _U(1)) & _U(0x5555555555555555))
    s = (s & _U(0x3333333333333333)) + ((s >> _U(2)) & _U(0x3333333333333333))
    s = ((s + (s >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _U(0x0101010101010101)  # set bits up to each byte
    passed = ((rank * _U(0x0101010101010101) | _U(0x8080808080808080)) - s) & _U(0x8080808080808080)
    place = np.bitwise_count(passed).astype(_U) * _U(8)
    byte = (x >> place) & _U(0xFF)
    before = ((s << _U(8)) >> place) & _U(0xFF)
    return place.astype(np.int64) + _IN_BYTE[(byte * _U(8) + rank - before).astype(np.int64)]


class EliasFano:
    """A monotone sequence: low bits packed, high bits in unary, all vectorised.

    Arrays: ``low`` (bytes), ``high`` (uint64 words) and the directory ``before``:
    the set, or with ``zeros`` the unset, bits before each word of ``high``, for
    select. The set bits serve access by rank, the unset ones a search by value;
    a file holds the one its reader needs, the other follows from it.
    """

    def __init__(self, n: int, bits: int, zeros: bool, low: np.ndarray, high: np.ndarray, before: np.ndarray):
        self.n, self.bits, self.zeros, self.low, self.high, self.before = n, bits, zeros, low, high, before
        self._other: np.ndarray | None = None

    @staticmethod
    def build(values: np.ndarray, zeros: bool = True, bits: int | None = None) -> EliasFano:
        """values: ascending uint64; bits: low bits to keep apart, by default the smallest form's."""
        n = len(values)
        top = int(values[-1]) if n else 0
        if bits is None:
            bits = max(0, min(56, (top // max(n, 1)).bit_length() - 1)) if n else 0
        while n and (top >> bits) > 4 * n + 64:  # 64-bit universes of few values
            bits += 1
        low = np.zeros((n * bits + 7) // 8 + 8, np.uint8)
        if bits:
            for at in range(0, n, 1 << 16):
                part = values[at : at + (1 << 16)]
                packed = np.packbits(((part[:, None] >> np.arange(bits, dtype=_U)) & _U(1)).astype(np.uint8).ravel(), bitorder="little")
                low[at * bits // 8 : at * bits // 8 + len(packed)] = packed
        spots = (values >> _U(bits)).astype(np.int64) + np.arange(n)
        size = (int(spots[-1]) + 1 if n else 0) // 64 + 1
        flags = np.zeros(size * 64, np.uint8)
        flags[spots] = 1
        high = np.packbits(flags, bitorder="little").view("<u8")
        count = np.bitwise_count(~high if zeros else high).astype(np.int64)
        return EliasFano(n, bits, zeros, low, high, (np.cumsum(count) - count).astype("<i8"))

    def parts(self) -> tuple[dict, list[np.ndarray]]:
        return {"n": self.n, "bits": self.bits, "zeros": self.zeros}, [self.low, self.high, self.before]

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Position of the rank-th (from 0) set or unset bit."""
        before = self.before
        if ones == self.zeros:
            if self._other is None:
                self._other = np.arange(len(self.high), dtype=np.int64) * 64 - self.before
            before = self._other
        word = np.searchsorted(before, rank, "right") - 1
        bits = self.high[word] if ones else ~self.high[word]
        return word * 64 + _select_in_word(bits, (rank - before[word]).astype(_U))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), _U)
        bit = i * self.bits
        words = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))
        return (words[bit >> 3] >> (bit & 7).astype(_U)) & _U((1 << self.bits) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, True) - i).astype(_U) << _U(self.bits)) | self._low(i)

    def range(self, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks [begin, end) of the values whose high part is ``bucket``."""
        last = len(self.high) * 64 - self.n - 1  # unset bits, less one
        inside = np.minimum(bucket, last)
        # where the bucket's bits start: behind the unset bit of the one before
        at = np.zeros(len(inside), np.int64)
        later = inside > 0
        at[later] = self._select(inside[later] - 1, False) + 1
        begin = at - inside
        # its set bits are a run; a run that reaches the word's end is measured by select
        word = np.minimum(at >> 6, len(self.high) - 1)
        shift = (at & 63).astype(_U)
        rest = ~(self.high[word] >> shift)
        run = np.bitwise_count((rest & (~rest + _U(1))) - _U(1)).astype(np.int64)
        end = begin + run
        beyond = (run + shift.astype(np.int64) >= 64) | (at >> 6 != word)
        end[beyond] = self._select(inside[beyond], False) - inside[beyond]
        end = np.minimum(end, self.n)
        return np.where(bucket > last, self.n, begin), np.where(bucket > last, self.n, end)

    def within(self, low: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Rank of a value with those low bits in [begin, end) of one high part, or -1: a successor search."""
        out = np.full(len(low), -1, np.int64)
        live = np.flatnonzero(begin < end)
        first, stop, want = begin[live], end[live], low[live]
        while len(live):
            middle = (first + stop) // 2
            got = self._low(middle)
            hit = got == want
            out[live[hit]] = middle[hit]
            first, stop = np.where(got < want, middle + 1, first), np.where(got < want, stop, middle)
            keep = ~hit & (first < stop)
            live, first, stop, want = live[keep], first[keep], stop[keep], want[keep]
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Rank of x in the sequence, or -1."""
        if not self.n or not len(x):
            return np.full(len(x), -1, np.int64)
        begin, end = self.range((x >> _U(self.bits)).astype(np.int64))
        return self.within(x & _U((1 << self.bits) - 1), begin, end)


def save(meta: dict, arrays: list[np.ndarray]) -> bytes:
    """The file without its magic: JSON head, then 8-byte aligned arrays."""
    spans, at = [], 0
    for a in arrays:
        spans.append((str(a.dtype), at, a.nbytes))
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(meta | {"arrays": spans}).encode()
    head += b" " * (-(len(head) + 8) % 8)
    body = b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)
    return len(head).to_bytes(8, "little") + head + body


def load(uri: str) -> tuple[dict, list[np.ndarray]]:
    data = map_blob(uri)
    if data[-4:].tobytes() != MAGIC:
        raise ValueError(f"{uri} is not a level file, or cut short")
    size = int.from_bytes(data[:8].tobytes(), "little")
    meta = json.loads(data[8 : 8 + size].tobytes())
    base = 8 + size
    return meta, [data[base + at : base + at + n].view(kind) for kind, at, n in meta["arrays"]]


def _efs(metas: list[dict], arrays: list[np.ndarray]) -> list[EliasFano]:
    return [EliasFano(m["n"], m["bits"], m["zeros"], *arrays[3 * i : 3 * i + 3]) for i, m in enumerate(metas)]


_POWERS = 10 ** (np.arange(65536) * _STEP - 16)


def quantise(p: np.ndarray) -> np.ndarray:
    """16 bits of log10 p, rounded down."""
    return np.clip(np.floor((np.log10(np.maximum(p, 1e-16)) + 16) / _STEP), 0, 65535).astype("<u2")


def dequantise(q: np.ndarray) -> np.ndarray:
    return _POWERS[q]


# ------------------------------------------------------------------- shuffled shards
def _numbered(paths: list[str]) -> dict[int, str]:
    """Files by the number of the partition that wrote them: their shard."""
    return {int(re.search(r"part-(\d+)[^/]*\Z", p).group(1)): p for p in paths}


def _gather(parts: DataFrame, shards: int, build: Callable[[int, list[np.ndarray]], bytes], path: str) -> dict[int, str]:
    """Files by shard: (shard, part) rows brought together and built into one file a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            for s, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                if shard not in (None, s):
                    raise RuntimeError("a partition has the parts of two shards")
                shard = s
                held.append(np.frombuffer(part.as_buffer(), np.uint8))
        if held:
            yield pa.RecordBatch.from_pydict({"level": pa.array([build(shard, held)], pa.binary())})

    write_blobs(parts.repartitionById(shards, F.col("shard")).mapInArrow(run, "level binary"), "level", path, MAGIC)
    return _numbered(list_blobs(parts.sparkSession, path))


def _rows(shards: list[int], parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(parts, pa.binary())], ["shard", "part"])


def _over_files(spark: SparkSession, files: dict[int, str], run: Callable, schema: str) -> DataFrame:
    """``run`` over (shard, uri) rows, a file a row; tasks map the files themselves."""
    rows = spark.createDataFrame(sorted(files.items()), "shard int, uri string")
    return rows.repartitionById(max(1, min(len(files), spark.sparkContext.defaultParallelism * 4)), F.col("shard")).mapInArrow(run, schema)


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 8, then 4 byte items, behind their lengths, compressed."""
    return zstandard.compress(np.array([len(a) for a in arrays], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays), 1)


def _unpack(packed: np.ndarray, kinds: list[str]) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(packed), np.uint8)
    sizes = data[: 8 * len(kinds)].view("<i8")
    out, at = [], 8 * len(kinds)
    for kind, n in zip(kinds, sizes.tolist()):
        width = np.dtype(kind).itemsize
        out.append(data[at : at + n * width].view(kind))
        at += n * width
    return out


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their n."""
    if not len(keys):
        return keys, n.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n[order].astype(np.int64), first)


# ---------------------------------------------------------------------------- words
def digests(forms: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of the words' 128-bit XXH3."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, forms)), ">u8").astype(_U).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def word_level(_: int, held: list[np.ndarray]) -> bytes:
    """The file of one shard of words from (first half, second half, count) parts."""
    parts = [_unpack(x, ["<u8", "<u8", "<i8"]) for x in held]
    high, low, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((low, high))
    high, low, n = high[order], low[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
    high, low, n = high[first], low[first], np.add.reduceat(n, first)
    efs = [EliasFano.build(high - high[0]), EliasFano.build(np.cumsum(n).astype(_U), zeros=False)]
    metas, arrays = zip(*(e.parts() for e in efs))
    return save({"ef": metas, "first": str(int(high[0])), "n": len(high), "tokens": int(n.sum())}, [*(a for x in arrays for a in x), low])


class Words:
    """Words' bytes -> ids and counts; shards are opened where a lookup needs them."""

    def __init__(self, files: dict[int, str], shards: int, sizes: dict[int, tuple[int, int]]):
        """sizes: (words, tokens) of each shard."""
        self.files, self.shards = files, shards
        held = np.zeros(shards, np.int64)
        for s, (n, _) in sizes.items():
            held[s] = n
        self.base = np.cumsum(held) - held
        self.size, self.total = int(held.sum()), sum(t for _, t in sizes.values())
        self._opened: dict[int, tuple] = {}

    def _shard(self, s: int) -> tuple:
        if s not in self._opened:
            meta, arrays = load(self.files[s])
            self._opened[s] = (*_efs(meta["ef"], arrays), arrays[6], _U(int(meta["first"])))
        return self._opened[s]

    @staticmethod
    def place(high: np.ndarray, shards: int) -> np.ndarray:
        """Shards are equal ranges of the first half."""
        return ((high >> _U(32)) * _U(shards) >> _U(32)).astype(np.int64)

    def ids(self, forms: list[bytes]) -> np.ndarray:
        """-1 for unknown words."""
        out = np.full(len(forms), -1, np.int64)
        if not forms:
            return out
        high, low = digests(forms)
        where = self.place(high, self.shards)
        order = np.argsort(high)
        cuts = np.flatnonzero(np.diff(where[order])) + 1
        for mine in np.split(order, cuts):
            s = int(where[mine[0]])
            if s not in self.files:
                continue
            ef, _, other, first = self._shard(s)
            known = high[mine] >= first
            rank = np.full(len(mine), -1, np.int64)
            rank[known] = ef.find(high[mine][known] - first)
            wrong = np.flatnonzero((rank >= 0) & (other[np.maximum(rank, 0)] != low[mine]))
            for k in wrong.tolist():  # equal first halves, different words: look at the neighbours
                x, r = int(high[mine[k]] - first), int(rank[k])
                while r > 0 and int(ef.access(np.array([r - 1]))[0]) == x:
                    r -= 1
                while r < ef.n and int(ef.access(np.array([r]))[0]) == x and other[r] != low[mine[k]]:
                    r += 1
                rank[k] = r if r < ef.n and int(ef.access(np.array([r]))[0]) == x else -1
            out[mine] = np.where(rank >= 0, rank + self.base[s], -1)
        return out

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """How often each id occurs in training, 0 for what is no word's id."""
        out = np.zeros(len(ids), np.int64)
        known = np.flatnonzero((ids >= 0) & (ids < self.size))
        where = np.searchsorted(self.base, ids[known], "right") - 1
        for s in np.flatnonzero(np.bincount(where)).tolist():
            mine = known[where == s]
            sums, i = self._shard(s)[1], ids[mine] - self.base[s]
            upto = sums.access(i)
            prior = np.where(i > 0, sums.access(np.maximum(i - 1, 0)), _U(0))
            out[mine] = (upto - prior).astype(np.int64)
        return out

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1) / (self.total + self.size + 1)


# --------------------------------------------------------------------------- streams
def framed(ids: np.ndarray, counts: np.ndarray, closes: bool, carry: np.ndarray | None, start: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens with two marks before each piece, places of the tokens that count, those per piece).

    ``carry`` stands for the first piece's marks: the last two tokens of the
    piece before, of the same text. ``closes``: an end token follows each piece.
    """
    extra = int(closes)
    sizes = counts + 2 + extra
    stops = np.cumsum(sizes)
    flat = np.full(int(sizes.sum()), start, np.int64)
    begins = stops - sizes
    event, inner = np.ones(len(flat), bool), np.ones(len(flat), bool)
    event[begins] = event[begins + 1] = inner[begins] = inner[begins + 1] = False
    if closes:
        inner[stops - 1] = False
        flat[stops - 1] = end
    flat[inner] = ids
    if carry is not None:
        flat[:2] = carry
    return flat, np.flatnonzero(event), counts + extra


def _streams(texts: pa.Array, words: Words, limit: int, start: int, unknown: int, end: int) -> Iterator[tuple]:
    """(number of the first text, framed tokens of a chunk ..., distinct ids of the chunk)."""
    carry = None
    for first, offsets, data, opens, closes in text_chunks(texts, limit):
        index, forms, counts = split_words(offsets, data)
        ids = words.ids(forms)
        ids = np.where(ids < 0, unknown, ids)[index]
        flat, event, sizes = framed(ids, counts, closes, None if opens else carry, start, end)
        carry = None if closes else flat[-2:]
        yield first, flat, event, sizes


# --------------------------------------------------------------------------- n-grams
def _shard_of(pairs: np.ndarray, shards: int, salt: int | np.ndarray = 0) -> np.ndarray:
    salted = pairs.view(_U) ^ (np.asarray(salt, _U) * _U(0x9E3779B97F4A7C15))
    return (mix(salted) % _U(shards)).astype(np.int64)


def _hot_shards(pairs: np.ndarray, shards: int) -> np.ndarray:
    """The shards of each hot pair by salt: (pairs, SALTS)."""
    return _shard_of(np.repeat(pairs[:, None], SALTS, 1), shards, np.arange(SALTS)[None, :])


def count_parts(first: np.ndarray, second: np.ndarray, third: np.ndarray, hot: np.ndarray, shards: int) -> Iterator[tuple[int, bytes]]:
    """(shard, packed share) of a task's trigrams: pairs, their rows, their totals, third words, counts."""
    pairs, pair = np.unique(first << 32 | second, return_inverse=True)
    totals = np.bincount(pair, minlength=len(pairs))
    is_hot = np.isin(pairs >> 32, hot) & np.isin(pairs & _LOW, hot)
    # a slot is a pair in a shard
    cold = np.flatnonzero(~is_hot)
    slot_pair, slot_shard = cold, _shard_of(pairs[cold], shards)
    slot_of = np.empty(len(pairs), np.int64)
    slot_of[cold] = np.arange(len(cold))
    warm = np.flatnonzero(is_hot)
    if len(warm):
        where = _hot_shards(pairs[warm], shards)
        once, back = np.unique(np.arange(len(warm))[:, None] * shards + where, return_inverse=True)
        by_salt = back.reshape(where.shape) + len(cold)
        slot_pair = np.concatenate([slot_pair, warm[once // shards]])
        slot_shard = np.concatenate([slot_shard, once % shards])
        slot_of[warm] = np.arange(len(warm))
    order = np.lexsort((slot_pair, slot_shard))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    slot = slot_of[pair]
    if len(warm):
        mine = is_hot[pair]
        slot[mine] = by_salt[slot[mine], third[mine] % SALTS]
    rows, n = np.unique(rank[slot] << 32 | third, return_counts=True)
    if len(n) and max(int(n.max()), int(totals.max())) >> 32:
        raise OverflowError("an n-gram occurs 2**32 times in one task")
    slot_pair, slot_shard = slot_pair[order], slot_shard[order]
    row_slot = rows >> 32
    per_slot = np.bincount(row_slot, minlength=len(order))
    cuts = np.flatnonzero(np.concatenate([[True], slot_shard[1:] != slot_shard[:-1]])) if len(order) else []
    ends = np.append(cuts[1:], len(order)) if len(order) else []
    row_cuts = np.searchsorted(row_slot, np.append(cuts, len(order))) if len(order) else []
    for k, (i, j) in enumerate(zip(cuts, ends)):
        u, v = row_cuts[k], row_cuts[k + 1]
        yield int(slot_shard[i]), _pack(pairs[slot_pair[i:j]], per_slot[i:j].astype("<u4"), totals[slot_pair[i:j]].astype("<u4"), (rows[u:v] & _LOW).astype("<u4"), n[u:v].astype("<u4"))


def gram_level(held: list[np.ndarray], words: Words, start: int, texts: int) -> bytes:
    """The trie file of one shard from its shares; the id after ``start`` only closes an end token."""
    parts = [_unpack(x, ["<i8", "<u4", "<u4", "<u4", "<u4"]) for x in held]
    pair, rows, total, third, n = (np.concatenate(x) for x in zip(*parts))
    pairs, slot = np.unique(pair, return_inverse=True)
    totals = np.zeros(len(pairs), np.int64)
    np.add.at(totals, slot, total.astype(np.int64))
    keys, n = _sums(np.repeat(slot, rows) << 32 | third.astype(np.int64), n)
    real = (keys & _LOW) <= start
    keys, n = keys[real], n[real]
    node = keys >> 32
    first, second = pairs >> 32, pairs & _LOW
    width = (start + 2).bit_length()
    contexts, rank = np.unique(first, return_inverse=True)
    follow = np.where(contexts == start, texts, words.counts(contexts))
    two = (totals - D) / follow[rank]
    two[second == start] = 0  # the two marks are a history only
    three = (n - D) / totals[node]
    mass = np.bincount(node, three, len(pairs))
    efs = [
        EliasFano.build(contexts.astype(_U)),
        EliasFano.build((rank << width | second).astype(_U), bits=width),
        EliasFano.build((node << width | keys & _LOW).astype(_U), bits=width),
    ]
    metas, arrays = zip(*(e.parts() for e in efs))
    return save({"ef": metas, "n": len(pairs)}, [*(a for x in arrays for a in x), quantise(two), np.floor(mass * 65535).astype("<u2"), quantise(three)])


class Grams:
    """Lookups in the trie shards, each opened when first needed."""

    def __init__(self, files: dict[int, str], shards: int, hot: np.ndarray):
        self.files, self.shards, self.hot = files, shards, hot
        self._opened: dict[int, tuple] = {}

    def shard(self, s: int) -> tuple:
        if s not in self._opened:
            meta, arrays = load(self.files[s])
            self._opened[s] = (*_efs(meta["ef"], arrays), *arrays[9:12])
        return self._opened[s]

    def _by_shard(self, where: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        order = np.argsort(where, kind="stable")
        for mine in np.split(order, np.flatnonzero(np.diff(where[order])) + 1):
            if len(mine) and int(where[mine[0]]) in self.files:
                yield int(where[mine[0]]), mine

    def nodes(self, pairs: np.ndarray, where: np.ndarray) -> np.ndarray:
        """The node of each pair (ascending) in its shard, or -1: first word, then its successor."""
        out = np.full(len(pairs), -1, np.int64)
        for s, mine in self._by_shard(where):
            contexts, level, *_ = self.shard(s)
            first = pairs[mine] >> 32
            starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            rank = contexts.find(first[starts].astype(_U))
            begin, end = level.range(np.maximum(rank, 0))
            begin, end = np.where(rank < 0, 0, begin), np.where(rank < 0, 0, end)
            back = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(first))))
            out[mine] = level.within((pairs[mine] & _LOW).astype(_U), begin[back], end[back])
        return out

    def pairs(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(discounted probability, back-off weight, hot, shard, node) of ascending pairs."""
        where = _shard_of(pairs, self.shards)
        node = self.nodes(pairs, where)
        own, mass = np.zeros(len(pairs)), np.zeros(len(pairs))
        for s, mine in self._by_shard(np.where(node >= 0, where, -1)):
            *_, two, held, _ = self.shard(s)
            own[mine], mass[mine] = dequantise(two[node[mine]]), held[node[mine]] / 65535
        is_hot = np.isin(pairs >> 32, self.hot) & np.isin(pairs & _LOW, self.hot)
        warm = np.flatnonzero(is_hot & (node >= 0))
        if len(warm):  # the mass of a hot pair's successors lies in several shards
            mass[warm] = 0
            spread = np.sort(_hot_shards(pairs[warm], self.shards), 1)
            once = np.concatenate([np.ones((len(warm), 1), bool), spread[:, 1:] != spread[:, :-1]], 1)
            k = np.nonzero(once)[0]
            at = spread[once]
            there = self.nodes(pairs[warm][k], at)
            for s, mine in self._by_shard(np.where(there >= 0, at, -1)):
                np.add.at(mass, warm[k[mine]], self.shard(s)[4][there[mine]] / 65535)
        gamma = np.where(node >= 0, np.clip(1 - mass, 0, 1), 1.0)
        return own, gamma, is_hot, where, node

    def thirds(self, where: np.ndarray, node: np.ndarray, third: np.ndarray) -> np.ndarray:
        """Discounted probability of the third word below each node, 0 if it isn't there."""
        out = np.zeros(len(node))
        for s, mine in self._by_shard(np.where(node >= 0, where, -1)):
            _, _, level, _, _, q = self.shard(s)
            begin, end = level.range(node[mine])
            found = level.within(third[mine].astype(_U), begin, end)
            hit = found >= 0
            out[mine[hit]] = dequantise(q[found[hit]])
        return out


class Model:
    """Paths and sizes of the level files; opened, once per worker, where they are used."""

    _opened: dict[str, tuple] = {}

    def __init__(self, path: str, words: tuple, grams: dict[int, str], shards: int, hot: np.ndarray, backoff: dict[int, str], step: int):
        self.path, self.words, self.grams, self.shards, self.hot, self.backoff, self.step = path, words, grams, shards, hot, backoff, step

    def open(self) -> tuple[Words, Grams]:
        if self.path not in Model._opened:
            Model._opened.clear()
            Model._opened[self.path] = (Words(*self.words), Grams(self.grams, self.shards, self.hot))
        return Model._opened[self.path]

    def gamma(self, ids: np.ndarray) -> np.ndarray:
        """Back-off weights of single words, 1 for unknown ones."""
        out = np.ones(len(ids))
        where = ids // self.step
        for s in np.flatnonzero(np.bincount(where)).tolist():
            if s in self.backoff:
                mine = np.flatnonzero(where == s)
                table = load(self.backoff[s])[1][0]
                inside = mine[ids[mine] - s * self.step < len(table)]
                out[inside] = dequantise(table[ids[inside] - s * self.step])
        return out


def train(docs: DataFrame, text_col: str = "text", path: str | None = None) -> Model:
    """Count all of ``docs`` and write the levels, to ``path`` if they shall stay."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))
    path = path or fresh_path(spark, "lm")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, partitions // 4)  # words are few beside n-grams

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            high, low = digests(list(tally))
            n = np.fromiter(tally.values(), np.int64, len(tally))
            where = Words.place(high, parts)
            order = np.argsort(high)
            split = np.split(order, np.flatnonzero(np.diff(where[order])) + 1)
            return _rows([int(where[x[0]]) for x in split], [_pack(high[x], low[x], n[x]) for x in split])

        for batch in batches:
            for _, offsets, data, _, closes in text_chunks(batch.column(0)):
                index, forms, counts = split_words(offsets, data)
                for word, n in zip(forms, np.bincount(index, minlength=len(forms)).tolist()):
                    tally[word] = tally.get(word, 0) + n
                tally[END] = tally.get(END, 0) + closes * len(counts)
                if len(tally) > TASK_WORDS:
                    yield out()
                    tally.clear()
        if tally:
            yield out()

    word_files = _gather(texts.mapInArrow(count_words, "shard int, part binary"), parts, word_level, f"{path}/words")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            metas = [load(uri)[0] for uri in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"shard": batch.column(0), "n": pa.array([m["n"] for m in metas], pa.int64()), "tokens": pa.array([m["tokens"] for m in metas], pa.int64())})

    # one row a shard
    sizes = {r.shard: (r.n, r.tokens) for r in _over_files(spark, word_files, heads, "shard int, n long, tokens long").collect()} if word_files else {}
    given = (word_files, parts, sizes)
    known = Words(*given)
    start, total = known.size, known.total
    if start + 4 > MOST_IDS:
        raise OverflowError("more distinct words than ids of 31 bits")
    shards = max(-(-total // SHARD_TOKENS), min(partitions, 1 + total // 250_000))

    def hot_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*given)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                ids = np.arange(words.base[s], words.base[s] + sizes[s][0])
                n = np.concatenate([words.counts(ids[k : k + 500_000]) for k in range(0, len(ids), 500_000)])
                yield pa.RecordBatch.from_pydict({"id": pa.array(ids[n * HOT_SHARE > total])})

    # fewer than HOT_SHARE rows
    hot = [r.id for r in _over_files(spark, word_files, hot_words, "id long").collect()] if word_files else []
    hot = np.array(sorted([*hot, start]), np.int64)  # every text begins with two marks

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words(*given), [], 0
        end = int(words.ids([END])[0])

        def out() -> Iterator[pa.RecordBatch]:
            for s, part in count_parts(*(np.concatenate(x).astype(np.int64) for x in zip(*held)), hot, shards):
                yield _rows([s], [part])

        for batch in batches:
            for _, flat, event, _ in _streams(batch.column(0), words, SCORE_BYTES, start, start + 2, end):
                a, b, c = flat[event - 2], flat[event - 1], flat[event]
                last = c == end  # the pair of an end token has no third word, but counts
                held.append([np.concatenate(x).astype(np.uint32) for x in ((a, b[last]), (b, c[last]), (c, np.full(int(last.sum()), start + 1)))])
                size += len(held[-1][0])
                if size >= TASK_TOKENS:
                    yield from out()
                    held, size = [], 0
        if size:
            yield from out()

    def build_grams(_: int, held: list[np.ndarray]) -> bytes:
        words = Words(*given)
        return gram_level(held, words, start, int(words.counts(words.ids([END]))[0]))

    gram_files = _gather(texts.mapInArrow(count_grams, "shard int, part binary"), shards, build_grams, f"{path}/grams") if total else {}
    step = max(1, -(-(start + 1) // parts))

    def count_kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(gram_files, shards, hot)
        for batch in batches:
            for s in batch.column(0).to_pylist():
                contexts, level, *_ = grams.shard(s)
                ids = contexts.access(np.arange(contexts.n)).astype(np.int64)
                begin, end = level.range(np.arange(contexts.n))
                kinds = end - begin
                away = _away(ids, begin, kinds, level, hot, start, s, shards)
                kinds = kinds - away
                where = ids // step
                split = np.split(np.arange(len(ids)), np.flatnonzero(np.diff(where)) + 1)
                yield _rows([int(where[x[0]]) for x in split], [_pack(ids[x], kinds[x].astype("<u4")) for x in split])

    def backoff_level(shard: int, held: list[np.ndarray]) -> bytes:
        words = Words(*given)
        ids, kinds = (np.concatenate(x) for x in zip(*(_unpack(x, ["<i8", "<u4"]) for x in held)))
        table = np.zeros(min(step, start + 1 - shard * step), np.int64)
        np.add.at(table, ids - shard * step, kinds.astype(np.int64))
        every = shard * step + np.arange(len(table))
        n = np.where(every == start, int(words.counts(words.ids([END]))[0]), words.counts(every))
        return save({"n": len(table)}, [quantise(np.where(table > 0, D * table / n, 1.0))])

    backoff = _gather(_over_files(spark, gram_files, count_kinds, "shard int, part binary"), parts, backoff_level, f"{path}/backoff") if gram_files else {}
    return Model(path, given, gram_files, shards, hot, backoff, step)


def _away(ids: np.ndarray, begin: np.ndarray, kinds: np.ndarray, level: EliasFano, hot: np.ndarray, start: int, shard: int, shards: int) -> np.ndarray:
    """Of each context's successors in a shard those not counted there: copies of hot pairs, and the pair of start marks."""
    out = np.zeros(len(ids), np.int64)
    for k in np.flatnonzero(np.isin(ids, hot)).tolist():
        second = level._low(np.arange(begin[k], begin[k] + kinds[k])).astype(np.int64)
        copies = second[np.isin(second, hot)]
        out[k] = ((copies == start) | (_shard_of(ids[k] << 32 | copies, shards) != shard)).sum()
    return out


def score_texts(texts: pa.Array, model: Model) -> dict[str, np.ndarray]:
    """n_tokens, n_known, base_score and score of each text."""
    words, grams = model.open()
    start, unknown = words.size, words.size + 2
    end = int(words.ids([END])[0])
    end = words.size + 1 if end < 0 else end
    sums = {k: np.zeros(len(texts)) for k in ("n_tokens", "n_known", "base_score", "score")}
    for first, flat, event, sizes in _streams(texts, words, SCORE_BYTES, start, unknown, end):
        c = flat[event]
        single, which = np.unique(flat, return_inverse=True)
        counts = words.counts(single)
        p1, g1 = words.unigram(counts), model.gamma(single)
        # pairs (previous, token) of every place but the first, and of the marks before each piece
        pairs, pair = np.unique(flat[:-1] << 32 | flat[1:], return_inverse=True)
        own2, g2, hot, where, node = grams.pairs(pairs)
        history, now = pair[event - 2], pair[event - 1]
        rows, row = np.unique(history << 32 | c, return_inverse=True)
        h, third = rows >> 32, rows & _LOW
        at, below = where[h], node[h]
        warm = np.flatnonzero(hot[h])
        if len(warm):
            at[warm] = _shard_of(pairs[h[warm]], grams.shards, third[warm] % SALTS)
            # by shard and pair: ascending pairs within each
            order = np.lexsort((pairs[h[warm]], at[warm]))
            below[warm[order]] = grams.nodes(pairs[h[warm[order]]], at[warm[order]])
        own3 = grams.thirds(at, below, third)
        p = own3[row] + g2[history] * (own2[now] + g1[which[event - 1]] * p1[which[event]])
        piece = np.repeat(np.arange(len(sizes)), sizes)
        span = slice(first, first + len(sizes))
        total = lambda x: np.bincount(piece, x, len(sizes))  # noqa: E731, B023
        sums["n_tokens"][span] += sizes
        sums["n_known"][span] += total((counts > 0)[which[event]])
        sums["base_score"][span] += total(np.log10(p1)[which[event]])
        sums["score"][span] += total(np.log10(p))
    return sums


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score per row; no shuffle."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # file names, no model
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = score_texts(batch.column(1), shipped.value)
            total = shipped.value.open()[0].total
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n_tokens": pa.array(sums["n_tokens"].astype(np.int64)), "n_known": pa.array(sums["n_known"].astype(np.int64)),
                "train_tokens": pa.array(np.full(batch.num_rows, total, np.int64)), "base_score": pa.array(sums["base_score"]), "score": pa.array(sums["score"]),
            })

    return picked.mapInArrow(run, f"doc_id {id_type}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def train_and_score(docs: DataFrame, folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents outside the held-out fold, score all."""
    out = F.coalesce(fold(F.col(id_col), folds) == held_out, F.lit(False))
    model = train(docs.where(~out), text_col)
    return score(docs, model, id_col, text_col).withColumn("held_out", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)))
