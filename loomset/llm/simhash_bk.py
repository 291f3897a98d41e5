"""SimHash near-duplicates found with BK-trees.

A document's fingerprint has a bit set where over half of its word shingles'
XXH64 hashes (seed 42) have it. Equal fingerprints are grouped first, so copies
cost one row. Distinct fingerprints are dealt to shards by the pigeonhole rule:
of B bit blocks at most ``radius`` can hold a difference, so two fingerprints
within the radius share the bits of B - radius blocks, and each combination of
those blocks is one table of shards; keys are as many of their bits as leave
``TREE_ROWS`` fingerprints a shard. Every shard becomes a BK-tree whose
children are keyed by their Hamming distance to the parent; a query follows
only edges within the radius of its own distance. All trees of a batch are
built and searched level by level with numpy.

Trees are of bounded size and travel to the tasks that query them by shuffle,
not through the driver: together they are as large as the corpus. A shard with
over ``shard_rows`` fingerprints is dealt to blocks of that size; every two of
its blocks meet once, one as a tree and the other as its queries, so a task
holds two blocks however hot the shard is. Only edges that span the components
of a shard, or of two blocks, leave it; components are then joined up by
distributed star contraction.

With ``verify_shingle`` a link must also hold for a second print over the
distinct shingles of that many words: their number and ``PRINT_WORDS`` * 64
majority bits. Sets whose sizes alone rule out the Jaccard similarity are not
linked; the share of differing bits estimates the angle between the sets, and a
link stays if it is at most the angle of two sets of that similarity, plus
``SLACK`` standard errors. So the radius may be wide enough for edited copies
without linking texts that only share words; with ``distinct`` each shingle of a
text counts once in the fingerprint, so that common words don't rule it.
``families`` fingerprints per text,
of the same shingles under independent hashes, are searched one after the other;
a link that one of them misses by a few bits is found by another.

There the nodes are variants, the distinct rows of all prints of a text, not
fingerprints: trees are of distinct fingerprints, and for two of them within the
radius (or one with itself) every variant of the one is compared with every
variant of the other, in the first table only whose key the two share. The second
print's radius is too wide for trees or blocks to be selective, so variants of
one fingerprint cost time with the square of their number; texts dominated by a
repeated phrase share one. Shards are cut by variants, which spreads that work.

With ``exact`` the second print only proposes. Links of at most ``SURE_BITS`` bits
are taken (``SURE`` standard errors inside the similarity); all others, up to
``DOUBT`` standard errors ``DOUBT`` standard errors beyond it, are compared as sets of shingles. Of these a
shard sends the lightest forest, fewest bits first, over the components of its sure
links, then that of the pairs left, ``FORESTS`` in all: so many pairs a variant at
most, however many are near, and each pair left out closes as many separate cycles
of pairs with fewer bits. Texts of the pairs between different components are
gathered once and their 64-bit shingle hashes joined to the pairs. Variants with a
pair that was left out are then searched again among themselves, and every pair of
theirs that is still between different components is compared as well, in pieces of
bounded size: no pair is dropped. If few of them are alike, these are as many as the
pairs of near texts. Recall and precision are measured in the README.

Defined cases: null or empty text has fingerprint zero, linked like any other;
a text of fewer words than a shingle is one shingle; null ids get the component
of their fingerprint's other documents (null if there are none); repeated rows
are returned once each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix
from .components import connected_components, least_by

#: Fingerprints in one tree; shards with more are hot.
SHARD_ROWS = 20_000
#: Fingerprints that a shard's tree holds in the mean, at least, where links need no second print.
TREE_ROWS = 2_000
#: Hot shards that are broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: 64-bit words of a second print.
PRINT_WORDS = 8
#: Standard errors allowed when a second print is compared with a similarity.
SLACK = 1.0
#: Standard errors inside the similarity from which on links need no exact check, and
#: beyond it up to which they get one.
SURE, DOUBT = 4.0, 2.0
#: Forests of pairs that a shard sends to that check.
FORESTS = 4
#: At most so many (query, node) pairs are open at once.
_OPEN_PAIRS = 1 << 21
#: Pairs of variants of two fingerprints from which on they are compared in tiles.
_TILE = 1 << 12
_GOLDEN = 0x9E3779B97F4A7C15
#: Columns of a second print.
PRINT = ["n", *[f"p{i}" for i in range(PRINT_WORDS)]]


def fp_names(families: int) -> list[str]:
    return ["fp", *[f"fp{i}" for i in range(1, families)]]


# ----------------------------------------------------------------- fingerprints
def _shingles(text: str | None, shingle: int) -> list[bytes]:
    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [joined]
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *[e + 1 for e in ends]]
    return [joined[a:b] for a, b in zip(starts, ends[shingle - 1 :])]


def majority(parts: list[bytes], words: int = 1, ties: bool = False) -> np.ndarray:
    """``words`` times 64 bits, each set if set in over half the shingles' hashes.

    The first word's hash is XXH64 (seed 42), the others are derived from it.
    With ``ties`` every second bit is also set by just half of the hashes, or
    sets of even size would have few bits set and look alike.
    """
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64 * words, np.int64)
    for at in range(0, len(parts), 255):  # so many fit a sum of bytes
        some = parts[at : at + 255]
        h = np.fromiter((digest(p, 42) for p in some), np.uint64, len(some))
        x = np.stack([h, *[mix(h + np.uint64(i * _GOLDEN & (1 << 64) - 1)) for i in range(1, words)]], axis=1)
        bits = np.unpackbits(x.astype("<u8", copy=False).view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
    out = counts * 2 > len(parts)
    if ties and parts:
        out |= (counts * 2 == len(parts)) & (np.arange(64 * words) % 2 == 1)
    return np.packbits(out, bitorder="little").view("<u8")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    return int(majority(_shingles(text, shingle))[0])


def second_print(text: str | None, shingle: int) -> tuple[int, np.ndarray]:
    """The number of distinct shingles and their PRINT_WORDS * 64 majority bits."""
    parts = list(set(_shingles(text, shingle)))
    return len(parts), majority(parts, PRINT_WORDS, ties=True)


def most_bits(similarity: float, slack: float = SLACK) -> int:
    """Bits of a second print that may differ for sets of that Jaccard similarity."""
    bits, share = 64 * PRINT_WORDS, math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(bits * share + slack * math.sqrt(bits * share * (1 - share)))


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", verify_shingle: int = 0, families: int = 1, distinct: bool = False) -> DataFrame:
    """(doc_id, fp [, fp1 ...] [, n, p0 ...]) per row; the fps are the fingerprints'
    64 bits as signed longs, n and the p's the second print if ``verify_shingle`` is given."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()
    names = [*fp_names(families), *(PRINT if verify_shingle else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, len(names)), np.uint64)
            for i, text in enumerate(batch.column(1)):
                text = text.as_py()
                parts = _shingles(text, shingle)
                out[i, :families] = majority(list(set(parts)) if distinct else parts, families)
                if verify_shingle:
                    out[i, families], out[i, families + 1 :] = second_print(text, verify_shingle)
            columns = {name: pa.array(np.ascontiguousarray(out[:, j]).view(np.int64)) for j, name in enumerate(names)}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **columns})

    return picked.mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{name} long" for name in names))


# -------------------------------------------------------------------- BK-forest
class Forest:
    """BK-trees over ``fp``, one per group of equal consecutive ``shard`` labels."""

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        self.fp = fp
        n = len(fp)
        new = np.ones(n, bool)
        new[1:] = shard[1:] != shard[:-1]
        self.root_shard, self.root = shard[new], np.flatnonzero(new)
        at = self.root[np.cumsum(new) - 1]
        rest = np.flatnonzero(~new)
        at = at[rest]
        keys, kids = [], []
        while len(rest):
            edge = at * 65 + np.bitwise_count(fp[rest] ^ fp[at])
            order = np.argsort(edge, kind="stable")
            edge, rest = edge[order], rest[order]
            first = np.ones(len(rest), bool)
            first[1:] = edge[1:] != edge[:-1]
            keys.append(edge[first])
            kids.append(rest[first])
            at = rest[first][np.cumsum(first) - 1][~first]
            rest = rest[~first]
        self.key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.kid = np.concatenate(kids) if kids else np.zeros(0, np.int64)
        order = np.argsort(self.key, kind="stable")
        self.key, self.kid = self.key[order], self.kid[order]

    def search(self, query: np.ndarray, shard: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query index, tree index) within the radius, in pieces."""
        spot = np.minimum(np.searchsorted(self.root_shard, shard), len(self.root_shard) - 1)
        has = self.root_shard[spot] == shard
        todo = [(np.flatnonzero(has), self.root[spot[has]])]
        while todo:
            q, node = todo.pop()
            if len(q) > _OPEN_PAIRS:
                half = len(q) // 2
                todo += [(q[:half], node[:half]), (q[half:], node[half:])]
                continue
            d = np.bitwise_count(query[q] ^ self.fp[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield q[near], node[near]
            low = np.searchsorted(self.key, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.key, node * 65 + np.minimum(d + radius, 64), "right")
            # children of a window are consecutive: open them in pieces
            sums = np.cumsum(high - low)
            cut = 0
            while cut < len(q):
                base = sums[cut - 1] if cut else 0
                stop = max(cut + 1, int(np.searchsorted(sums, base + _OPEN_PAIRS, "right")))
                wide = (high - low)[cut:stop]
                total = int(wide.sum())
                if total:
                    begin = np.repeat(low[cut:stop] - (np.cumsum(wide) - wide), wide)
                    todo.append((np.repeat(q[cut:stop], wide), self.kid[begin + np.arange(total)]))
                cut = stop


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label``, a root for each number, after the links i-j; roots are the smallest."""
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def lightest(i: np.ndarray, j: np.ndarray, weight: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Positions of the links i-j in the lightest forest that joins what ``label`` leaves apart."""
    order = np.lexsort((j, i, weight))
    i, j, alive = i[order], j[order], np.arange(len(i))
    kept = np.zeros(len(i), bool)
    while True:
        a, b = label[i[alive]], label[j[alive]]
        apart = a != b
        alive, a, b = alive[apart], a[apart], b[apart]
        if not len(alive):
            return order[kept]
        # ranks are distinct, so the least links of all components close no cycle
        best = np.full(len(label), len(i))
        np.minimum.at(best, a, alive)
        np.minimum.at(best, b, alive)
        taken = np.unique(best[best < len(i)])
        kept[taken] = True
        label = _joined(label, i[taken], j[taken])


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (value, smallest value of its component) equivalent to the links a-b."""
    values, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = index[: len(a)], index[len(a) :]
    label = _joined(np.arange(len(values)), i, j)
    off = label != np.arange(len(values))
    return values[off], values[label[off]]


def _asking(tree: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Rows that query their shard's tree: all of them, or where two blocks meet those of the second."""
    two = np.zeros(int(shard[-1]) + 1 if len(shard) else 0, bool)
    two[shard[~tree]] = True
    return np.flatnonzero(~tree | ~two[shard])


def _links(fp: np.ndarray, tree: np.ndarray, shard: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not tree.any():
        return a, b
    members, asking = fp[tree].view(np.uint64), _asking(tree, shard)
    forest, mine = Forest(members, shard[tree]), fp[asking]
    held = [(a, b)]
    size = 0
    for q, node in forest.search(mine.view(np.uint64), shard[asking], radius):
        other = members[node].view(np.int64)
        differ = mine[q] != other
        held.append((mine[q][differ], other[differ]))
        size += int(differ.sum())
        if size > _OPEN_PAIRS:
            held = [spanning(*map(np.concatenate, zip(*held)))]
            size = len(held[0][0])
    return spanning(*map(np.concatenate, zip(*held)))


def _variant_links(table: np.ndarray, shard: np.ndarray, fp: np.ndarray, tree: np.ndarray, node: np.ndarray, second: list[np.ndarray], masks: list[int], radius: int, similarity: float, exact: bool, forests: int = FORESTS, root: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same between variants: rows sorted by shard and fp, several per fp; and 1 for
    those that are sure, 0 for pairs to compare, -1 for a node (with itself) that has
    pairs which the forests leave out. With ``root`` all pairs between different roots
    are to compare.

    Two fps within the radius may meet in several tables: the first one counts.
    """
    inside = np.flatnonzero(tree)
    if not len(inside):
        return

    def groups(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        new = np.ones(len(rows), bool)
        new[1:] = (shard[rows][1:] != shard[rows][:-1]) | (fp[rows][1:] != fp[rows][:-1])
        start = np.flatnonzero(new)
        return start, np.diff(start, append=len(rows))

    asking = _asking(tree, shard)
    (q_at, q_size), (n_at, n_size) = groups(asking), groups(inside)
    query, members = fp[asking[q_at]].view(np.uint64), fp[inside[n_at]].view(np.uint64)
    alone = tree[asking[q_at]]
    sizes, prints = (second[0], np.stack(second[1:]).view(np.uint64)) if second else (np.zeros(len(fp), np.int64), np.zeros((0, len(fp)), np.uint64))
    label = np.arange(len(fp))
    few_bits, most = (most_bits(similarity, -SURE), most_bits(similarity, DOUBT)) if exact else (most_bits(similarity),) * 2
    if root is not None:
        few_bits, label = -1, np.unique(root, return_inverse=True)[1]
    left_out = np.zeros(len(fp), bool)
    doubt = [(label[:0], label[:0], label[:0].astype(np.uint64))]

    def compare(q: np.ndarray, r: np.ndarray) -> None:
        """Join the rows q and r, of shapes that broadcast, where they agree."""
        n, m = sizes[q], sizes[r]
        near = (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9) & (label[q] != label[r])
        if not near.any():
            return
        if near.ndim == 1:
            q, r = q[near], r[near]
            near = np.ones(len(q), bool)
        bits = np.zeros(near.shape, np.uint16)
        for p in prints:
            bits += np.bitwise_count(p[q] ^ p[r])
        near &= bits <= most
        q, r, bits = np.broadcast_to(q, near.shape)[near], np.broadcast_to(r, near.shape)[near], bits[near]
        if exact:
            # ties go by the prints, so that no numbering takes part
            unsure = bits > few_bits
            x, y = q[unsure], r[unsure]
            tie = mix(prints[0][x] ^ prints[0][y]) >> np.uint64(16)
            if len(x):
                doubt.append((x, y, bits[unsure].astype(np.uint64) << np.uint64(48) | tie))
            q, r = q[~unsure], r[~unsure]
        while len(q):
            a, b = label[q], label[r]
            apart = a != b
            q, r, a, b = q[apart], r[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label[label] != label).any():
                label[:] = label[label]
        if root is None and full():
            doubt[:] = [light()]

    def full() -> bool:
        return len(doubt) > 4_000 or sum(len(x) for x, *_ in doubt) > _OPEN_PAIRS

    def all_pairs() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, y, _ = map(np.concatenate, zip(*doubt))
        del doubt[1:]
        return node[x], node[y], np.zeros(len(x), np.int8)

    def light() -> tuple[np.ndarray, ...]:
        x, y, weight = map(np.concatenate, zip(*doubt))
        left, taken = np.arange(len(x)), []
        for _ in range(forests):
            found = lightest(x[left], y[left], weight[left], label)
            taken.append(left[found])
            left = np.delete(left, found)
        left = left[label[x[left]] != label[y[left]]]
        left_out[x[left]] = left_out[y[left]] = True
        keep = np.concatenate([left[:0], *taken])
        return x[keep], y[keep], weight[keep]

    for qs, ns in Forest(members, shard[inside[n_at]]).search(query, shard[asking[q_at]], radius):
        x = query[qs] ^ members[ns]
        at = table[asking[q_at[qs]]]
        # one of the two directions, if both are asked; a fingerprint meets itself in table 0
        first = np.where(x == 0, at == 0, ~alone[qs] | (query[qs] > members[ns]))
        qs, ns, x, at = qs[first], ns[first], x[first], at[first]
        first = np.ones(len(x), bool)
        for t, mask in enumerate(masks):
            first &= (at <= t) | ((x & np.uint64(mask & (1 << 64) - 1)) != 0)
        qs, ns = qs[first], ns[first]
        pairs = q_size[qs] * n_size[ns]
        few = pairs <= _TILE
        a, b, pairs_few = qs[few], ns[few], pairs[few]
        sums, cut = np.cumsum(pairs_few), 0
        while cut < len(a):
            stop = max(cut + 1, int(np.searchsorted(sums, (sums[cut - 1] if cut else 0) + _OPEN_PAIRS, "right")))
            wide = pairs_few[cut:stop]
            off = np.arange(int(wide.sum())) - np.repeat(np.cumsum(wide) - wide, wide)
            begin, start, width = (np.repeat(v[cut:stop], wide) for v in (q_at[a], n_at[b], n_size[b]))
            compare(asking[begin + off // width], inside[start + off % width])
            cut = stop
            if root is not None and full():
                yield all_pairs()
        for i, j in zip(qs[~few].tolist(), ns[~few].tolist()):
            rows, others = asking[q_at[i] : q_at[i] + q_size[i]], inside[n_at[j] : n_at[j] + n_size[j]]
            for u in range(0, len(rows), 512):
                for v in range(0, len(others), 1024):
                    compare(rows[u : u + 512, None], others[None, v : v + 1024])
                    if root is not None and full():
                        yield all_pairs()
    if root is not None:
        yield all_pairs()
        return
    off = label != np.arange(len(label))
    a, b = spanning(node[off], node[label[off]])
    x, y, _ = light()
    alone = np.unique(node[left_out])
    yield np.concatenate([a, node[x], alone]), np.concatenate([b, node[y], alone]), np.repeat(np.array([1, 0, -1], np.int8), [len(a), len(x), len(alone)])


def shard_edges(distinct: DataFrame, radius: int = 3, shard_rows: int = SHARD_ROWS, similarity: float = 0.8, exact: bool = False, forests: int = FORESTS) -> DataFrame:
    """(a, b): edges that span the links of at most ``radius`` bits between distinct
    fps; or, with a column ``node``, (a, b, sure) between the nodes of such fps whose
    second prints, if they have any, agree with that similarity. All are sure unless
    ``exact``; there those that aren't (0) are the pairs to compare, and -1 marks nodes
    with pairs left out. With a column ``root`` too, all pairs of different roots."""
    n = distinct.count()
    extra = [c for c in ["node", "root", *PRINT] if c in distinct.columns]
    named, rooted = "node" in extra, "root" in extra
    if named:
        # longer keys in more tables once the mean shard would pass 64 rows, or 512
        # where the step is to three free blocks: tables then cost more disk than trees cost time
        free = next((e for e, mean in ((1, 64), (2, 512)) if n <= mean << 64 * e // (radius + e)), 3)
    else:
        free = next((e for e in (1, 2) if n <= TREE_ROWS << 64 * e // (radius + e)), 3)
    blocks = radius + free
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    # texts that share whole blocks share any bits of these: keys of few bits leave the search to the trees
    wide = 64 if named else max(0, (n // TREE_ROWS).bit_length() - 1)
    masks = []
    for kept in combinations(range(blocks), blocks - radius) if wide else [()]:  # without a key one table has all
        bits = [k for i in kept for k in range(edges[i], edges[i + 1])]
        m = sum(1 << k for k in bits[:wide])
        masks.append(m - (1 << 64) if m >> 63 else m)
    keyed = distinct.select("fp", *extra, F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks)])).alias("s")).select("fp", *extra, "s.t", "s.key")
    hot = keyed.groupBy("t", "key").count().where(F.col("count") > shard_rows)
    hot = materialise(hot.select("t", "key", F.ceil(F.col("count") / shard_rows).cast("long").alias("cuts")), "hot_shards")
    if hot.count() <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    dealt = keyed.join(hot, ["t", "key"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1).cast("long")))
    # block b of a hot shard goes to all pairs (b, other): as the tree if it is the first of the two
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node" if named else "fp"), F.col("cuts")))
    dealt = dealt.withColumn("other", F.explode_outer(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    cut = F.least("block", "other") * F.col("cuts") + F.greatest("block", "other")
    dealt = dealt.select("t", "key", cut.alias("cut"), "fp", (F.col("block") <= F.col("other")).alias("tree"), *extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[np.ndarray] = []

        def solve(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            t, key, cut, fp, tree, *second = cols
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (key[1:] != key[:-1]) | (cut[1:] != cut[:-1])
            shard = np.cumsum(new)
            many = np.bincount(shard)[shard] > 1
            if named:
                node, *second = (v[many] for v in second)
                root = second.pop(0) if rooted else None
                for a, b, sure in _variant_links(t[many], shard[many], fp[many], tree[many], node, second, masks, radius, similarity, exact, forests, root):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b), "sure": pa.array(sure)})
                return
            a, b = _links(fp[many], tree[many], shard[many], radius)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5 + len(extra))]
            left = [np.concatenate(x) for x in zip(left, cols)] if left else cols
            if len(left[0]) >= 200_000:
                same = (left[0] == left[0][-1]) & (left[1] == left[1][-1]) & (left[2] == left[2][-1])
                stop = int(np.argmax(same))  # rows are sorted: the last shard may go on
                if stop:
                    yield from solve([x[:stop] for x in left])
                    left = [x[stop:] for x in left]
        if left and len(left[0]):
            yield from solve(left)

    parts = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), n * len(masks) // 2_000_000)
    placed = dealt.repartition(parts, "t", "key", "cut").sortWithinPartitions("t", "key", "cut", "fp")
    return placed.mapInArrow(run, "a long, b long, sure byte" if named else "a long, b long")


def _classes(distinct: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """(fp, component_id) from (fp, least), one row per fp."""
    roots = connected_components(shard_edges(distinct.drop("least"), radius, shard_rows))
    rooted = distinct.select("fp", "least").join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = least_by(rooted, "root", "least", "component_id")
    return rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, set): the 64-bit hashes of a text's distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # one text's shingles at a time
                h = np.unique(np.array([xxhash.xxh3_64_intdigest(p) for p in _shingles(batch.column(1)[i].as_py(), shingle)], np.uint64))
                found = pa.ListArray.from_arrays(pa.array([0, len(h)], pa.int32()), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_pydict({"node": batch.column(0).slice(i, 1), "set": found})

    return texts.mapInArrow(run, "node long, set array<long>")


def _confirmed(texts: DataFrame, variants: DataFrame, links: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(node, root) over the sure links and those others whose texts have that similarity.

    ``texts`` are (key, text), ``variants`` (node, key): any text of a variant stands for it.
    """
    sure = materialise(connected_components(links.where("sure = 1").select("a", "b")), "sure_components")
    named = variants.select("node").join(sure, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return _joined_alike(texts, variants, links.where("sure = 0"), sure, named, shingle, similarity)


def _joined_alike(texts: DataFrame, variants: DataFrame, doubt: DataFrame, known: DataFrame, named: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """``named`` (node, root) after the links among the pairs ``doubt`` (a, b); ``known``: the rows of it that have another root."""
    doubt = doubt.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for end in "ab":
        root = known.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        doubt = doubt.join(root, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    doubt = materialise(doubt.where("_a != _b"), "doubtful_links")
    ends = doubt.select(F.col("a").alias("node")).unionAll(doubt.select(F.col("b").alias("node"))).distinct()
    wanted = materialise(ends.join(variants.select("node", "key"), "node"), "doubtful_variants")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    # copies of a text meet in partial aggregates before they are shuffled
    picked = texts.join(wanted, "key").groupBy("node").agg(F.first("text").alias("text"))
    sets = materialise(shingle_sets(picked, shingle), "shingle_sets")
    for end in "ab":
        doubt = doubt.join(sets.select(F.col("node").alias(end), F.col("set").alias(f"set_{end}")), end)
    both = F.size(F.array_intersect("set_a", "set_b"))
    alike = both >= similarity * (F.size("set_a") + F.size("set_b") - both) - 1e-9
    more = materialise(doubt.where(alike).select(F.col("_a").alias("a"), F.col("_b").alias("b")), "confirmed_links")
    joined = connected_components(more).select(F.col("node").alias("root"), F.col("root").alias("_root"))
    return named.join(joined, "root", "left").select("node", F.coalesce("_root", "root").alias("root"))


def _with_rest(texts: DataFrame, variants: DataFrame, fps: list[str], links: DataFrame, roots: DataFrame, radius: int, shard_rows: int, shingle: int, similarity: float) -> DataFrame:
    """``roots`` after the links among all pairs that forests left out: they are between marked nodes."""
    marked = materialise(links.where("sure = -1").select(F.col("a").alias("node")).distinct(), "left_out")
    if not marked.limit(1).count():
        return roots
    roots = materialise(roots, "roots")
    some = materialise(variants.join(marked, "node").join(roots, "node"), "left_out_variants")
    pairs = [materialise(shard_edges(some.select(F.col(fp).alias("fp"), "node", "root", *PRINT), radius, shard_rows, similarity, True), "left_out_pairs") for fp in fps]
    return _joined_alike(texts, variants, reduce(DataFrame.unionByName, pairs), roots, roots, shingle, similarity)


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD_ROWS, verify_shingle: int = 0, similarity: float = 0.8, families: int = 1, distinct: bool = False, exact: bool = False, forests: int = FORESTS) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) per row; with
    ``verify_shingle`` links also need that similarity of the second print, and
    with ``exact`` that of the sets of shingles."""
    if exact and not verify_shingle:
        raise ValueError("exact needs verify_shingle")
    text = F.coalesce(text_col, F.lit(""))
    key = F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit("key"), text).alias("y"))
    mark = F.struct(F.col(id_col).alias("id"), key.alias("key")) if exact else F.col(id_col)
    prints = fingerprints(docs.select(mark.alias("doc_id"), F.col(text_col).alias("text")), shingle, "doc_id", "text", verify_shingle, families, distinct)
    if exact:
        prints = prints.select(F.col("doc_id.key").alias("key"), F.col("doc_id.id").alias("doc_id"), *[c for c in prints.columns if c != "doc_id"])
    prints = materialise(prints, "fingerprints")
    fps = fp_names(families)
    second = PRINT if verify_shingle else []
    if families == 1 and not second:
        once = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fingerprints")
        found = prints.join(_classes(once, radius, shard_rows), "fp")
        return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    # texts of equal prints are one variant; its number is written, so it stays
    variant = [*fps, *second]
    variants = prints.groupBy(*variant).agg(F.min("doc_id").alias("own"), *([F.min("key").alias("key")] if exact else [])).withColumn("node", F.monotonically_increasing_id())
    variants = materialise(variants, "variants")
    links = []
    for fp in fps:
        some = variants.select(F.col(fp).alias("fp"), "node", *second)
        links.append(materialise(shard_edges(some, radius, shard_rows, similarity, exact, forests), "links"))
    links = reduce(DataFrame.unionByName, links)
    if exact:
        texts = docs.select(key.alias("key"), text.alias("text"))
        roots = _confirmed(texts, variants, links, verify_shingle, similarity)
        roots = _with_rest(texts, variants, fps, links, roots, radius, shard_rows, verify_shingle, similarity)
    else:
        roots = connected_components(links.select("a", "b"))
    rooted = variants.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = least_by(rooted, "root", "own", "component_id")
    named = rooted.join(smallest, "root").select(*variant, "component_id")
    # written, so that the join's partitioning is its own and adaptive execution may split a hot variant
    named = materialise(named, "named")
    found = prints.join(named, variant)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
