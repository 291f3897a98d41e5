"""Document fingerprints: a Merkle tree over sections, paragraphs and spans.

A text is cut into paragraphs at line feeds; runs of paragraphs form sections,
closed by an empty paragraph or where a paragraph's hash says so. Paragraphs are
cut into spans of ``SPAN`` characters on average, after each character where a
hash of the last four says so, in any script and without need of blanks or
marks; a span of ``LONGEST`` characters is cut as it stands. All of these cuts
are made by content, so an edit moves no cut but those next to it. Leaves hash
spans, inner nodes hash their children in order.

Roots test equality. Otherwise two trees are compared from the root down: equal
sections are matched (occurrence by occurrence), only the others are opened and
their paragraphs matched, and only the spans of those without a match are looked
at. Likeness is the share of text, in characters, below matched branches:
2 * common / (a + b), from 0 to 1. Branches without a match, and those matched
out of order, locate the edits.

To compare each document with the next one, documents are range-partitioned and
sorted by id once; a task streams pairs and hands only its first and last
document over to the neighbouring partitions.

Defined cases: null text is empty; two empty texts have likeness 1, an empty
and another one 0; null ids come first in the order; repeated ids follow each
other in order of their text; a table of one row is its own next document;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, mix

SPAN, LONGEST = 16, 256
#: Odd multipliers of the last four characters.
_WINDOW = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def span_ends(codes: np.ndarray) -> np.ndarray:
    """Where spans end (exclusive), ascending; every line feed ends one."""
    n = len(codes)
    wide, h = codes.astype(np.uint64), np.zeros(n, np.uint64)
    for back, k in enumerate(_WINDOW):
        h[back:] += wide[: n - back] * k
    cut = ((mix(h) >> np.uint64(32)) % np.uint64(SPAN) == 0) | (codes == 10)
    cut[n - 1 :] = True
    ends = np.flatnonzero(cut) + 1
    gaps = np.diff(ends, prepend=0)
    long = np.flatnonzero(gaps > LONGEST)
    if len(long):
        ends = np.sort(np.concatenate([ends, *(np.arange(ends[k] - gaps[k] + LONGEST, ends[k], LONGEST) for k in long)]))
    return ends


def _node(children: list[bytes]) -> bytes:
    return hashlib.blake2b(b"".join(children), digest_size=16, person=b"node").digest()


class Tree:
    """leaves: hashes, ``at``: characters before each; paragraphs and sections: (hash, first leaf, leaf after the last)."""

    __slots__ = ("at", "leaves", "paragraphs", "root", "sections")

    def __init__(self, text: str | None):
        self.leaves: list[bytes] = []
        self.at = [0]
        self.paragraphs: list[tuple[bytes, int, int]] = []
        self.sections: list[tuple[bytes, int, int]] = []
        held: list[bytes] = []
        opened = first = 0
        if text:
            raw = (text + "\n").encode("utf-32-le")
            codes = np.frombuffer(raw, "<u4")
            ends = span_ends(codes)
            self.at += ends.tolist()
            digest = xxhash.xxh3_128_digest
            self.leaves = [digest(raw[4 * i : 4 * j]) for i, j in zip(self.at, self.at[1:])]
            for last in (np.flatnonzero(codes[ends - 1] == 10) + 1).tolist():
                node = _node(self.leaves[first:last])
                self.paragraphs.append((node, first, last))
                held.append(node)
                if self.at[last] - self.at[first] == 1 or node[0] & 7 == 0:
                    self.sections.append((_node(held), opened, last))
                    held, opened = [], last
                first = last
        if held:
            self.sections.append((_node(held), opened, first))
        self.root = _node([s[0] for s in self.sections]).hex()


def matched(a: list[tuple[bytes, int, int]], b: list[tuple[bytes, int, int]]) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """(pairs of equal branches, the rest of a, the rest of b), as places in the lists."""
    where: dict[bytes, list[int]] = defaultdict(list)
    for j in range(len(b) - 1, -1, -1):
        where[b[j][0]].append(j)
    pairs, rest = [], []
    for i, (h, _, _) in enumerate(a):
        found = where.get(h)
        if found:
            pairs.append((i, found.pop()))
        else:
            rest.append(i)
    return pairs, rest, sorted(j for left in where.values() for j in left)


def likeness(a: Tree, b: Tree) -> float:
    if a.root == b.root:
        return 1.0
    mine, theirs, common = a.sections, b.sections, 0
    for level in range(3):
        pairs, rest, others = matched(mine, theirs)
        common += sum(a.at[mine[i][2]] - a.at[mine[i][1]] for i, _ in pairs)
        if level < 2:
            mine, theirs = _opened(a, mine, rest, level), _opened(b, theirs, others, level)
    return 2 * common / (a.at[-1] + b.at[-1])


def _opened(tree: Tree, branches: list[tuple[bytes, int, int]], some: list[int], level: int) -> list[tuple[bytes, int, int]]:
    """The children of some branches: of sections (level 0) or of paragraphs."""
    if level:
        return [(tree.leaves[k], k, k + 1) for s in some for k in range(*branches[s][1:])]
    starts = [p[1] for p in tree.paragraphs]
    return [p for s in some for p in tree.paragraphs[bisect_left(starts, branches[s][1]) : bisect_left(starts, branches[s][2])]]


def _moved(pairs: list[tuple[int, int]]) -> list[int]:
    """Places in the first list outside a longest run of pairs that keeps the order of both."""
    tails: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        spot = bisect_left(tails, j)
        before[k] = last[spot - 1] if spot else -1
        tails[spot : spot + 1] = [j]
        last[spot : spot + 1] = [k]
    kept, k = set(), last[-1] if last else -1
    while k >= 0:
        kept.add(k)
        k = before[k]
    return [pairs[k][0] for k in range(len(pairs)) if k not in kept]


def differing(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Leaf ranges of ``a`` that ``b`` lacks or has elsewhere; what ``b`` adds is in differing(b, a)."""
    if a.root == b.root:
        return []
    out, mine, theirs = [], a.sections, b.sections
    for level in range(3):
        pairs, rest, others = matched(mine, theirs)
        out += [mine[i][1:] for i in _moved(pairs)]
        if level < 2:
            mine, theirs = _opened(a, mine, rest, level), _opened(b, theirs, others, level)
        else:
            out += [mine[i][1:] for i in rest]
    joined: list[tuple[int, int]] = []
    for i, j in sorted(out):
        if joined and joined[-1][1] >= i:
            joined[-1] = (joined[-1][0], max(j, joined[-1][1]))
        else:
            joined.append((i, j))
    return joined


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, sections array<string>, n_leaves: the tree's upper levels per row."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [Tree(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "fingerprint": pa.array([t.root for t in trees], pa.string()),
                "sections": pa.array([[s[0].hex() for s in t.sections] for t in trees], pa.list_(pa.string())),
                "n_leaves": pa.array([len(t.leaves) for t in trees], pa.int64()),
            })

    return picked.mapInArrow(run, f"doc_id {id_type}, fingerprint string, sections array<string>, n_leaves long")


def edited_text(text: str, following: str) -> str:
    """The last half (rounded down) replaced by the first as many code points of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compare(text: str, tree: Tree, following: str, after: Tree) -> tuple:
    edited = edited_text(text, following)
    other = Tree(edited)
    return (len(text), hashlib.sha256(edited.encode()).hexdigest(), tree.root, other.root, likeness(tree, other), likeness(tree, after))


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "edge", "text"]


def _pack(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _NAMES)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next per row."""
    spark = docs.sparkSession
    picked = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()
    # a piece of the text is a key as well, so that rows of one id may be split
    ordered = picked.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.substring("text", 1, 16)).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, rows, kind = TaskContext.get().partitionId(), None, [], None
        for batch in batches:
            kind = batch.column(0).type
            for i, t in zip(batch.column(0), batch.column(1)):
                i, t = i.as_py(), t.as_py()
                tree = Tree(t)
                if before is None:
                    rows.append((i, None, None, None, None, None, None, part, "first", t))
                else:
                    rows.append((before[0], *_compare(before[1], before[2], t, tree), part, "", None))
                before = (i, t, tree)
                if len(rows) == 1000:
                    yield _pack(rows, kind)
                    rows = []
        if before is not None:
            rows.append((before[0], None, None, None, None, None, None, part, "last", before[1]))
            yield _pack(rows, kind)

    schema = f"doc_id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, part int, edge string, text string"
    done = materialise(ordered.mapInArrow(run, schema), "neighbours")
    # two edge rows a partition: each last document meets the first of the next partition that has any
    parts = sorted(r.part for r in done.where("edge = 'first'").select("part").collect())
    follow = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    firsts = done.where("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    pairs = done.where("edge = 'last'").select("doc_id", "text", "part").join(follow, "part").join(firsts, "next_part").select("doc_id", "text", "following")

    def seam(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *_compare(t, Tree(t), f, Tree(f)), 0, "", None) for i, t, f in zip(*(c.to_pylist() for c in batch.columns))]
            if rows:
                yield _pack(rows, batch.column(0).type)

    out = done.where("edge = ''").unionByName(pairs.mapInArrow(seam, schema))
    return out.select(*_NAMES[:7])
