"""Benchmark decontamination by spaced-seed hashing, DataFrame functions only.

Texts become runs of letters and digits, lower-cased. The seed is the fixed
mask 1001001001: it keeps every third of ten tokens and ignores the others. A
window of 13 tokens with at most two substitutions always leaves one of its
three residue classes untouched, so one seed hash per position, the same mask
at three shifts, finds every such window. Benchmark hashes and document hashes
are joined, and around each hit the aligned tokens are compared: a pair counts
if some window of 13 benchmark tokens has at least 11 equal document tokens at
one alignment (document positions outside the text count as different).

Documents are read once and never shuffled: the benchmark's seeds are the small
side, broadcast if there are at most ``BLOCK_SEEDS``. Of a larger benchmark only
the seed hashes are broadcast, in blocks of at most ``FILTER_SEEDS``, each against
all documents; the few positions whose hash occurs then carry the tokens around
them to an ordinary join with the seeds. Equal surroundings of one item are one
seed, so a text that repeats a phrase meets an item that repeats it once a position.

Benchmark items of 1 to 12 tokens are matched whole and exactly: for each length
that occurs, the hash of that many tokens at each position is joined with the
items' hashes, and equal hashes are verified token by token.

Defined cases: null and empty texts have no windows and, as items, match nothing;
null and repeated document ids are reported under that
id; repeated items are reported under each item id; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

WINDOW, NEEDED, STRIDE, KEPT = 13, 11, 3, 4
SPAN = STRIDE * (KEPT - 1) + 1
#: Seeds that are broadcast whole (about 300 bytes each), and hashes in one block of a filter (about 40).
BLOCK_SEEDS, FILTER_SEEDS = 50_000, 2_000_000
_LEAD = WINDOW - SPAN


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(words: str) -> Column:
    """The spaced-seed hash at each position, null where the mask doesn't fit."""
    w = F.col(words)

    def at(x: Column, i: Column) -> Column:
        return F.when(i + (SPAN - 1) < F.size(w), F.xxhash64(x, *[F.get(w, i + STRIDE * j) for j in range(1, KEPT)]))

    return F.transform(w, at)


def benchmark_seeds(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(seed, item_id, fits, around): the 16 tokens around a seed position, and which
    windows of them lie inside the item; each surrounding of an item once."""
    items = benchmark.select(F.col(id_col).alias("item_id"), tokens(F.col(text_col)).alias("words")).distinct()
    items = items.where(F.size("words") >= WINDOW)
    rows = items.select("item_id", "words", F.posexplode_outer(_seeds("words")).alias("k", "seed")).where(F.col("seed").isNotNull())
    k = F.col("k")
    fits = F.array(*[(k - _LEAD + j >= 0) & (k - _LEAD + j + WINDOW <= F.size("words")) for j in range(_LEAD + 1)])
    return rows.select("seed", "item_id", fits.alias("fits"), _around(k).alias("around")).distinct()


def _around(at: Column) -> Column:
    """The 16 tokens around a position of ``words``, null outside."""
    return F.array(*[F.when(at + j >= 0, F.get("words", at + j)) for j in range(-_LEAD, SPAN + _LEAD)])


# The outer form of posexplode matters: for the inner one the optimizer infers a
# size filter below, with the word split repeated inside the lambda.
def _hits(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    joined = _positions(docs).join(F.broadcast(seeds), "seed")
    p = F.col("p")
    return _verified(joined, lambda i: F.when(p + (i - _LEAD) >= 0, F.get("words", p + (i - _LEAD))))


def _positions(docs: DataFrame) -> DataFrame:
    return docs.withColumn("seeds", _seeds("words")).select("doc_id", "words", F.posexplode_outer("seeds").alias("p", "seed"))


def _hits_of_many(docs: DataFrame, seeds: DataFrame, n: int) -> DataFrame:
    """The same for a benchmark whose seeds are too many to broadcast: its hashes filter first."""
    seeds = materialise(seeds, "benchmark_seeds")
    hashes, blocks = seeds.select("seed").distinct(), -(-n // FILTER_SEEDS)
    some = [hashes.where(F.pmod("seed", F.lit(blocks)) == b) for b in range(blocks)]
    kept = [_positions(docs).join(F.broadcast(h), "seed", "left_semi").select("doc_id", "p", "seed", _around(F.col("p")).alias("own")) for h in some]
    # written, so that a seed that many documents share may be split
    found = materialise(reduce(DataFrame.unionByName, kept), "seed_hits")
    return _verified(found.join(seeds, "seed"), lambda i: F.get("own", F.lit(i)))


def _verified(joined: DataFrame, own: Callable[[int], Column]) -> DataFrame:
    """Hits whose tokens agree in some window; ``own`` gives the document's tokens around a hit."""
    p = F.col("p")
    same = [F.when(own(i) == F.get("around", F.lit(i)), 1).otherwise(0).alias(f"e{i}") for i in range(SPAN + 2 * _LEAD)]
    compared = joined.select("doc_id", "item_id", "p", "fits", *same)
    counts = []
    for j in range(_LEAD + 1):
        total = reduce(lambda a, b: a + b, [F.col(f"e{i}") for i in range(j, j + WINDOW)])
        counts.append(F.when(F.get("fits", F.lit(j)), total).otherwise(0).alias(f"c{j}"))
    counted = compared.select("doc_id", "item_id", "p", *counts)
    names = [f"c{j}" for j in range(_LEAD + 1)]
    return counted.where(F.greatest(*names) >= NEEDED).select(
        "doc_id", "item_id",
        F.greatest(*names).alias("matched"),
        F.coalesce(*[F.when(F.col(c) >= NEEDED, p - _LEAD + j) for j, c in enumerate(names)]).alias("first_word"),
    )


def _short_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(hash, item_id, item): the items too short for a window."""
    items = benchmark.select(F.col(id_col).alias("item_id"), tokens(F.col(text_col)).alias("item")).distinct()
    return items.where(F.size("item").between(1, WINDOW - 1)).select(F.xxhash64("item").alias("hash"), "item_id", "item")


def _whole(docs: DataFrame, items: DataFrame, lengths: list[int]) -> DataFrame:
    w = F.col("words")

    def at(x: Column, i: Column) -> Column:
        return F.array(*[F.when(i + n <= F.size(w), F.xxhash64(F.slice(w, i + 1, n))) for n in lengths])

    places = docs.withColumn("hashes", F.transform(w, at)).select("doc_id", "words", F.posexplode_outer("hashes").alias("p", "some"))
    rows = places.select("doc_id", "words", "p", F.explode_outer("some").alias("hash"))
    joined = rows.join(F.broadcast(items), "hash").where(F.slice(w, F.col("p") + 1, F.size("item")) == F.col("item"))
    return joined.select("doc_id", "item_id", F.size("item").alias("matched"), F.col("p").alias("first_word"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, matched (most equal tokens of 13, or all of a shorter item), first_word (where the first such window starts)."""
    seeds = benchmark_seeds(benchmark, item_col, item_text_col)
    n = seeds.count()
    picked = docs.select(F.col(id_col).alias("doc_id"), tokens(F.col(text_col)).alias("words"))
    parts = [_hits(picked, seeds) if n <= BLOCK_SEEDS else _hits_of_many(picked, seeds, n)]
    short = _short_items(benchmark, item_col, item_text_col)
    sizes = {r.n: r["count"] for r in short.groupBy(F.size("item").alias("n")).count().collect()}
    blocks = -(-sum(sizes.values()) // BLOCK_SEEDS)
    parts += [_whole(picked, short.where(F.pmod(F.xxhash64("hash", "item_id"), F.lit(blocks)) == b), sorted(sizes)) for b in range(blocks)]
    found = reduce(DataFrame.unionByName, parts)
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").cast("int").alias("matched"), F.min("first_word").cast("int").alias("first_word"))
