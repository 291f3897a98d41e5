"""Importance resampling towards a target: hashed n-gram gains and a Gumbel draw.

Features are runs of 1 to ``n`` words, hashed by CRC-32 into ``buckets``. Two
passes over the texts: the first adds up the features of a bucket in the corpus
and in the target, the second takes each document's mean gain (the scaled logarithm
of the ratio of smoothed shares) plus noise drawn from its id, so the best scores
are a sample without replacement.

Long texts are taken in chunks of ``CHUNK_BYTES``, cut at word boundaries: a chunk
owns the runs that start in it and carries the n-1 words after it, so runs across a
cut count once, and what chunks find is summed by document. A row's chunks stay in
its task: texts aren't shuffled, memory follows a chunk, and repeated rows stay apart.

What is collected and shipped is one number a bucket, a parameter. Ranks come from a
range-partitioned sort of four numbers a document and the sizes of its partitions.

Defined cases: null texts have no words, no features and weight 0; they are scored
and never drawn; documents under ``least_words`` words aren't drawn; ties go to the
smaller id, a null id is the largest and hashes as an empty one; repeated rows are
documents of their own; an empty target or corpus leaves gains of the smoothing
alone; an empty table stays empty; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import _LETTERS, CHUNK_BYTES, materialise, split_words, text_buffer, text_slices

_GAP = _LETTERS == 0x20


def chunks(data: np.ndarray, n: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, int]]:
    """(start, end of what it owns, end with the n-1 words after it) of a text's chunks.

    Ends lie before a separator; a single run without one is not cut."""
    start, size, step = 0, len(data), 1 << 16
    while start < size:
        stop = min(start + limit, size)
        while stop < size and not _GAP[data[stop]]:
            gaps = np.flatnonzero(_GAP[data[stop : stop + step]])
            stop = stop + int(gaps[0]) if len(gaps) else min(size, stop + step)
        more, words = stop, 0
        while more < size and words < n - 1:  # a word ends at a gap that follows a letter
            inside = ~_GAP[data[more : more + step + 1]]
            ends = np.flatnonzero(inside[:-1] & ~inside[1:]) if more + step + 1 < size else np.flatnonzero(inside & ~np.append(inside[1:], False))
            take = min(len(ends), n - 1 - words)
            words += take
            more = more + int(ends[take - 1]) + 1 if take and words == n - 1 else min(size, more + step)
        yield start, stop, more
        start = stop


def run_buckets(offsets: np.ndarray, data: np.ndarray, owned: np.ndarray, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, bucket) of each run of 1 to n words that starts in a piece's first owned[piece] bytes, and the words owned per piece."""
    index, forms, counts = split_words(offsets, data, letters_only=True)
    piece = np.repeat(np.arange(len(counts)), counts)
    word = ~_GAP[data]
    opens = word & ~np.concatenate([[False], word[:-1]])
    opens[offsets[:-1][offsets[:-1] < len(data)]] = word[offsets[:-1][offsets[:-1] < len(data)]]
    at = np.flatnonzero(opens)
    own = at - offsets[piece] < owned[piece]
    crc = np.fromiter(map(zlib.crc32, forms), np.int64, len(forms))
    found = [(piece[own], crc[index][own] % buckets)]
    key, names = index.astype(np.int64), forms
    for length in range(2, n + 1):
        whole = piece[length - 1 :] == piece[: len(piece) - length + 1]
        pairs = key[: len(whole)] * (len(forms) + 1) + index[length - 1 :][: len(whole)]
        _, first, back = np.unique(pairs, return_index=True, return_inverse=True)
        names = [names[key[i]] + b" " + forms[index[i + length - 1]] for i in first.tolist()]
        crc = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
        keep = whole & own[: len(whole)]
        found.append((piece[: len(whole)][keep], crc[back][keep] % buckets))
        key = back
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), np.bincount(piece[own], minlength=len(counts))


def text_runs(texts: pa.Array, n: int, buckets: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, texts, text of each run, its bucket, words per text) of pieces: several whole texts or one chunk."""
    offsets, data = text_buffer(texts)
    i, total = 0, len(texts)
    while i < total:
        j = min(total, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        if j > i:
            bounds = offsets[i : j + 1] - offsets[i]
            yield i, j - i, *run_buckets(bounds, data[offsets[i] : offsets[j]], np.diff(bounds), n, buckets)
            i = j
            continue
        text = data[offsets[i] : offsets[i + 1]]
        for start, stop, more in chunks(text, n, limit):
            yield i, 1, *run_buckets(np.array([0, more - start]), text[start:more], np.array([stop - start]), n, buckets)
        i += 1


def bucket_counts(docs: DataFrame, n: int, buckets: int, text_col: str = "text", limit: int = CHUNK_BYTES) -> np.ndarray:
    """Features of each bucket over all rows; a task sends a number a bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in text_slices(batch, 0):
                for _, _, _, bucket, _ in text_runs(part.column(0), n, buckets, limit):
                    sums += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(some, pa.int64()), "features": pa.array(sums[some], pa.int64())})

    found = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, features long")
    rows = found.groupBy("bucket").agg(F.sum("features").alias("features")).collect()  # `buckets` rows at most
    out = np.zeros(buckets, np.int64)
    for bucket, features in rows:
        out[bucket] = features
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the source."""
    b, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b)))) for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, n: int, id_col: str = "doc_id", text_col: str = "text", limit: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row, without a shuffle."""
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = sent.value
        for whole in batches:
            for batch in text_slices(whole, 1):
                words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
                for first, size, text, bucket, own in text_runs(batch.column(1), n, len(gain), limit):
                    words[first : first + size] += own
                    features[first : first + size] += np.bincount(text, minlength=size)
                    # sums of integers below 2^53 are exact in doubles
                    total[first : first + size] += np.bincount(text, gain[bucket], minlength=size).astype(np.int64)
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_words": words, "n_features": features, "weight": weight})

    return picked.mapInArrow(run, f"doc_id {id_type}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int) -> Column:
    """A document's Gumbel draw times 1000, floored, from its id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary")
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, drawn: int, least_words: int) -> DataFrame:
    """``scored`` (a table) with the rank of the ``drawn`` best of its documents of enough words.

    A range-partitioned sort numbers rows inside a partition; the sizes of the
    partitions before it are added, one number a partition."""
    fit = F.col("n_words") >= least_words
    keys = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    ordered = scored.where(fit).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = materialise(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered_scores")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    before, starts = 0, []
    for k, rows in sorted(ordered.groupBy(part.alias("k")).count().collect()):  # a row a partition
        starts.append((k, before))
        before += rows
    spark = scored.sparkSession
    offsets = F.broadcast(spark.createDataFrame(starts, "k long, before long"))
    placed = ordered.join(offsets, part == F.col("k"), "left").withColumn("rank", F.col("before") + inside + 1)
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(*scored.columns, "rank")
    return placed.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, n: int = 1, buckets: int = 10_000, seed: int = 2024, least_words: int = 20,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", limit: int = CHUNK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) per row; undrawn rows have no rank."""
    gain = gains(bucket_counts(docs, n, buckets, text_col, limit), bucket_counts(target, n, buckets, target_col, limit))
    weighed = weigh(docs, gain, n, id_col, text_col, limit)
    scored = materialise(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance")
    drawn = percent * scored.where(F.col("n_words") >= least_words).count() // 100
    return ranked(scored, drawn, least_words)
