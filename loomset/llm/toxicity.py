"""Toxicity scores: FTRL-proximal logistic regression on hashed word n-grams.

Features are presence of single words, word pairs and skip-pairs (one word left
out), hashed to ``2**BITS`` coordinates; words are lower-cased runs of letters,
digits and non-ASCII bytes. FTRL-proximal gives every coordinate its own rate
and an L1 term that leaves most weights at exactly zero, so the model is a few
thousand (index, weight) pairs and is broadcast; its size is bounded by
``2**BITS`` whatever the corpus. Scoring is one pass without a shuffle.

Training takes at most ``SAMPLE`` labelled documents of the training folds (a
documented bound; the first by hash of the id, one row of each id), and of those
in this order the ones that fit ``SAMPLE_FEATURES`` coordinates together, in one
task, for ``EPOCHS`` passes in a fixed order.

Defined cases: null and empty texts are scored by the bias alone; documents
without label only get scored; several labels of one id count as toxic if any
is; null ids are scored and never trained on; without any label every score is
0.5; repeated rows are scored once each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import distinct, fold, mix, split_words, text_chunks

BITS, SAMPLE, SAMPLE_FEATURES, EPOCHS = 20, 12_000, 40_000_000, 4
#: Of a grid of rates and L1 terms, the pair with the least log loss when each training fold scores the other (sf0.1).
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.0
THRESHOLD = 0.7


def features(texts: pa.Array, bits: int = BITS, live: np.ndarray | None = None) -> np.ndarray:
    """Distinct (text number << bits | coordinate), ascending; long texts in bounded pieces.

    With ``live``, a flag per coordinate, only those flagged."""
    found, before = [np.zeros(0, np.int64)], np.zeros(0, np.uint64)
    for first, offsets, data, opens, closes in text_chunks(texts):
        index, forms, counts = split_words(offsets, data, letters_only=True)
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, forms), np.uint64, len(forms))[index]
        doc = np.repeat(np.arange(first, first + len(counts)), counts)
        if not opens:  # the two words before go on; seen again, they change nothing
            words, doc = np.concatenate([before, words]), np.concatenate([np.full(len(before), first), doc])
        before = words[-2:]
        parts = [doc << bits | (words >> np.uint64(64 - bits)).astype(np.int64)]
        for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
            same = doc[gap:] == doc[:-gap]
            pair = mix(words[:-gap] * np.uint64(0x9E3779B97F4A7C15) + words[gap:] + np.uint64(salt))
            parts.append((doc[gap:] << bits | (pair >> np.uint64(64 - bits)).astype(np.int64))[same])
        every = np.concatenate(parts)
        found.append(distinct(every if live is None else every[live[every & ((1 << bits) - 1)]]))
    return distinct(np.concatenate(found))


def ftrl(rows: list[tuple[np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> tuple[np.ndarray, np.ndarray, float]:
    """(indices, weights, bias) of FTRL-proximal over (distinct coordinates, label) rows."""
    z, root = np.zeros(1 << bits), np.zeros(1 << bits)  # root: of the sums of squared gradients
    bias_z = bias_root = bias = 0.0  # the bias has no L1
    for _ in range(epochs):
        for index, label in rows:
            zi, ri = z[index], root[index]
            # the weight: minus the part of z beyond the L1 term, over the coordinate's own rate
            w = (np.minimum(np.maximum(zi, -l1), l1) - zi) / ((beta + ri) / alpha + l2)
            g = 1 / (1 + math.exp(-min(max(w.sum() + bias, -35.0), 35.0))) - label
            grown = np.sqrt(ri * ri + g * g)
            z[index] = zi + g - (grown - ri) / alpha * w
            root[index] = grown
            grown_bias = math.sqrt(bias_root * bias_root + g * g)
            bias_z += g - (grown_bias - bias_root) / alpha * bias
            bias_root = grown_bias
            bias = -bias_z / ((beta + bias_root) / alpha + l2)
    every = np.flatnonzero(np.abs(z) > l1)
    weight = (np.sign(z[every]) * l1 - z[every]) / ((beta + root[every]) / alpha + l2)
    return every, weight, bias


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", held_out: int = 1, folds: int = 3, sample: int = SAMPLE, bits: int = BITS, most: int = SAMPLE_FEATURES) -> tuple[np.ndarray, np.ndarray, float]:
    """The sparse model; labels of the held-out fold are never read."""
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(known), "doc_id")  # at most `sample` small rows are sent
    rows = rows.groupBy("doc_id").agg(F.min("label").alias("label"), F.min("text").alias("text"))  # one of an id's rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                pairs = features(batch.column(2), bits)
                ends = np.searchsorted(pairs >> bits, np.arange(batch.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((pairs & ((1 << bits) - 1)).astype(np.int32)))
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "label": batch.column(1), "index": lists})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for label, index in zip(batch.column(1).to_pylist(), batch.column(2)):
                if held + len(index) <= most:
                    rows.append((index.values.to_numpy().copy(), label))
                    held += len(index)
        if rows:
            index, weight, bias = ftrl(rows, bits)
            yield pa.RecordBatch.from_pydict({"index": pa.array([*index, -1], pa.int64()), "weight": pa.array([*weight, bias], pa.float64())})

    id_type = rows.schema["doc_id"].dataType.simpleString()
    extracted = rows.mapInArrow(extract, f"doc_id {id_type}, label int, index array<int>")
    ordered = extracted.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "label", "index")
    model = ordered.mapInArrow(fit, "index long, weight double").toPandas()
    inner = model[model["index"] >= 0].sort_values("index")
    bias = model[model["index"] < 0]["weight"]
    return inner["index"].to_numpy(np.int64), inner["weight"].to_numpy(float), float(bias.sum())


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(doc_id, score) per row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = picked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, weight, bias = shipped.value
        table = np.zeros(1 << bits)
        table[where] = weight
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                pairs = features(batch.column(1), bits, table != 0)
                total = bias + np.bincount(pairs >> bits, table[pairs & ((1 << bits) - 1)], batch.num_rows)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))))})

    return picked.mapInArrow(run, f"doc_id {id_type}, score double")
