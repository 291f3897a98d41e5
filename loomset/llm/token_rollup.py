"""Token-count rollups maintained by signed deltas.

Totals by source, language and tokenizer version are additive, so a batch only
brings differences: +n for inserted documents, -n for deleted ones, new minus
old for revised counts. A batch is pre-aggregated to one row per cell and
committed under its batch id as one part of a snapshot table, so a retried or
replayed batch is counted once, and of two writers of one id the second changes
nothing. Totals are sums over the parts of one snapshot. ``compact`` replaces the
parts so far by one base of as many rows as there are cells, so that totals cost
what was committed since, not the whole history; the batch ids stay in the snapshot.
Totals of an older snapshot, held or being read meanwhile, don't change.

Counts per document come from pluggable counters (a word counter in built-in
functions, a byte-level BPE counter), so a new tokenizer version is one more
insert of its own cells and never a recount of others.

Defined cases: null text counts as empty; null source or language is a cell of
its own; null and repeated ids are ordinary rows; cells whose documents are all
gone stay with zeros; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.snapshots import SnapshotTable
from .bpe_codec import encode_documents

CELL = ["source", "lang", "tokenizer_version"]


def word_count(text: Column) -> Column:
    """Runs of anything but the six blanks."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def count_words(docs: DataFrame, version: str = "words-1") -> DataFrame:
    """(doc_id, source, lang, tokenizer_version, n_tokens) with built-in functions."""
    return docs.select("doc_id", "source", "lang", F.lit(version).alias("tokenizer_version"), word_count(F.col("text")).alias("n_tokens"))


def count_bpe(docs: DataFrame, ranks_path: str, pattern: str, version: str) -> DataFrame:
    """The same with a byte-level BPE rank file, without a shuffle."""
    packed = docs.select(F.struct("doc_id", "source", "lang").alias("row"), "text")
    sized = encode_documents(packed, ranks_path, pattern, "row", "text")
    return sized.select("doc_id.doc_id", "doc_id.source", "doc_id.lang", F.lit(version).alias("tokenizer_version"), F.size("ids").cast("long").alias("n_tokens"))


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*CELL, F.lit(1).cast("long").alias("n_docs"), "n_tokens")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*CELL, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Counts of the same documents before and after: their difference."""
    return deletes(old).unionByName(inserts(new))


class Rollup:
    """A rollup table at ``path``, a shared folder.

    Parts that a compaction has folded stay for readers of older snapshots until
    :meth:`vacuum`, to be run when none is under way."""

    SCHEMA = "source string, lang string, tokenizer_version string, n_docs long, n_tokens long"

    def __init__(self, spark: SparkSession, path: str):
        self.table = SnapshotTable(spark, path, self.SCHEMA)

    def committed(self, batch_id: str) -> bool:
        if not re.fullmatch(r"[\w.-]+", batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        return batch_id in self.table.snapshot()["keys"]

    def commit(self, batch_id: str, deltas: DataFrame) -> bool:
        """Add a batch once; False if that id was committed before."""
        return not self.committed(batch_id) and self.table.append(self._sum(deltas), batch_id)

    def parts(self) -> int:
        """Parts that totals read."""
        return len(self.table.snapshot()["parts"])

    def compact(self) -> bool:
        """Fold all batches so far into a new base; a reader sees the old state or the new one.

        Batches may be committed meanwhile; of two compactions at once one gives way."""
        return self.table.compact(self._sum)

    def vacuum(self, keep: int = 1) -> int:
        return self.table.vacuum(keep)

    def _sum(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*CELL).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, n_docs, n_tokens over all committed batches."""
        return self._sum(self.table.read())
