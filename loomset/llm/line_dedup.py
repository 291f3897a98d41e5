"""Corpus-wide line de-duplication with DataFrame functions only.

Every line of at least ``min_chars`` code points (blanks stripped at both ends,
A-Z lower-cased) becomes a 128-bit hash. The occurrences are range-partitioned
by (hash, document block) with a secondary sort by document and position; a
window streams over each run and flags the first row of every document. A line
found in at least ``min_docs`` documents stays only in the largest document id
that holds it. Texts never travel with the hashes: what comes back is one
run-length-compressed keep bitmap per document. Lines with equal 128-bit hashes
count as equal; the lines themselves are not looked at again.

Skew: a line held by a third of all documents is split over as many document
blocks as there are shuffle partitions, both while counting and while the
decision is joined back, so no task sees a whole hot group.

Defined cases: null or empty text is one empty line; a null document id takes
no part and keeps all its lines; repeated rows of an id count as one document
and each row gets its own bitmap; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, ascii_lower, materialise


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), F.xxhash64(text).alias("_row"))


def line_occurrences(docs: DataFrame, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(h1, h2, block, doc_id, _row, pos) of each line long enough to count."""
    blocks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = (
        _base(docs, id_col, text_col)
        .where(F.col("doc_id").isNotNull())
        .select("doc_id", "_row", F.posexplode_outer(F.split("_text", "\n", -1)).alias("pos", "_line"))
        .where(F.length("_line") >= min_chars)
        .select("doc_id", "_row", "pos", F.btrim("_line", F.lit(BLANKS)).alias("_line"))
        .where(F.length("_line") >= min_chars)
        .select("doc_id", "_row", "pos", ascii_lower(F.col("_line")).alias("_key"))
    )
    return lines.select(
        F.xxhash64("_key").alias("h1"),
        F.xxhash64(F.lit(1), F.col("_key")).alias("h2"),
        F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int").alias("block"),
        "doc_id", "_row", "pos",
    )


def dropped_positions(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, _row, dropped): ascending positions of the lines each document loses."""
    occurrences = materialise(line_occurrences(docs, min_chars, id_col, text_col), "lines")
    run = ["h1", "h2", "block"]
    ordered = occurrences.repartitionByRange(*run).sortWithinPartitions(*run, F.desc("doc_id"), "_row", "pos")
    stream = Window.partitionBy(*run).orderBy(F.desc("doc_id"), "_row", "pos")
    previous = F.lag("doc_id").over(stream)
    first = F.when(previous.isNull() | (previous != F.col("doc_id")), 1).otherwise(0)
    by_block = ordered.withColumn("first", first).groupBy(*run).agg(F.sum("first").alias("n"), F.max("doc_id").alias("top"))
    by_line = by_block.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("keep_in")).where(F.col("n") >= min_docs).drop("n")
    decided = by_block.select(*run).join(by_line, ["h1", "h2"])
    return (
        occurrences.join(decided, run)
        .where(F.col("doc_id") != F.col("keep_in"))
        .groupBy("doc_id", "_row")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    )


def keep_runs(dropped: Column) -> Column:
    """Alternating run lengths, kept lines first: [kept, dropped, kept, ...]."""
    last = F.size(dropped) - 1
    starts = F.filter(dropped, lambda x, i: (i == 0) | (F.get(dropped, i - 1) != x - 1))
    ends = F.filter(dropped, lambda x, i: (i == last) | (F.get(dropped, i + 1) != x + 1))
    before = F.concat(F.array(F.lit(-1)), F.slice(ends, 1, F.size(ends) - 1))
    kept = F.zip_with(before, starts, lambda e, s: s - e - 1)
    gone = F.zip_with(starts, ends, lambda s, e: e - s + 1)
    return F.flatten(F.zip_with(kept, gone, lambda k, g: F.array(k, g)))


def keep_bitmaps(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, keep_runs [, text].

    ``keep_runs`` is the compressed bitmap over the lines: run lengths, kept and
    dropped in turn, starting with kept; lines after the last run are kept, so
    an empty array keeps everything.
    """
    found = dropped_positions(docs, min_docs, min_chars, id_col, text_col)
    base = _base(docs, id_col, text_col)
    base = base.withColumn("n_lines", F.size(F.split("_text", "\n", -1)).cast("long"))
    if not with_text:
        base = base.drop("_text")
    none = F.array().cast("array<int>")
    joined = base.join(found, ["doc_id", "_row"], "left")
    return joined.select(
        "doc_id",
        "n_lines",
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        F.when(F.col("dropped").isNull(), none).otherwise(keep_runs(F.col("dropped"))).alias("keep_runs"),
        *([F.col("_text").alias("text")] if with_text else []),
    )


def kept_text(text: Column, keep_runs: Column) -> Column:
    """The text that a keep bitmap leaves, lines joined by line feeds."""
    flags = F.flatten(F.transform(keep_runs, lambda n, i: F.array_repeat(i % 2 == 0, n)))
    lines = F.zip_with(F.split(text, "\n", -1), flags, lambda line, keep: F.when(keep.isNull() | keep, line))
    return F.when(F.size(keep_runs) == 0, text).otherwise(F.array_join(lines, "\n"))


def dedup_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """keep_bitmaps plus the kept text itself."""
    marked = keep_bitmaps(docs, min_docs, min_chars, id_col, text_col, with_text=True)
    return marked.withColumn("text", kept_text(F.col("text"), F.col("keep_runs")))
