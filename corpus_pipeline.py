"""A training-corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept
and returns the columns of documents (the last one: the encoded documents).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomset.llm import bpe_codec, decontam, line_dedup, simhash_bk, toxicity
from loomset.llm.common import materialise, table

#: Bits in which edited copies may differ; the five-word sets decide.
NEAR_BITS = 6
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _row(docs: DataFrame) -> DataFrame:
    """Documents with a mark that tells repeated rows of one id apart."""
    return docs.select(*COLUMNS, F.xxhash64(F.coalesce("text", F.lit(""))).alias("_row"))


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at its threshold or higher go.

    Defined cases: null and empty texts get the model's bias as their score; a score
    right at the threshold goes; rows without id and repeated rows are judged one by
    one; an empty table stays empty; columns beyond those of documents are dropped."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct(*COLUMNS).alias("row"), "text")
    scored = toxicity.score(packed, model, "row", "text")
    return scored.where(F.col("score") < toxicity.THRESHOLD).select("doc_id.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines found in five documents or more stay in one; every document stays.

    Defined cases: null texts stay null, empty ones empty; rows without id take no part
    and keep their lines; repeated rows of an id are one document, each losing its
    lines; of a tie the largest id keeps the line; an empty table stays empty; columns
    beyond those of documents are dropped."""
    found = line_dedup.dropped_positions(docs)
    joined = _row(docs).join(found, ["doc_id", "_row"], "left")
    runs = F.when(F.col("dropped").isNull(), F.array().cast("array<int>")).otherwise(line_dedup.keep_runs(F.col("dropped")))
    kept = joined.withColumn("_runs", runs).withColumn("text", line_dedup.kept_text(F.col("text"), F.col("_runs")))
    changed = F.when(F.col("dropped").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return kept.withColumn("n_chars", changed.cast("long")).select(*COLUMNS)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Marked documents but for the rows (doc_id, _row) of ``gone``; null is an id here."""
    gone = gone.select(F.col("doc_id").alias("_gone"), F.col("_row").alias("_gone_row"))
    same = F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.col("_row") == F.col("_gone_row"))
    return docs.join(gone, same, "left_anti")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the rows of the smallest id stay; other rows of
    an id that are in no such group aren't touched. Rows without id go if one with
    an id is in the group; of a group without any, one row stays. Links: fingerprints
    of the distinct words, of two hash families, within NEAR_BITS bits, whose sets of
    five-word shingles have a similarity of 0.8 or more.

    Defined cases: null and empty texts are copies of each other; repeated rows of the
    id that stays all stay; an empty table stays empty; columns beyond those of
    documents are dropped."""
    rows = _row(docs)
    # null ids come last
    mark = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_row")
    packed = rows.select(mark.alias("row"), "text")
    classes = simhash_bk.near_duplicates(packed, shingle=1, distinct=True, radius=NEAR_BITS, id_col="row", verify_shingle=5, families=2, exact=True)
    mine, least = F.col("doc_id"), F.col("component_id")
    stays = F.when(least["nameless"], mine["_row"] == least["_row"]).otherwise(mine["doc_id"].eqNullSafe(least["doc_id"]))
    kept = _without(rows, classes.where(~stays).select("doc_id.*").distinct())
    nameless = kept.where(F.col("doc_id").isNull()).dropDuplicates(["_row"])
    return kept.where(F.col("doc_id").isNotNull()).unionByName(nameless).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark passage go, those without id too; other rows of
    their ids stay.

    Defined cases: null and empty texts hold no passage; 11 of 13 equal words are a
    passage, 10 aren't; repeated rows go or stay together; an empty table stays empty;
    columns beyond those of documents are dropped."""
    rows = _row(docs)
    packed = rows.select(F.struct("doc_id", "_row").alias("row"), "text")
    found = decontam.find_contamination(packed, table(spark, sf_dir, "benchmark"), id_col="row")
    return _without(rows, materialise(found.select("doc_id.*").distinct(), "contaminated")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and the token ids of every document.

    Defined cases: null and empty texts have no ids; rows without id and repeated rows
    are encoded one by one; an empty table stays empty."""
    packed = docs.select(F.struct("doc_id", "lang", "source").alias("row"), "text")
    coded = bpe_codec.encode_documents(packed, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, "row", "text")
    return coded.select("doc_id.*", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", one_of_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level bpe", encode),
]

#: A trained model, fingerprints and a tokenizer: not SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
