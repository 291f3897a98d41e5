"""The operators as queries over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitpack, bpe_codec, chat_format, decontam, fim, importance, line_dedup, merkle, ngram_trie, simhash_bk, token_rollup, toxicity, warc_zst
from .common import BLANKS, LOWER, UPPER, fold, fresh_path, materialise, table

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Flagged ids that are broadcast (about 40 bytes each).
FLAGGED = 500_000


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ngram_trie.train_and_score(docs).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert all documents under two tokenizer versions, delete those of low
    quality, revise toxic ones (each sentence a line of its own), and replay the delete.

    Texts are only scanned: documents are counted before the labels are joined, so
    what is shuffled is counts. Revised texts, whole as well, are counted where the
    flagged ids can be broadcast for flagged documents only, beyond FLAGGED ids for all."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    path, version = public_tokenizers.path(RANKS), "byte_bpe_multi_50k"

    def both(rows: DataFrame) -> DataFrame:
        return token_rollup.count_words(rows).unionByName(token_rollup.count_bpe(rows, path, public_tokenizers.PATTERN, version))

    ledger = materialise(both(docs), "token_ledger")
    flagged = materialise(labels.where("toxic = 1 AND quality = 1").select("doc_id"), "flagged")
    some = docs.join(F.broadcast(flagged), "doc_id", "left_semi") if flagged.count() <= FLAGGED else docs
    # written as well, or the join below would be pushed under the word count
    revised = materialise(both(some.withColumn("text", F.regexp_replace("text", r"\. ", ".\n\n"))), "revised_ledger")
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "token_rollup"))
    gone = ledger.join(labels.where("quality = 0"), "doc_id", "left_semi")
    rollup.commit("0001-insert", token_rollup.inserts(ledger))
    rollup.commit("0002-delete", token_rollup.deletes(gone))
    rollup.commit("0003-revise", token_rollup.revisions(ledger.join(flagged, "doc_id", "left_semi"), revised.join(flagged, "doc_id", "left_semi")))
    rollup.commit("0002-delete", token_rollup.deletes(gone))
    return rollup.totals()


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    coded = bpe_codec.encode_documents(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, decode=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.write_and_index(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_bk.near_duplicates(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zst.archive_and_read(table(spark, sf_dir, "pages"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.transform(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], given.schema)
    return chat_format.read_back(chat_format.format_conversations(given.unionByName(odd)))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_lm_scoring, op2_token_counts, op3_line_dedup, op4_byte_bpe, op5_token_files,
        op6_simhash, op7_warc, op8_decontaminate, op9_merkle, op10_toxicity,
        op11_fill_in_middle, op12_chat_format, op13_importance,
    )}


_CHARS = " || ".join(f"chr({ord(c)})" for c in BLANKS)

OP3_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {_CHARS}), '{UPPER}', '{LOWER}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keep_in FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id <> r.keep_in AS gone
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS n, sha256(html) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first_id FROM d WHERE n >= 100 GROUP BY digest)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""

#: Every alignment of equal tokens, without seeds: windows of 13 with 11 equal or more,
#: and items of fewer tokens wherever they occur whole. Rows are told apart by number, as ids may repeat.
OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT row_number() OVER () AS k, item_id, w, len(w) AS n
  FROM (SELECT DISTINCT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark)),
dt AS (SELECT r, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS p FROM d),
bt AS (SELECT k, n, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS q FROM b WHERE n >= 13),
m AS (SELECT r, k, n, p - q AS diagonal, q FROM dt JOIN bt USING (token)),
around AS (
  SELECT *, count(*) OVER (PARTITION BY r, k, diagonal ORDER BY q RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c FROM m),
live AS (SELECT DISTINCT r, k, diagonal FROM around WHERE c >= 11),
windows AS (
  SELECT r, k, diagonal, unnest(generate_series(greatest(q - 12, 0), least(q, n - 13))) AS s
  FROM m JOIN live USING (r, k, diagonal)),
counted AS (SELECT r, k, diagonal, s, count(*) AS c FROM windows GROUP BY ALL),
places AS (
  SELECT d.r, b.k, b.n, d.w, b.w AS item, unnest(generate_series(0, len(d.w) - b.n)) AS p
  FROM d JOIN b ON b.n BETWEEN 1 AND 12 AND len(d.w) >= b.n),
found AS (
  SELECT r, k, c, s + diagonal AS p FROM counted WHERE c >= 11
  UNION ALL SELECT r, k, n, p FROM places WHERE w[p + 1 : p + n] = item)
SELECT doc_id, item_id, max(c)::INTEGER AS matched, min(p)::INTEGER AS first_word
FROM found JOIN d USING (r) JOIN b USING (k) GROUP BY doc_id, item_id
"""


OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
h AS (
  SELECT *, ('0x' || substr(x, 1, 8))::BIGINT % (n + 1) AS p, ('0x' || substr(x, 9, 8))::BIGINT % (n + 1) AS q,
         ('0x' || substr(x, 17, 8))::BIGINT % 100 AS rate, ('0x' || substr(x, 25, 8))::BIGINT % 100 AS spm FROM d),
f AS (
  SELECT doc_id, text, n, least(p, q) AS a, greatest(p, q) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR rate >= 90 THEN 'plain'
              WHEN spm < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
c AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
"""

#: Each control string in a content, and each in the name of another role, costs a backslash.
OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?(?:INST|ROLE)\]')) AS n,
         CASE role WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'assistant' THEN length('<s></s>')
              ELSE length('[ROLE][/ROLE]</s>') + length(role) + len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?(?:INST|ROLE)\]')) END AS marks FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + marks)::BIGINT AS formatted_chars
FROM m GROUP BY conv_id
"""

#: CRC-32 by its table of 256 remainders, for distinct words.
OP13_SQL = r"""
WITH steps AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) AS x(i)),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'UPPER', 'LOWER'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
dw AS (SELECT r, word, count(*) AS k FROM (SELECT r, unnest(w) AS word FROM d) GROUP BY ALL),
bytes AS (
  SELECT word, list_transform(range(1, length(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT) AS bytes
  FROM (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM b))),
crc AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, y: xor(c >> 8, t[1 + (xor(c, y) & 255)])), 4294967295) % 10000 AS bucket
  FROM bytes, steps),
s AS (SELECT bucket, sum(k) AS n FROM dw JOIN crc USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM b JOIN crc USING (word) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) AS s_all, (SELECT coalesce(sum(n), 0) FROM t) AS t_all),
gain AS (
  SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS g
  FROM s LEFT JOIN t USING (bucket), totals),
weighed AS (
  SELECT d.r, d.doc_id, coalesce(sum(k), 0)::BIGINT AS n_features, coalesce(floor(sum(k * g)::DOUBLE / sum(k)), 0)::BIGINT AS weight
  FROM d LEFT JOIN dw USING (r) LEFT JOIN crc USING (word) LEFT JOIN gain USING (bucket) GROUP BY d.r, d.doc_id),
scored AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM weighed),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (r)
""".replace("UPPER", UPPER).replace("LOWER", LOWER)


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_dedup": OP3_SQL, "op7_warc": OP7_SQL, "op8_decontaminate": OP8_SQL,
        "op11_fill_in_middle": OP11_SQL, "op12_chat_format": OP12_SQL, "op13_importance": OP13_SQL,
    }
