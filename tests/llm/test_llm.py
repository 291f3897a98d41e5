import base64
import hashlib
import io
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomset.llm import bitpack, bpe_codec, decontam, line_dedup, merkle, ngram_trie, queries, simhash_bk, token_rollup, toxicity, warc_zst
from loomset.llm.common import fresh_path, split_words, text_chunks, word_hashes

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h1 string, pos string"
LONG = "a rather long line that has more than forty characters in it"


def frame(spark, rows, schema=SCHEMA):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y") for i, t in rows], schema)


EDGE = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, LONG), (4, LONG), (5, "  " + LONG.upper() + "\t"), (6, LONG + "\n" + LONG + "\nend"), (7, LONG), (8, LONG), (9, "é " * 30000)]


# ------------------------------------------------------------------------- words
@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aBé \n\t. ", max_size=12), max_size=8))
def test_word_hashes(texts):
    h, counts = word_hashes(pa.array(texts, pa.string()))
    words = [w for t in texts for w in t.encode().lower().split()]
    assert counts.tolist() == [len(t.encode().split()) for t in texts]
    seen = {}
    for w, x in zip(words, h.tolist(), strict=True):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text("aBé \n\t.", max_size=30), max_size=6), st.integers(1, 12), st.booleans())
def test_chunks_and_words(texts, limit, letters):
    whole, opened, closed = [b""] * len(texts), [0] * len(texts), [0] * len(texts)
    words = [[] for _ in texts]
    for first, offsets, data, opens, closes in text_chunks(pa.array(texts, pa.string()), limit):
        index, forms, counts = split_words(offsets, data, letters)
        assert len(data) <= limit or len(offsets) == 2 and len(data.tobytes().split()) <= 1
        found = iter(np.array(forms, object)[index] if len(index) else [])
        for k in range(len(offsets) - 1):
            whole[first + k] += data[offsets[k] : offsets[k + 1]].tobytes()
            words[first + k] += [next(found) for _ in range(counts[k])]
        opened[first] += opens
        closed[first + len(counts) - 1] += closes
    assert whole == [t.encode() for t in texts]
    clean = [t.encode().lower().replace(b".", b" ") if letters else t.encode().lower() for t in texts]
    assert words == [t.split() for t in clean]


# -------------------------------------------------------------------- op1, the LM
@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**63), min_size=1, max_size=300, unique=True), st.integers(0, 2**63))
def test_elias_fano(values, probe):
    v = np.sort(np.array(values, np.uint64))
    ef = ngram_trie.EliasFano.build(v)
    assert (ef.access(np.arange(len(v))) == v).all()
    x = np.append(v, np.uint64(probe))
    want = [int(np.searchsorted(v, y)) if y in set(values) else -1 for y in x.tolist()]
    assert ef.find(x).tolist() == want


def brute_lm(texts, learn):
    """p(c | a, b) of the documented model by plain counting, N and V."""
    uni, two, three, kinds2, kinds3, n2, n3 = (defaultdict(int) for _ in range(7))
    for t in (t for t, use in zip(texts, learn) if use):
        s = [None, None, *(t or "").encode().lower().split(), b"\n"]
        for a, b, c in zip(s, s[1:], s[2:]):
            uni[c] += 1
            kinds2[b] += (b, c) not in two
            kinds3[a, b] += (a, b, c) not in three
            two[b, c] += 1
            three[a, b, c] += 1
            n2[b] += 1
            n3[a, b] += 1
    n, v = sum(uni.values()), len(uni)
    d = ngram_trie.D

    def prob(a, b, c):
        p = (uni.get(c, 0) + 1) / (n + v + 1)
        if b in n2:
            p = max(two.get((b, c), 0) - d, 0) / n2[b] + d * kinds2[b] / n2[b] * p
        if (a, b) in n3:
            p = max(three.get((a, b, c), 0) - d, 0) / n3[a, b] + d * kinds3[a, b] / n3[a, b] * p
        return p

    return prob, uni, n, v


def thue_morse(n, a, b):
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans(a + b, b + a))
    return word


@pytest.mark.parametrize("settings", [{}, {"HOT_SHARE": 20, "SALTS": 3}, {"TASK_TOKENS": 40, "SHARD_TOKENS": 30, "HOT_SHARE": 10}, {"SCORE_BYTES": 40}])
def test_lm_against_brute_force(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(ngram_trie, name, value)
    rng = np.random.default_rng(2)
    left, right = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")  # alike for many polynomial hashes
    texts = ["a b a b c", "a b d", "", None, "B A b", "new words here", " \t ", f"{left} {right} {left}", right, "click click " * 60 + "x"] * 3
    texts += [" ".join(f"w{int(k)}" for k in rng.zipf(1.6, 60) if k < 500) for _ in range(30)]
    docs = frame(spark, [*enumerate(texts), (None, "a b unseen")])
    rows = ngram_trie.train_and_score(docs).collect()
    assert len(rows) == len(texts) + 1
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    out = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    prob, uni, n, v = brute_lm([*texts, "a b unseen"], [*(not x for x in out), True])
    for i, t in enumerate(texts):
        w = [*(t or "").encode().lower().split(), b"\n"]
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(w), sum(uni.get(x, 0) > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(np.log10((uni.get(x, 0) + 1) / (n + v + 1)) for x in w))
        assert r.score == pytest.approx(sum(np.log10(prob(a, b, c)) for a, b, c in zip([None, None, *w], [None, *w], w)), abs=1e-3 * len(w))
    for a, b in ((None, None), (None, b"a"), (b"a", b"b"), (b"click", b"click"), (b"zz", b"b")):
        assert sum(prob(a, b, x) for x in [*[x for x in uni if uni[x]], b"unknown"]) == pytest.approx(1)


def test_lm_edges(spark):
    docs = frame(spark, EDGE)
    assert ngram_trie.train_and_score(docs.where("false")).count() == 0
    assert ngram_trie.train_and_score(docs).count() == len(EDGE)
    none = ngram_trie.train(docs.where("false"))
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in ngram_trie.score(docs, none).collect()} == {(0, 0, 0.0, 0.0)}
    assert len(set(ngram_trie.digests([b"a", b"b", b"A"])[0].tolist())) == 3


def test_lm_words_that_share_half_a_hash(spark, monkeypatch, tmp_path):
    plain = ngram_trie.digests
    monkeypatch.setattr(ngram_trie, "digests", lambda forms: (plain(forms)[0] & np.uint64(7 << 61), plain(forms)[1]))
    forms = [b"w%d" % i for i in range(200)]
    high, low = ngram_trie.digests(forms)
    at = tmp_path / "part-00000-x-c000.txt"
    at.write_bytes(ngram_trie.word_level(0, [np.frombuffer(ngram_trie._pack(high, low, np.arange(200) + 1), np.uint8)]) + ngram_trie.MAGIC)
    words = ngram_trie.Words({0: str(at)}, 1, {0: (200, 20100)})
    ids = words.ids(forms)
    assert sorted(ids.tolist()) == list(range(200)) and words.counts(ids).tolist() == list(range(1, 201))
    assert set(words.ids([b"other%d" % i for i in range(50)]).tolist()) == {-1}


def test_ids_beyond_their_limit_are_an_error(spark, monkeypatch):
    docs = frame(spark, [(1, "a b c"), (2, "d e")])  # five words and the end, two more marks and the unknown
    for most, fits in ((10, True), (9, False)):
        monkeypatch.setattr(ngram_trie, "MOST_IDS", most)
        if fits:
            assert ngram_trie.train(docs) is not None
            continue
        with pytest.raises(OverflowError, match="31 bits"):
            ngram_trie.train(docs)
    pair = np.array([(1 << 31) - 1], np.int64) << 32 | ((1 << 31) - 1)  # the greatest pair of ids stays positive
    assert pair[0] > 0 and pair[0] >> 32 == (1 << 31) - 1


# ---------------------------------------------------------------- op2, the rollup
def test_rollup(spark):
    docs = frame(spark, [(1, "a b"), (2, None), (3, "c")])
    counts = token_rollup.count_words(docs)
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "r"))
    assert rollup.totals().count() == 0
    assert rollup.commit("b1", token_rollup.inserts(counts)) and not rollup.commit("b1", token_rollup.inserts(counts))
    gone = counts.where("doc_id = 3")
    rollup.commit("b2", token_rollup.deletes(gone))
    rollup.commit("b3", token_rollup.revisions(counts.where("doc_id = 1"), token_rollup.count_words(frame(spark, [(1, "a b c d")]))))
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "words-1", 2, 4)]
    with pytest.raises(ValueError):
        rollup.commit("../x", token_rollup.inserts(counts))


@pytest.mark.parametrize("flagged", [500_000, 0])
def test_op2_by_either_plan(spark, monkeypatch, flagged):
    monkeypatch.setattr(queries, "FLAGGED", flagged)
    test_op2_against_brute_force(spark)


def test_op2_against_brute_force(spark):
    enc = bpe_codec.Codec(bpe_codec.load_ranks(public_tokenizers.path(queries.RANKS)), public_tokenizers.PATTERN)
    docs = duckdb.sql(f"SELECT d.doc_id, text, source, lang, quality, toxic FROM '{SF}/documents.parquet' d LEFT JOIN '{SF}/labels.parquet' l ON d.doc_id = l.doc_id").fetchall()
    want = defaultdict(lambda: [0, 0])
    for _, text, source, lang, quality, toxic in docs:
        text = text.replace(". ", ".\n\n") if toxic == 1 and quality == 1 else text
        for version, n in (("words-1", len(text.encode().split())), ("byte_bpe_multi_50k", len(enc.encode(text)))):
            cell = want[source, lang, version]
            cell[0] += quality != 0
            cell[1] += n * (quality != 0)
    got = {tuple(r)[:3]: list(r)[3:] for r in queries.op2_token_counts(spark, SF).collect()}
    assert got == dict(want)


def test_op2_edges(spark):
    path = public_tokenizers.path(queries.RANKS)
    rows = [(1, "a b", None, None), (1, "a b", None, None), (None, None, "s", "en"), (3, "", "s", None), (4, "w " * 50_000, "s", "en")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, source string, lang string, n_tokens string")
    counts = token_rollup.count_words(docs).unionByName(token_rollup.count_bpe(docs, path, public_tokenizers.PATTERN, "bpe"))
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "r"))
    rollup.commit("b1", token_rollup.inserts(counts))
    got = {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()}
    assert got[None, None, "words-1"] == (2, 4) and got["s", "en", "words-1"] == (2, 50_000) and got["s", None, "words-1"] == (1, 0)
    assert got["s", None, "bpe"] == (1, 0) and got["s", "en", "bpe"][1] >= 50_000
    rollup.commit("b2", token_rollup.inserts(counts.where("false")))
    assert {tuple(r)[:3]: tuple(r)[3:] for r in rollup.totals().collect()} == got
    rollup.commit("b3", token_rollup.deletes(counts))
    assert {tuple(r)[3:] for r in rollup.totals().collect()} == {(0, 0)}


def test_rollup_compaction_keeps_totals_and_idempotence(spark):
    counts = token_rollup.count_words(frame(spark, [(1, "a b"), (2, None), (3, "c")]))
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "r"))
    for k in range(4):
        rollup.commit(f"b{k}", token_rollup.inserts(counts))
    before = rollup.totals().collect()
    rollup.compact()
    rollup.compact()
    assert rollup.totals().collect() == before and rollup.parts() == 1
    assert not rollup.commit("b2", token_rollup.inserts(counts)) and rollup.totals().collect() == before
    assert rollup.commit("b9", token_rollup.deletes(counts)) and rollup.parts() == 2
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "words-1", 9, 9)]
    rollup.compact()
    assert [tuple(r) for r in rollup.totals().collect()] == [("s", "en", "words-1", 9, 9)]


def test_rollup_readers_see_one_state_beside_compaction(spark):
    counts = token_rollup.count_words(frame(spark, [(1, "a b"), (2, None), (3, "c")]))
    rollup = token_rollup.Rollup(spark, fresh_path(spark, "r"))
    for k in range(3):
        rollup.commit(f"b{k}", token_rollup.inserts(counts))
    held = rollup.totals()  # not read yet
    seen, fold = [], rollup._sum

    def interleaved(rows):  # while the base is being made: a reader, and a second writer of the same and another id
        seen.append([tuple(r)[3:] for r in rollup.totals().collect()])
        other = token_rollup.Rollup(spark, rollup.table.path)
        assert not other.commit("b1", token_rollup.inserts(counts)) and other.commit("b7", token_rollup.deletes(counts))
        return fold(rows)

    assert rollup.table.compact(interleaved) and seen == [[(9, 9)]]
    assert [tuple(r)[3:] for r in held.collect()] == [(9, 9)] and [tuple(r)[3:] for r in rollup.totals().collect()] == [(6, 6)]
    assert rollup.parts() == 2 and rollup.committed("b0") and rollup.committed("b7") and not rollup.commit("b7", token_rollup.inserts(counts))
    assert rollup.compact() and not rollup.compact() and rollup.vacuum() > 0
    assert [tuple(r)[3:] for r in rollup.totals().collect()] == [(6, 6)]


# ------------------------------------------------------------- op3, 7, 8: the SQL
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.queries()[name](spark, SF)
    order = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(order)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.select(*order).collect()))) == sorted(map(str, want))


def test_line_dedup_edges(spark):
    got = {(r.doc_id, r.n_dropped): (r.text, r.keep_runs, r.n_lines) for r in line_dedup.dedup_lines(frame(spark, EDGE)).collect()}
    assert got[8, 0] == (LONG, [], 1) and got[None, 0][0] == LONG and got[2, 0] == ("", [], 1) and got[1, 0][0] == ""
    assert got[6, 2] == ("end", [0, 2], 3) and got[4, 1] == ("", [0, 1], 1) and got[5, 1][0] == ""
    assert line_dedup.keep_bitmaps(frame(spark, EDGE).where("false")).count() == 0
    assert line_dedup.keep_bitmaps(frame(spark, EDGE)).count() == len(EDGE)


def test_decontamination_edges(spark):
    item = [f"w{i}" for i in range(20)]
    two, three = list(item[:13]), list(item[:13])
    two[3] = two[9] = "x"
    three[2] = three[6] = three[10] = "x"
    docs = [(1, " ".join(["pre", *two, "post"])), (2, " ".join(three)), (3, "Zz, ".join(item).replace("Zz", "")), (4, None), (None, " ".join(item)), (5, "")]
    bench = spark.createDataFrame([(0, " ".join(item)), (1, "too short"), (2, None)], "item_id long, text string")
    got = {r.doc_id: (r.item_id, r.matched, r.first_word) for r in decontam.find_contamination(frame(spark, docs), bench).collect()}
    assert got == {1: (0, 11, 1), 3: (0, 13, 0), None: (0, 13, 0)}
    assert decontam.find_contamination(frame(spark, docs), bench.where("false")).count() == 0


@pytest.mark.parametrize("block,filter_block", [(50_000, 2_000_000), (3, 2_000_000), (3, 7)])
def test_decontamination_of_repetitive_texts_by_any_plan(spark, monkeypatch, block, filter_block):
    monkeypatch.setattr(decontam, "BLOCK_SEEDS", block)
    monkeypatch.setattr(decontam, "FILTER_SEEDS", filter_block)
    rng = np.random.default_rng(8)
    item = [f"w{i}" for i in range(30)]
    near = [w if i % 7 else "x" for i, w in enumerate(item)]
    docs = [(1, "click " * 400), (2, " ".join(near)), (2, " ".join(item)), (None, "a " + " ".join(item[5:19])), (4, " ".join(rng.choice(item, 200))), (5, ""), (6, None), (7, "pre " * 20_000 + " ".join(item))]
    bench = spark.createDataFrame([(0, " ".join(item), "a"), (1, "click " * 60, "b"), (1, "click " * 60, "b"), (3, " ".join(item[10:24]), "c")], "item_id long, text string, words string")
    got = {(r.doc_id, r.item_id): (r.matched, r.first_word) for r in decontam.find_contamination(frame(spark, docs), bench).collect()}
    want = {}
    for i, text in docs:
        w = (text or "").split()
        for k, b in ((0, item), (1, ["click"] * 60), (3, item[10:24])):
            for shift in range(-len(b), len(w)) if len(w) < 3000 else range(len(w) - 40, len(w)):
                same = [0 <= shift + q < len(w) and w[shift + q] == b[q] for q in range(len(b))]
                for s in range(len(b) - 12):
                    c = sum(same[s : s + 13])
                    if c >= 11:
                        most, first = want.get((i, k), (0, 1 << 40))
                        want[i, k] = max(most, c), min(first, s + shift)
    assert got == want


def test_decontamination_sql_with_short_and_repeated_items(spark):
    rng = np.random.default_rng(12)
    item = [f"w{i}" for i in range(25)]
    docs = [(1, " ".join(item)), (1, "x " + " ".join(item[:14])), (2, "too short, and too short"), (None, "a Too-short " + " ".join(item)), (3, None), (4, ""), (5, " ".join(rng.choice(item, 90)))]
    bench = [(0, " ".join(item)), (0, " ".join(item)), (0, "too short"), (7, "too short"), (8, None), (9, " ".join(item[3:15]))]
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": [x for _, x in docs]}))
    con.register("benchmark", pa.table({"item_id": [i for i, _ in bench], "text": [x for _, x in bench]}))
    want = con.execute(queries.OP8_SQL).fetchall()
    got = decontam.find_contamination(frame(spark, docs), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want)) and len(want) >= 7


def test_decontamination_by_short_items(spark):
    twelve = " ".join(f"t{i}" for i in range(12))
    docs = [(1, "so Too, SHORT it is: too short"), (2, "short too"), (3, "x " + twelve), (4, twelve.replace("t7", "u")), (5, "too"), (None, "too short"), (6, None), (7, "世界")]
    bench = spark.createDataFrame([(1, "too short"), (2, None), (3, twelve), (4, "..."), (5, "世界"), (6, "Too-short!")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.first_word) for r in decontam.find_contamination(frame(spark, docs), bench).collect()}
    assert got == {(1, 1): (2, 1), (1, 6): (2, 1), (None, 1): (2, 0), (None, 6): (2, 0), (3, 3): (12, 1), (7, 5): (1, 0)}


def test_warc_edges(spark):
    body = "x" * 100
    rows = [(1, "u", body), (2, None, body), (3, "u\nv", None), (4, "u", "é"), (5, "u", "é"), (None, "u", body), (1, "w", body)]
    path = fresh_path(spark, "w")
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    warc_zst.write_archives(pages, path)
    got = warc_zst.read_archives(spark, path, True).collect()
    assert len(got) == len(rows) and sum(r.record_type == "response" and r.page_id == 1 for r in got) == 1
    assert {(r.page_id, r.refers_to) for r in got if r.record_type == "revisit"} == {(2, 1), (1, 1)}
    assert all(r.payload_digest == hashlib.sha256((h or "").encode()).hexdigest() for r in got for i, u, h in rows if i == r.page_id and i != 1)
    out = warc_zst.BundleWriter()
    for i in range(3000):
        out.add(str(i), warc_zst.record(str(i), "u", b"p%d" % i * 50, "d", 1, None))
    data = out.finish() + warc_zst.FOOTER_MAGIC
    bundle = warc_zst.Bundle(data)
    assert len(bundle.starts) > 2 and bundle.get("2500")[1] == b"p2500" * 50
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole.count(b"WARC/1.1") == 3000


def test_warc_identifiers_and_random_access(spark):
    body = "y" * 200
    rows = [(1, "u", body), (1, "u", body), (1, "v", body), (None, "u", body), (None, "u", body), (2, "u", "small"), (2, "u", "small"), (3, "é", "<p>" + "z" * 300_000)]
    pages = spark.createDataFrame([(*r, 5, "q") for r in rows], "page_id long, url string, html string, row int, nth string")
    path = fresh_path(spark, "w2")
    warc_zst.write_archives(pages, path)
    got = warc_zst.read_archives(spark, path, True).collect()
    assert len(got) == len(rows) == len({r.record_id for r in got})
    same = [r for r in got if r.page_id == 1]
    assert sorted(r.record_type for r in same) == ["response", "revisit", "revisit"] and {r.refers_to for r in same if r.record_type == "revisit"} == {1}
    assert all(r.record_type == "response" for r in got if r.page_id != 1)
    index = warc_zst.record_index(spark, path)
    assert index.count() == len(rows)
    for r in got:
        (found,) = warc_zst.fetch_records(index.where(F.col("record_id") == r.record_id)).collect()
        assert found == r
    for uri in {r.uri for r in index.collect()}:
        bundle = warc_zst.Bundle(warc_zst.map_blob(uri))
        assert [h["WARC-Record-ID"] for h, _ in bundle.scan()] == [h["WARC-Record-ID"] for h, _ in bundle.records()]
    warc_zst.write_archives(pages.where("false"), fresh_path(spark, "w3"))
    assert warc_zst.archive_and_read(pages.where("false")).count() == 0


# ----------------------------------------------------------------- op4, op5: ids
def test_bpe(spark):
    ranks = bpe_codec.load_ranks(public_tokenizers.path(queries.RANKS))
    codec, small = bpe_codec.Codec(ranks, public_tokenizers.PATTERN), bpe_codec.Codec(ranks, public_tokenizers.PATTERN, 10)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for t in [*texts[:60], "x's 12ab  \n\n  y!!'s", "   ", "a" * 300]:
        assert codec.encode(t) == small.encode(t) == codec.encoding.encode_ordinary(t)
        assert codec.decode(codec.encode(t)) == t.encode()
    blank = "a" + " " * 1_000_000 + "b\n"
    assert codec.decode(codec.encode(blank)).decode() == blank
    assert isinstance(codec.encoding, tiktoken.Encoding)
    got = bpe_codec.encode_documents(frame(spark, EDGE), public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN, decode=True).collect()
    assert sorted(bytes(r.decoded) for r in got) == sorted((t or "").encode() for _, t in EDGE)
    again = bpe_codec.decode_documents(spark.createDataFrame([(r.doc_id, r.ids) for r in got] + [(77, None)], "doc_id long, ids array<int>"), public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)
    assert sorted(bytes(r.decoded) for r in again.collect()) == sorted([*((t or "").encode() for _, t in EDGE), b""])


def test_op4_query_against_the_library(spark):
    with open(public_tokenizers.path(queries.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = dict(duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'").fetchall())
    got = queries.op4_byte_bpe(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = plain.encode_ordinary(docs[r.doc_id])
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(docs[r.doc_id].encode()).hexdigest())
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want
    assert bpe_codec.encode_documents(frame(spark, EDGE).where("false"), public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN, decode=True).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.data())
def test_bit_packing(width, data):
    ids = np.array(data.draw(st.lists(st.integers(0, 2**width - 1), max_size=200)), np.uint32)
    packed = bitpack.pack(ids, width)
    assert len(packed) == -(-len(ids) * width // 8) and (bitpack.unpack(packed, width, 0, len(ids)) == ids).all()
    a = data.draw(st.integers(0, len(ids)))
    assert (bitpack.unpack(packed, width, a, len(ids) - a) == ids[a:]).all()


def test_token_files(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    rows = [*EDGE, (11, "Erst. <|endoftext|> It's 10.5 x"), (10, "don't. É. x!! 'll... a b")]
    at = fresh_path(spark, "t")
    bitpack.write_tokens(frame(spark, rows), path, at, shard_ids=20)
    ids = {(r.doc_id, tuple(r.ids)) for r in bitpack.read_tokens(spark, at, True).collect()}
    assert ids == {(i, (*tok.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in rows}
    got = bitpack.token_index(spark, at).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got]])[:-1].tolist()
    assert all(r.ids_crc32 in {zlib.crc32(np.array(x, "<u4").tobytes()) for j, x in ids if j == r.doc_id} for r in got)


def memo_ids(memo, texts):
    out = [[] for _ in texts]
    for first, sizes, ids in memo.encode(pa.array(texts, pa.string()), 1):
        for k, part in enumerate(np.split(ids, np.cumsum(sizes)[:-1])):
            out[first + k] += part.tolist()
    return out


def test_token_memo_against_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    left, right = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    texts = [f"{left} {right}", right, left, None, "", " x", "a<|startoftext|>B.<|endoftext|>", "0 0a 10.5.", "x%$ é... 's! a-b- don't.'' É&, ñ'. ñ.' x\u0301. <=\u0338 word<=>", "é! É?! \u0301 a\u0301", left * 40, "w, " * 3000]
    with open(path, "rb") as f:
        spec = f.read()
    for limit in (3, 1000):  # a memo of three words forgets all the time
        memo = bitpack.WordMemo(spec, limit)
        assert memo_ids(memo, texts * 2) == [[*tok.encode(t or "", add_special_tokens=False).ids, 1] for t in texts * 2]


def test_a_very_long_text_in_bounded_memory():
    import tracemalloc

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as f:
        memo = bitpack.WordMemo(f.read())
    text = pa.array(["some words, again and again. " * (30_000_000 // 29)])
    tracemalloc.start()
    try:
        n = sum(len(ids) for _, _, ids in memo.encode(text, 1))
        hashes = sum(1 for _ in text_chunks(text))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 7 * (30_000_000 // 29) + 1 and hashes > 10 and most < 150 << 20


def test_op5_query_against_the_library(spark):
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    got = sorted(queries.op5_token_files(spark, SF).collect(), key=lambda r: r.doc_id)
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    for r, (i, text) in zip(got, docs, strict=True):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert bitpack.write_and_index(frame(spark, EDGE).where("false"), public_tokenizers.path("word_bpe_49k.json")).count() == 0


# -------------------------------------------------------------- op6, op9, op10
def test_simhash_against_brute_force(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    base = " ".join(rng.choice(words, 400))
    near = [" ".join("zz" if rng.random() < 0.004 else w for w in base.split()) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*near, base, base, "", None, *(" ".join(rng.choice(words, 40)) for _ in range(60))])] + [(None, base)]
    for shard_rows in (simhash_bk.SHARD_ROWS, 4):
        got = simhash_bk.near_duplicates(frame(spark, rows), shard_rows=shard_rows).collect()
        f = {i: simhash_bk.fingerprint(t) for i, t in rows if i is not None}
        root = {i: i for i in f}
        changed = True
        while changed:
            changed = False
            for i in f:
                for j in f:
                    if (f[i] ^ f[j]).bit_count() <= 3 and root[i] != root[j]:
                        root[i] = root[j] = min(root[i], root[j])
                        changed = True
        assert {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == set(root.items())
        assert all(int(r.fingerprint, 16) == f[r.doc_id] for r in got if r.doc_id is not None) and len(got) == len(rows)


def test_op6_fingerprints_and_components_by_plain_python(spark, monkeypatch):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    want = {}
    for i, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        want[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    label = {i: i for i in want}
    while True:
        new = {i: min(label[j] for j in want if (want[i] ^ want[j]).bit_count() <= 3) for i in want}
        if new == label:
            break
        label = new
    for tree_rows in (simhash_bk.TREE_ROWS, 20, 1):  # keys of no, few and many bits
        monkeypatch.setattr(simhash_bk, "TREE_ROWS", tree_rows)
        got = queries.op6_simhash(spark, SF).collect()
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{want[i]:016x}", label[i]) for i in want}


def test_simhash_edges(spark):
    assert simhash_bk.near_duplicates(frame(spark, EDGE).where("false")).count() == 0
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(5, long), (6, long + " end"), (7, long), (7, long), (8, None), (9, "")]
    got = sorted((r.doc_id, r.component_id) for r in simhash_bk.near_duplicates(frame(spark, rows)).collect())
    assert got == [(5, 5), (6, 5), (7, 5), (7, 5), (8, 8), (9, 8)]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_a_hot_shard_is_dealt_in_pairs_of_blocks(spark, monkeypatch, broadcast):
    monkeypatch.setattr(simhash_bk, "BROADCAST_ROWS", broadcast)
    rng = np.random.default_rng(3)
    fp = np.unique(rng.integers(0, 1 << 12, 900).astype(np.int64))  # the upper bits are alike
    df = spark.createDataFrame([(int(x), "t") for x in fp], "fp long, t string").select("fp")
    pairs = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash_bk.shard_edges(df, 1, shard_rows=60).collect()}

    def roots(links):
        root = {x: x for x in fp.tolist()}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
        return {x: top(x) for x in root}

    want = [(a, b) for a in fp.tolist() for b in (a ^ 1 << k for k in range(12)) if b in set(fp.tolist())]
    assert roots(pairs) == roots(want)


def test_trees_spare_comparisons():
    """Of the pairs of a shard of random fingerprints a search looks at a part only, and finds all links."""
    rng = np.random.default_rng(9)
    fp = np.unique(rng.integers(0, 1 << 62, 4000).astype(np.uint64))
    fp = np.unique(np.concatenate([fp, fp[:200] ^ np.uint64(5)]))
    forest = simhash_bk.Forest(fp, np.zeros(len(fp), np.int64))
    looked, found = [0], set()
    plain = np.bitwise_count

    class Counting:
        def __getattr__(self, name):
            return getattr(np, name)

        @staticmethod
        def bitwise_count(x):
            looked[0] += len(x)
            return plain(x)

    old, simhash_bk.np = simhash_bk.np, Counting()
    try:
        for q, node in forest.search(fp, np.zeros(len(fp), np.int64), 3):
            found |= {(int(a), int(b)) for a, b in zip(fp[q], fp[node]) if a != b}
    finally:
        simhash_bk.np = old
    brute = {(int(a), int(b)) for a in fp for b in fp[plain(fp ^ a) <= 3] if a != b}
    assert found == brute and len(brute) >= 400
    assert looked[0] < 0.75 * len(fp) ** 2


def test_verified_links_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(3000)]
    rows = [(i, " ".join(rng.choice(words, 200))) for i in range(40)]
    for i in range(40):  # two words of 200 changed: similar; twenty changed: not
        edited = rows[i][1].split()
        for at in rng.choice(200, 2 if i % 2 else 20, replace=False):
            edited[at] = "changed"
        rows.append((100 + i, " ".join(edited)))
    rows += [(300, None), (301, ""), (302, "one two"), (303, "one two"), (None, "one two")]
    got = {r.doc_id: r.component_id for r in simhash_bk.near_duplicates(frame(spark, rows), shingle=2, radius=6, verify_shingle=5, families=2).collect()}
    prints = {i: (simhash_bk.majority(simhash_bk._shingles(t, 2), 2), *simhash_bk.second_print(t, 5)) for i, t in rows if i is not None}

    def linked(a, b):
        (f, n, v), (g, m, w) = prints[a], prints[b]
        alike = min(n, m) >= 0.8 * max(n, m) and np.bitwise_count(v ^ w).sum() <= simhash_bk.most_bits(0.8)
        return alike and np.bitwise_count(f ^ g).min() <= 6

    label = {i: i for i in prints}
    for _ in range(3):
        for a in prints:
            for b in prints:
                if linked(a, b):
                    label[a] = label[b] = min(label[a], label[b])
    assert all(simhash_bk.fingerprint(t, 2) == int(prints[i][0][0]) for i, t in rows if i in prints)
    assert {i: c for i, c in got.items() if i is not None} == label
    assert got[None] == 302 and sum(got[100 + i] == i for i in range(1, 40, 2)) >= 18
    assert all(got[100 + i] == 100 + i for i in range(0, 40, 2))


def test_variants_of_one_fingerprint(spark):
    rng = np.random.default_rng(7)
    words = [f"w{k}" for k in range(3000)]
    rows = []
    for i in range(50):  # one word rules both fingerprints; tails differ, the second of each pair by a word
        tail = list(rng.choice(words, 40))
        rows.append((i, "click " * 300 + " ".join(tail)))
        rows.append((100 + i, "click " * 300 + " ".join([*tail[:-1], "changed"])))
    prints = {i: (simhash_bk.majority(simhash_bk._shingles(t, 2), 2), *simhash_bk.second_print(t, 5)) for i, t in rows}
    assert len({tuple(f.tolist()) for f, _, _ in prints.values()}) < 10

    def linked(a, b):
        (f, n, v), (g, m, w) = prints[a], prints[b]
        alike = min(n, m) >= 0.8 * max(n, m) and np.bitwise_count(v ^ w).sum() <= simhash_bk.most_bits(0.8)
        return alike and np.bitwise_count(f ^ g).min() <= 6

    label = {i: i for i in prints}
    for _ in range(3):
        for a in prints:
            for b in prints:
                if linked(a, b):
                    label[a] = label[b] = min(label[a], label[b])
    assert sum(label[100 + i] == i for i in range(50)) > 40
    for shard_rows in (simhash_bk.SHARD_ROWS, 7):
        got = simhash_bk.near_duplicates(frame(spark, rows), shingle=2, radius=6, verify_shingle=5, families=2, shard_rows=shard_rows).collect()
        assert {r.doc_id: r.component_id for r in got} == label


def jaccard(a, b, shingle=5):
    a, b = (set(simhash_bk._shingles(t, shingle)) for t in (a, b))
    return len(a & b) / max(1, len(a | b))


def test_lightest_forest():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n, m = int(rng.integers(2, 12)), int(rng.integers(0, 40))
        i, j, weight = rng.integers(0, n, m), rng.integers(0, n, m), rng.integers(0, 5, m)
        label = np.arange(n)
        if n > 3:
            label[3] = 1  # joined before
        got = simhash_bk.lightest(i, j, weight, label)
        root, want = label.tolist(), []
        for k in sorted(range(m), key=lambda k: (weight[k], i[k], j[k])):
            a, b = root[i[k]], root[j[k]]
            if a != b:
                want.append(k)
                root = [min(a, b) if r in (a, b) else r for r in root]
        assert sorted(weight[got]) == sorted(weight[want]) and len(got) == len(want)


@pytest.mark.parametrize("shard_rows", [simhash_bk.SHARD_ROWS, 9])
@pytest.mark.parametrize("broadcast", [simhash_bk.BROADCAST_ROWS, 0])
def test_exact_links_against_brute_force(spark, monkeypatch, shard_rows, broadcast):
    """Texts around a similarity of 0.8: those of 0.8 or more meet, others stay apart."""
    monkeypatch.setattr(simhash_bk, "BROADCAST_ROWS", broadcast)
    rng = np.random.default_rng(17)
    words = [f"w{k}" for k in range(4000)]
    rows = []
    for i in range(60):  # 0 to 11 words of 200 changed, apart: each takes five shingles along
        text = list(rng.choice(words, 200))
        rows.append((i, " ".join(text)))
        for k in range(i % 12):
            text[10 + 16 * k] = "changed"
        rows.append((100 + i, " ".join(text)))
    rows += [(300, None), (301, ""), (302, "one two"), (303, "one two"), (None, "one two"), (None, rows[9][1]), (305, "six of one"), (3, rows[6][1]), (3, "another")]
    got = simhash_bk.near_duplicates(frame(spark, rows), shingle=1, distinct=True, radius=6, verify_shingle=5, families=2, exact=True, shard_rows=shard_rows).collect()
    assert len(got) == len(rows)
    near = {r.doc_id: r.component_id for r in got if r.doc_id is not None and r.doc_id != 3}
    linked = [i for i in range(60) if i != 3 and near[100 + i] == i]
    alike = [i for i in range(60) if i != 3 and jaccard(rows[2 * i][1], rows[2 * i + 1][1]) >= 0.8]
    prints = {i: simhash_bk.majority(list(set(simhash_bk._shingles(t, 1))), 2) for i, t in rows if i is not None}
    reach = [i for i in alike if np.bitwise_count(prints[i] ^ prints[100 + i]).min() <= 6]
    assert linked == reach and len(linked) >= 15 and len(alike) < 40
    assert near[301] == 300 and near[303] == 302 and near[305] == 305
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["302", "4"]
    with pytest.raises(ValueError):
        simhash_bk.near_duplicates(frame(spark, rows), exact=True)


def test_exact_links_of_a_large_group(spark):
    """Edits of one text, most pairs close to the similarity: no false link, few lost."""
    rng = np.random.default_rng(19)
    words = [f"w{k}" for k in range(4000)]
    base = list(rng.choice(words, 300))
    rows = []
    for i in range(400):
        text = list(base)
        for at in rng.choice(300, int(rng.integers(0, 8)), replace=False):
            text[at] = f"e{i}x{at}"
        rows.append((i, " ".join(text)))
    rows += [(400 + i, " ".join([*base[:200], *rng.choice(words, 100)])) for i in range(30)]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if label[a] != label[b] and jaccard(rows[a][1], rows[b][1]) >= 0.8:
                label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
    got = {r.doc_id: r.component_id for r in simhash_bk.near_duplicates(frame(spark, rows), shingle=1, distinct=True, radius=6, verify_shingle=5, families=2, exact=True).collect()}
    assert all(label[i] == label[c] for i, c in got.items())
    large = max(label.count(x) for x in set(label))
    assert large < 390 and max(list(got.values()).count(c) for c in got.values()) >= 0.95 * large


@pytest.mark.parametrize("forests", [0, 1, simhash_bk.FORESTS])
def test_pairs_that_forests_leave_out_are_compared(spark, forests):
    """However few pairs the shards propose, every pair in reach of 0.8 or more is a link."""
    rng = np.random.default_rng(23)
    words = [f"w{k}" for k in range(4000)]
    rows = []
    for g in range(3):
        base = list(rng.choice(words, 300))
        for i in range(90):
            text = list(base)
            for at in rng.choice(300, int(rng.integers(2, 9)), replace=False):
                text[at] = f"e{g}x{i}x{at}"
            rows.append((100 * g + i, " ".join(text)))
    prints = [simhash_bk.majority(list(set(simhash_bk._shingles(t, 1))), 2) for _, t in rows]
    second = [simhash_bk.second_print(t, 5)[1] for _, t in rows]
    sets = [set(simhash_bk._shingles(t, 5)) for _, t in rows]
    label = [i for i, _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if np.bitwise_count(prints[a] ^ prints[b]).min() <= 6 and np.bitwise_count(second[a] ^ second[b]).sum() <= simhash_bk.most_bits(0.8, simhash_bk.DOUBT):
                both = len(sets[a] & sets[b])
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) and label[a] != label[b]:
                    label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
    got = {r.doc_id: r.component_id for r in simhash_bk.near_duplicates(frame(spark, rows), shingle=1, distinct=True, radius=6, verify_shingle=5, families=2, exact=True, forests=forests).collect()}
    assert got == {i: c for (i, _), c in zip(rows, label)} and 20 < len(set(label)) < 250


def test_merkle(spark):
    docs = frame(spark, EDGE)
    got = sorted(merkle.compare_with_next(docs).collect(), key=lambda r: (r.doc_id or -1, r.fingerprint))
    order = sorted(EDGE, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    assert len(got) == len(EDGE)
    want = []
    for (i, t), (_, f) in zip(order, [*order[1:], order[0]]):
        want.append((i, hashlib.sha256(merkle.edited_text(t or "", f or "").encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.edited_sha256)) for r in got)
    text = "one two. three, four\n\nfive six; seven.\n" * 20
    a, b = merkle.Tree(text), merkle.Tree(text.replace("five", "5", 1))
    assert merkle.likeness(a, merkle.Tree(text)) == 1 and 0.9 < merkle.likeness(a, b) < 1 and len(merkle.differing(a, b)) >= 1
    assert merkle.likeness(merkle.Tree(""), merkle.Tree(None)) == 1 and merkle.likeness(a, merkle.Tree("")) == 0
    assert merkle.compare_with_next(docs.where("doc_id = 4")).first().near_next == 1
    assert merkle.compare_with_next(docs.where("false")).count() == 0


def spans_of(text):
    """Spans by the documented rule, a character at a time."""
    raw, out, start, m = text + "\n", [], 0, (1 << 64) - 1
    for i, c in enumerate(raw):
        h = sum(int(k) * ord(raw[i - back]) for back, k in enumerate(merkle._WINDOW) if i >= back) & m
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & m
        h = (h ^ h >> 27) * 0x94D049BB133111EB & m
        if ((h ^ h >> 31) >> 32) % merkle.SPAN == 0 or c == "\n":
            while i + 1 - start > merkle.LONGEST:
                out.append(raw[start : start + merkle.LONGEST])
                start += merkle.LONGEST
            out.append(raw[start : i + 1])
            start = i + 1
    return out


def brute_likeness(x, y):
    """Matched text over all text by nested multisets of strings, without hashes or ranges."""

    def paragraphs(text):
        out, held = [], []
        for s in spans_of(text) if text else []:
            held.append(s)
            if s.endswith("\n"):
                out.append(tuple(held))
                held = []
        return out

    def sections(text):
        out, held = [], []
        for p in paragraphs(text):
            held.append(p)
            node = merkle._node([merkle.xxhash.xxh3_128_digest(s.encode("utf-32-le")) for s in p])
            if p == ("\n",) or node[0] & 7 == 0:
                out.append(tuple(held))
                held = []
        return [*out, *([tuple(held)] if held else [])]

    size = lambda branch: len(branch) if isinstance(branch, str) else sum(map(size, branch))
    a, b = Counter(sections(x)), Counter(sections(y))
    total, common = len(x) + bool(x) + len(y) + bool(y), 0
    for level in range(3):
        both = a & b
        common += sum(size(k) * n for k, n in both.items())
        if level < 2:
            a, b = (Counter(child for k, n in (side - both).items() for child in k for _ in range(n)) for side in (a, b))
    return 2 * common / total if total else 1.0


@settings(max_examples=60, deadline=None)
@given(st.text("ab.\n é世", max_size=60), st.integers(0, 60), st.text("ab\n世", max_size=5))
def test_merkle_likeness_against_brute_force(text, at, put):
    x = text * 4
    y = x[:at] + put + x[at:]
    a, b = merkle.Tree(x), merkle.Tree(y)
    assert (a.root == b.root) == (x == y)
    assert merkle.likeness(a, b) == pytest.approx(1.0 if x == y else brute_likeness(x, y))
    assert merkle.likeness(a, b) == pytest.approx(merkle.likeness(b, a))
    assert bool(merkle.differing(a, b) or merkle.differing(b, a)) == (x != y)


def test_merkle_edits_are_located():
    rng = np.random.default_rng(4)
    cjk = "".join(map(chr, rng.integers(0x4E00, 0x9000, 20_000)))
    a, b = merkle.Tree(cjk), merkle.Tree(cjk[:9000] + "x" + cjk[9001:])
    assert 0.99 < merkle.likeness(a, b) < 1
    ((i, j),) = merkle.differing(a, b)
    assert a.at[i] <= 9000 < a.at[j] and a.at[j] - a.at[i] < 400
    parts = [" ".join(rng.choice(list("abcdefgh"), 50)) + "\n\n" for _ in range(6)]
    a, b = merkle.Tree("".join(parts)), merkle.Tree("".join([parts[0], parts[4], *parts[2:4], parts[1], parts[5]]))
    assert a.root != b.root and merkle.differing(a, b) and merkle.differing(b, a) and merkle.likeness(a, b) > 0.9
    inserted = merkle.Tree("".join([*parts[:3], "new text here\n", *parts[3:]]))
    assert merkle.differing(inserted, a)
    assert max(np.diff(merkle.Tree("a" * 5000).at)) <= merkle.LONGEST
    half = merkle.Tree("".join(parts)[:300] + "z" * 300)
    assert merkle.likeness(a, half) > 0.2


def test_fingerprint_table(spark):
    got = sorted(merkle.fingerprint_documents(frame(spark, EDGE)).collect(), key=str)
    want = sorted(((i, merkle.Tree(t)) for i, t in EDGE), key=lambda x: str(x[0]))
    assert sorted((str(r.doc_id), r.fingerprint, r.n_leaves) for r in got) == sorted((str(i), t.root, len(t.leaves)) for i, t in want)
    assert all(merkle._node([bytes.fromhex(s) for s in r.sections]).hex() == r.fingerprint for r in got)


def test_op9_query_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    got = {r.doc_id: r for r in queries.op9_merkle(spark, SF).collect()}
    assert len(got) == len(docs)
    for k, (i, text) in enumerate(docs):
        after, r = docs[(k + 1) % len(docs)][1], got[i]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (merkle.Tree(text).root, merkle.Tree(edited).root)
        if k < 40:
            assert (r.near_edited, r.near_next) == (pytest.approx(brute_likeness(text, edited)), pytest.approx(brute_likeness(text, after)))
    assert sum(r.near_edited for r in got.values()) / len(got) > 0.4 > 0.2 > sum(r.near_next for r in got.values()) / len(got)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op10_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    # 2 labels in 100 are noise: toxic ones without any toxic word can't be found
    found = [r.toxic for r in got if r.predicted]
    assert len(found) > 90 and sum(found) / len(found) > 0.9
    docs = frame(spark, EDGE)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, none)).collect()} == {0.5}


def test_features_of_cut_texts(monkeypatch):
    texts = pa.array(["a b c, d-e A", None, "", "é x " * 50, "b"])
    whole = toxicity.features(texts)
    monkeypatch.setattr(toxicity, "text_chunks", lambda t: text_chunks(t, 7))
    assert (toxicity.features(texts) == whole).all() and (np.diff(whole) > 0).all()
    words = [["a", "b", "c", "d", "e", "a"], [], [], ["é", "x"] * 50, ["b"]]
    kinds = [len({*w, *zip(w, w[1:]), *((x, y, 0) for x, y in zip(w, w[2:]))}) for w in words]
    assert np.bincount(whole >> toxicity.BITS, minlength=5).tolist() == kinds


def plain_ftrl(rows, epochs, alpha, beta, l1):
    """FTRL-proximal as published, a coordinate at a time."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= (0 if i == "bias" else l1):
            return 0.0
        return -(z[i] - np.sign(z[i]) * (0 if i == "bias" else l1)) / ((beta + n[i] ** 0.5) / alpha)

    for _ in range(epochs):
        for index, label in rows:
            w = {i: weight(i) for i in [*index.tolist(), "bias"]}
            g = 1 / (1 + np.exp(-sum(w.values()))) - label
            for i, x in w.items():
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha * x
                n[i] += g * g
    return {i: weight(i) for i in list(z)}


def test_ftrl_against_the_plain_form():
    rng = np.random.default_rng(6)
    rows = [(np.unique(rng.integers(0, 60, 12)), int(k)) for k in rng.integers(0, 2, 80)]
    index, weight, bias = toxicity.ftrl(rows, bits=6, epochs=3, alpha=0.5, beta=1.0, l1=0.4)
    want = plain_ftrl(rows, 3, 0.5, 1.0, 0.4)
    assert bias == pytest.approx(want.pop("bias"))
    assert dict(zip(index.tolist(), weight.tolist())) == pytest.approx({i: w for i, w in want.items() if w})


def test_toxicity_edges(spark):
    texts = {1: "bad awful words", 2: "fine day", 4: "bad awful again", 5: "a fine calm day", 7: "awful bad", 8: "nice day"}
    rows = [*texts.items(), (1, "bad awful words"), (1, "other row of one"), (None, "bad awful"), (90, None), (91, ""), (92, "bad " * 40_000)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i in (1, 4, 7)), "x") for i in texts] + [(1, 0, "x"), (None, 1, "x"), (2, None, "x")], "doc_id long, toxic int, text string")
    model = toxicity.train(docs, labels, held_out=9)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (90, 91)}) == 1
    assert toxicity.score(docs.where("false"), model).count() == 0
    assert toxicity.train(docs.where("false"), labels)[0].size == 0
    # a bound on features leaves whole documents out
    few = toxicity.train(docs, labels, held_out=9, most=4)
    assert few[0].size == 0 or few[0].size <= 4
    # a score right at the threshold counts
    assert spark.createDataFrame([(toxicity.THRESHOLD,)], "score double").select((F.col("score") >= toxicity.THRESHOLD).cast("int").alias("p")).first().p == 1


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for name, stage in pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        docs = pipeline.materialise(docs, "t")
        sizes.append(docs.count())
        if name != "byte-level bpe":
            assert docs.columns == pipeline.COLUMNS
    assert sizes[0] == sizes[1] >= sizes[2] >= sizes[3] == sizes[4] > 100
    codec = bpe_codec.Codec(bpe_codec.load_ranks(public_tokenizers.path(queries.RANKS)), public_tokenizers.PATTERN)
    texts = {r.doc_id: r.text for r in before.collect()}
    assert all(codec.decode(r.ids).decode() == texts[r.doc_id] and r.n_tokens == len(r.ids) for r in docs.collect())
    assert before.select(F.max("n_chars")).first() is not None


def test_pipeline_rows_without_id_and_repeated_ids(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = np.random.default_rng(3)
    a, b, c, d = (" ".join(rng.choice([f"w{k}" for k in range(3000)], 200)) for _ in range(4))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(5, a), (7, a), (7, b), (None, a), (None, c), (None, c), (8, d), (8, d), (9, item), (9, b + " own"), (None, item + " end")]
    docs = frame(spark, rows)
    got = pipeline.one_of_near_copies(spark, docs, SF).collect()
    firsts = sorted((str(r.doc_id), r.text) for r in got if not r.text.startswith((b, item)))
    assert firsts == sorted([("5", a), ("8", d), ("8", d), ("None", c)])
    got = pipeline.drop_contaminated(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, t in rows if not t.startswith(item))


# ------------------------------------------------------------------- the pipeline, by hand
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(folder):
    """Tables with every case the stages decide on; returns the documents' rows."""
    rng = np.random.default_rng(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    draw = lambda n: " ".join(rng.choice(vocabulary, n))
    item, other = draw(40), draw(30)
    repeated = "  This LINE of more than forty characters stands in many documents."
    texts = [draw(150) for _ in range(30)]
    texts += [" ".join("changed" if k == 70 else w for k, w in enumerate(t.split())) for t in texts[:8]]  # near copies
    texts += [texts[9], texts[9], texts[10]]  # exact copies
    texts += [draw(60) + "\n" + repeated + "\n" + draw(40) for _ in range(7)]
    texts += [draw(50) + " " + item + " " + draw(50), item, draw(80) + " " + " ".join("x" if k in (4, 9) else w for k, w in enumerate(other.split()[:13])) + " end"]
    texts += ["awful horrid " + draw(30) for _ in range(30)] + [draw(30) for _ in range(30)]
    texts += ["click " * 200 + draw(30), "", None, "   ", draw(8_000), "one two", "One two", "one two three"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[0]), (None, draw(50)), (None, rows[-9][1]), (3, texts[3]), (3, draw(70)), (None, None)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
    toxic = [i for i, t, *_ in rows if t and t.startswith("awful")]
    labels = [(i, 1, int(i in toxic)) for i, *_ in rows if i is not None and i >= 50]

    def put(name, rows, columns, kinds):
        table = pa.table({c: pa.array(x, k) for c, x, k in zip(columns, zip(*rows), kinds)})
        pq.write_table(table, f"{folder}/{name}.parquet")

    put("documents", rows, ["doc_id", "text", "lang", "source", "n_chars"], [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()])
    put("labels", labels, ["doc_id", "quality", "toxic"], [pa.int64(), pa.int32(), pa.int32()])
    put("benchmark", [(1, item), (2, other), (3, None)], ["item_id", "text"], [pa.int64(), pa.string()])
    return rows, [item, other]


def plain_pipeline(rows, items, scores, threshold):
    """The five stages over (doc_id, text, ...) rows in plain Python."""
    rows = [r for r, s in zip(rows, scores) if s < threshold]
    key = lambda line: line.strip(" \t\n\x0b\f\r").lower()
    holders = defaultdict(set)
    for i, t, *_ in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                holders[key(line)].add(i)
    gone = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    cut = lambda i, t: t if i is None or t is None else "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i)
    rows = [(i, cut(i, t), *rest) for i, t, *rest in rows]
    prints = [(simhash_bk.majority(list(set(simhash_bk._shingles(t, 1))), 2), *simhash_bk.second_print(t, 5)) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            (f, n, v), (g, m, w) = prints[a], prints[b]
            alike = min(n, m) >= 0.8 * max(n, m) and np.bitwise_count(v ^ w).sum() <= simhash_bk.most_bits(0.8, simhash_bk.DOUBT)
            if alike and np.bitwise_count(f ^ g).min() <= 6 and (rows[a][1] == rows[b][1] or n == m == 0 or jaccard(rows[a][1], rows[b][1]) >= 0.8):
                root[top(a)] = top(b)
    groups = defaultdict(list)
    for k in range(len(rows)):
        groups[top(k)].append(k)
    kept = []
    for group in groups.values():
        named = [rows[k][0] for k in group if rows[k][0] is not None]
        kept += [k for k in group if rows[k][0] == min(named)] if named else group[:1]
    rows = [rows[k] for k in kept]

    def leaks(text):
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        for b in (x.split() for x in items):
            for shift in range(-len(b), len(words)):
                same = [0 <= shift + q < len(words) and words[shift + q] == b[q] for q in range(len(b))]
                if any(sum(same[s : s + 13]) >= 11 for s in range(len(b) - 12)):
                    return True
        return False

    return [r for r in rows if not leaks(r[1])]


def test_pipeline_against_plain_python(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows, items = fixture(tmp_path)
    sf, docs = str(tmp_path), spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    table = np.zeros(1 << toxicity.BITS)
    table[model[0]] = model[1]
    scores = []
    for _, text, *_ in rows:
        found = toxicity.features(pa.array([text], pa.string())) & ((1 << toxicity.BITS) - 1)
        scores.append(1 / (1 + np.exp(-model[2] - table[found].sum())))
    kept = plain_pipeline(rows, items, scores, toxicity.THRESHOLD)
    with open(public_tokenizers.path(queries.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((str(i), plain.encode_ordinary(t or "")) for i, t, *_ in kept)
    got = pipeline.run(spark, sf).collect()
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    # each kind of decision was taken
    ids = [r.doc_id for r in got]
    assert 40 < len(got) < len(rows) - 30 and not any(i in ids for i in range(30, 38)) and sum(s >= toxicity.THRESHOLD for s in scores) >= 25


def test_pipeline_stage_edges(spark, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows, an empty table and extra columns, stage by stage."""
    pipeline = pytest.importorskip("corpus_pipeline")
    fixture(tmp_path)
    rows = [(i, t, "en" if i != 2 else None, None if i == 3 else "s", len(t or "")) for i, t in EDGE]
    rows += [(None, None, None, None, None), (5, EDGE[6][1], "de", "s", 1), (10, "long " * 40_000, "en", "s", 200_000)]
    extra = ", _row long, row string, dropped string, score double, fp long, ids string"
    docs = spark.createDataFrame([(*r, 1, "x", "y", 0.5, 2, "z") for r in rows], DOCS + extra)
    sizes = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
        assert out.columns == (pipeline.COLUMNS if name != "byte-level bpe" else ["doc_id", "lang", "source", "n_tokens", "ids"])
        sizes.append(out.count())
        assert "cases" in stage.__doc__
    n = len(rows)
    assert sizes[0] == sizes[1] == sizes[3] == sizes[4] == n and sizes[2] < n
    lines = {(r.doc_id, r.text) for r in pipeline.drop_repeated_lines(spark, docs, str(tmp_path)).collect()}
    assert {(8, LONG), (4, ""), (1, None), (2, ""), (None, LONG)} <= lines
    near = [(r.doc_id, r.text) for r in pipeline.one_of_near_copies(spark, docs, str(tmp_path)).collect()]
    # empty texts are one group, of the smallest id; both rows of an id that stays, stay
    assert (1, None) in near and (2, "") not in near and (None, None) not in near and near.count((3, "a b")) == 2


def test_rows_of_one_id_are_split_between_tasks(spark):
    """Half of the rows have no id: the range partitioning spreads them, and every row comes back."""
    rows = [(None if k % 2 else k, f"text {k * 7919 % 1000} of many") for k in range(2000)]
    docs = frame(spark, rows).repartition(3)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = fresh_path(spark, "split")
        bitpack.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), path)
        read = bitpack.read_tokens(spark, path).withColumn("part", F.regexp_extract("shard", r"part-(\d+)", 1))
        assert read.count() == len(rows) and read.where("doc_id IS NULL").select("part").distinct().count() > 1
        got = merkle.compare_with_next(docs)
        assert got.count() == len(rows) and got.where("doc_id IS NULL").count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_op10_by_plain_features_and_ftrl(spark):
    """The query's scores by features of plain Python and the plain steps of FTRL."""
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    labels = dict(duckdb.sql(f"SELECT doc_id, max(toxic) FROM '{SF}/labels.parquet' GROUP BY 1").fetchall())

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        x = (x ^ x >> 27) * 0x94D049BB133111EB % (1 << 64)
        return x ^ x >> 31

    def plain(text):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
        h = [xxhash.xxh3_64_intdigest(w) for w in words]
        every = set(h)
        for gap, salt in ((1, 0x51ED270B), (2, 0x2545F491)):
            every |= {mixed((a * 0x9E3779B97F4A7C15 + b + salt) % (1 << 64)) for a, b in zip(h, h[gap:])}
        return sorted({x >> 64 - toxicity.BITS for x in every})

    found = {i: plain(t) for i, t in texts.items()}
    fold = {i: zlib.crc32(str(i).encode()) % 3 for i in texts}
    order = [r[0] for r in spark.createDataFrame([(i,) for i in labels if i in texts and fold[i] != 1], "doc_id long").orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    z, n, bias, bias_z, bias_n = defaultdict(float), defaultdict(float), 0.0, 0.0, 0.0
    alpha, beta, l1 = toxicity.ALPHA, toxicity.BETA, toxicity.L1
    weight = lambda k: 0.0 if abs(z[k]) <= l1 else -(z[k] - (l1 if z[k] > 0 else -l1)) / ((beta + n[k] ** 0.5) / alpha)
    for _ in range(toxicity.EPOCHS):
        for i in order:
            w = {k: weight(k) for k in found[i]}
            g = 1 / (1 + math.exp(-min(max(sum(w.values()) + bias, -35.0), 35.0))) - labels[i]
            for k in found[i]:
                z[k] += g - ((n[k] + g * g) ** 0.5 - n[k] ** 0.5) / alpha * w[k]
                n[k] += g * g
            bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / alpha * bias
            bias_n += g * g
            bias = -bias_z / ((beta + bias_n**0.5) / alpha)
    got = {r.doc_id: r for r in queries.op10_toxicity(spark, SF).collect()}
    assert set(got) == set(texts)
    for i, r in got.items():
        want = 1 / (1 + math.exp(-(sum(weight(k) for k in found[i]) + bias)))
        assert abs(r.score - want) < 1e-6 and r.held_out == (fold[i] == 1) and r.predicted == int(r.score >= 0.7), i
