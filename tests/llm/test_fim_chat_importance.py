import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomset.llm import chat_format, fim, importance, queries
from loomset.llm.common import text_buffer

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n long, form string, h1 string, rank string, score string"
TURNS = "conv_id long, turn long, role string, text string, part string, whole string"
LONG = "É lan, ça va? " * 40_000  # over half a megabyte
EDGE = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (3, "other"), (None, "né " * 30), (4, LONG), (5, "has <S> inside"), (6, "<P>"), (7, "日本語 🙂🙂"), (8, "x" * 300_000)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, "f", "h", "r", "s") for i, t in rows], DOCS)


# ---------------------------------------------------------------------- op11, the middle
def units(text, unit):
    if unit == "char":
        return list(text)
    return re.findall(r"^[ \t\n\v\f\r]+|[^ \t\n\v\f\r]+[ \t\n\v\f\r]*", text) if unit == "word" else text.splitlines(keepends=True)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aé日🙂 \n", max_size=25), max_size=6), st.sampled_from(["char", "word", "line"]), st.integers(1, 9), st.integers(1, 20))
def test_counts_and_cuts(texts, unit, chunk, block):
    offsets, data = text_buffer(pa.array(texts, pa.string()))
    found = fim.Decomposition(offsets, data, unit, chunk, block)
    pieces = [units(t, unit) for t in texts]
    assert found.n_units.tolist() == [len(p) for p in pieces]
    for i, p in enumerate(pieces):
        for rank in range(len(p) + 1):
            before = found.rescanned
            at = found.cuts(np.array([i]), np.array([rank]))[0]
            assert data[offsets[i] : at].tobytes().decode() == "".join(p[:rank])
            assert found.rescanned - before == (rank < len(p))  # the owning chunk alone


def fim_by_hand(doc_id, text):
    text = text or ""
    x = sha("1:" + ("" if doc_id is None else str(doc_id)))
    h1, h2, h3, h4 = (int(x[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    psm = h4 % 100 >= 20
    made = f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}" if psm else f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return doc_id, n, "psm" if psm else "spm", a, b - a, sha(made), sha(text)


def test_op11_edges(spark, tmp_path):
    rows = EDGE + [(k, f"text {k} with <{k}> é" * (k % 7)) for k in range(100, 300)]
    docs_of(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_fill_in_middle(spark, str(tmp_path)).collect()]
    want = [fim_by_hand(*r) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[2] for r in want} == {"plain", "psm", "spm"}
    docs_of(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.op11_fill_in_middle(spark, f"{tmp_path}/none").count() == 0


def test_fim_words_lines_and_other_sentinels(spark):
    texts = [(k, f"one two\n three {k}\nfour\n" * (k % 5 + 1)) for k in range(60)]
    for unit in ("word", "line"):
        marks = ("[pre]", "[suf]", "[mid]")
        made = fim.transform(docs_of(spark, texts), rate=100, spm=50, unit=unit, sentinels=marks, chunk=8)
        rows = made.withColumn("back", fim.restored(made.output, made.form, marks)).collect()
        assert {r.form for r in rows} == {"psm", "spm"}
        for r in rows:
            text = dict(texts)[r.doc_id]
            assert r.back == text and r.n == len(units(text, unit))
            p = units(text, unit)
            low, mid = "".join(p[: r.prefix_units]), "".join(p[r.prefix_units : r.prefix_units + r.middle_units])
            assert r.output.endswith(f"[mid]{mid}" if r.form == "psm" else f"[pre]{low}[mid]{mid}")


def test_fim_rates_bound_the_forms(spark):
    docs = docs_of(spark, [(k, "some text") for k in range(50)])
    assert {r.form for r in fim.transform(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in fim.transform(docs, rate=100, spm=100).collect()} == {"spm"}
    assert {r.form for r in fim.transform(docs, rate=100, spm=0).collect()} == {"psm"}


# ------------------------------------------------------------------------ op12, the chat
ODD = st.text(alphabet=st.sampled_from(list("<>[]/\\sINTROLE é\n")), max_size=30) | st.sampled_from(["</s>", "<\\s>", "[INST] ok [/INST]", "[\\\\ROLE]", "<", "[", "\\", "<</s>", "[[INST]"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "</s>", "[ROLE]x"]), ODD), max_size=8))
def test_template_round_trip(turns):
    t = chat_format.LLAMA_LIKE
    roles, texts = pa.array([r for r, _ in turns], pa.string()), pa.array([x for _, x in turns], pa.string())
    escaped = t.escape(texts).to_pylist()
    assert [t.unescape(x) for x in escaped] == [x for _, x in turns]
    assert not any(c in x for x in escaped for c in t.controls)
    out, ends, opened, closed, after = chat_format.assemble(roles, texts, t)
    whole = out.tobytes().decode()
    assert [(r, t.unescape(whole[a:b])) for r, a, b in t.turns(whole)] == turns
    assert [whole[a:b] for a, b in zip(opened, closed)] == escaped
    assert [len(out[:e].tobytes().decode()) for e in ends] == after.tolist()


def test_a_template_that_cannot_be_parsed_is_refused():
    for bad in ({"user": ("<u", "u<>")}, {"user": ("u", "</u>")}, {"user": ("<u>", " ")}, {"a": ("<u>", "</u>"), "b": ("<u>", "</v>")}, {"user": ("<\\u>", "</u>")}):
        with pytest.raises(ValueError):
            chat_format.Template(roles=bad)
    with pytest.raises(ValueError):
        list(chat_format.LLAMA_LIKE.turns("no mark"))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=9), max_size=12), st.integers(1, 12), st.randoms())
def test_scatter(pieces, block, rnd):
    order = list(range(len(pieces)))
    rnd.shuffle(order)
    place, at = [0] * len(pieces), 0
    for i in order:
        place[i], at = at, at + len(pieces[i])
    out = np.zeros(at, np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    chat_format.scatter(out, np.frombuffer(b"".join(pieces), np.uint8), bounds, np.array(place, np.int64), block)
    assert out.tobytes() == b"".join(pieces[i] for i in order)


def chat_by_hand(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        learned = "".join(t[3] for t in turns if t[2] == "assistant")
        out[conv] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(learned), sha(learned))
    return out


CHAT = [
    (1, 0, "user", None), (1, 1, "assistant", "</s> [INST]"), (1, 1, "assistant", "</s> [INST]"), (1, 1, "user", "tie"), (2, 0, None, "x"), (2, None, "system", ""),
    (None, 0, "user", "no id"), (None, 1, "assistant", "é🙂" * 50_000), (3, 0, "assistant", ""), (4, 5, "tool [ROLE]", "<\\s>"), (4, 2, "assistant", "last first"),
]


def test_op12_edges(spark, tmp_path):
    rows = CHAT + [(9, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 40)) for k in range(4000)] + [(k, t, ("user", "assistant")[t], f"q{k}") for k in range(20, 400) for t in (0, 1)]
    random.Random(5).shuffle(rows)
    spark.createDataFrame([(*r, "p", "w") for r in rows], TURNS).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_chat_format(spark, str(tmp_path)).collect()
    said = "</s>[INST] ok [/INST]"
    want = chat_by_hand(rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])
    assert {r.conv_id: tuple(r)[1:5] for r in got} == want and len(got) == len(want)
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/none/conversations.parquet")
    only = queries.op12_chat_format(spark, f"{tmp_path}/none").collect()
    assert [r.conv_id for r in only] == [-7]


def test_long_conversations_come_in_parts(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"{k} [INST] é" * 5) for k in range(500)] + [(2, 0, "user", "hi"), (3, 0, "assistant", "yes")]
    parts = chat_format.format_conversations(spark.createDataFrame([(*r, "p", "w") for r in rows], TURNS), part_bytes=700).cache()
    mine = sorted((r for r in parts.collect() if r.conv_id == 1), key=lambda r: (r.partition, r.part))
    assert len(mine) > 20 and not any(r.whole for r in mine) and sum(r.n_turns for r in mine) == 500
    t = chat_format.LLAMA_LIKE
    assert [(x, t.unescape(r.formatted[a:b])) for r in mine for x, a, b in t.turns(r.formatted)] == [(r[2], r[3]) for r in rows[:500]]
    assert "".join(t.unescape(r.formatted[s.start : s.stop]) for r in mine for s in r.loss_spans) == "".join(r[3] for r in rows[:500] if r[2] == "assistant")
    found = {r.conv_id: tuple(r)[1:5] for r in chat_format.read_back(parts).collect()}
    assert found == chat_by_hand(rows)


def test_turns_of_one_conversation_are_split_between_tasks(spark):
    rows = spark.range(20_000).selectExpr("7L AS conv_id", "id AS turn", "'user' AS role", "repeat('word ', 20) AS text")
    parts = chat_format.format_conversations(rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r[1] for r in parts.groupBy("partition").sum("n_turns").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 10_000 and sum(sizes) == 20_000


# ----------------------------------------------------------------- op13, the resampling
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return words, [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB1é.- \n", max_size=40), max_size=5), st.integers(1, 4), st.integers(1, 15))
def test_runs_across_chunks(texts, n, limit):
    got, words = [Counter() for _ in texts], [0] * len(texts)
    for first, size, text, bucket, own in importance.text_runs(pa.array(texts, pa.string()), n, 997, limit):
        for t, b in zip(text.tolist(), bucket.tolist()):
            got[first + t][b] += 1
        for k in range(size):
            words[first + k] += int(own[k])
    for t, found, w in zip(texts, got, words):
        mine, features = runs(t, n)
        assert w == len(mine) and found == Counter(zlib.crc32(f.encode()) % 997 for f in features)


def resampled_by_hand(docs, target, n, buckets, percent, least):
    s, t = ([0] * buckets, [0] * buckets)
    for rows, into in ((docs, s), (target, t)):
        for _, text in rows:
            for f in runs(text, n)[1]:
                into[zlib.crc32(f.encode()) % buckets] += 1
    ss, tt = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (ss + buckets) / ((a + 1) * (tt + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, text in docs:
        words, f = runs(text, n)
        weight = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(sha(f"2024:{'' if i is None else i}")[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for k, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def test_op13_edges(spark, tmp_path):
    rnd = random.Random(3)
    some = [(k, " ".join(rnd.choice("alpha Beta gamma délta 7 x.y".split()) for _ in range(rnd.randrange(60)))) for k in range(300)]
    rows, bench = EDGE + some + some[:20], [(1, "gamma délta gamma"), (2, None), (3, "")]
    docs_of(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in queries.op13_importance(spark, str(tmp_path)).collect()]
    want = resampled_by_hand(rows, bench, 1, 10_000, 10, 20)
    assert sorted(got, key=str) == sorted(want, key=str)
    again = importance.resample(docs_of(spark, rows), spark.createDataFrame(bench, "item_id long, text string"), 35, n=3, buckets=500, least_words=5, limit=100)
    got = [tuple(r) for r in again.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(got, key=str) == sorted(resampled_by_hand(rows, bench, 3, 500, 35, 5), key=str)
    docs_of(spark, []).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert queries.op13_importance(spark, f"{tmp_path}/none").count() == 0


def test_ties_of_scores_go_to_the_smaller_id(spark):
    rows = [(k, 30, 30, 5, 100) for k in (9, 4, 7, 1)] + [(None, 30, 30, 5, 100), (3, 30, 30, 5, 99), (2, 1, 1, 5, 1000)]
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = {r.doc_id: r["rank"] for r in importance.ranked(scored, 5, 20).collect()}
    assert got == {1: 1, 4: 2, 7: 3, 9: 4, None: 5, 3: None, 2: None}


@pytest.mark.parametrize("name, tables", [("op11_fill_in_middle", ["documents"]), ("op12_chat_format", ["conversations"]), ("op13_importance", ["documents", "benchmark"])])
def test_new_queries_against_their_sql(spark, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(c[0] for c in want.description)
    names = [c[0] for c in want.description]
    assert sorted(map(str, (tuple(r) for r in got.select(names).collect()))) == sorted(map(str, want.fetchall()))
