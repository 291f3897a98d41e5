import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomset.functions import tags, values
from loomset.operators import archive, audit, delta, geometry, jsonops, project, reconcile, shards
from loomset.plans.filters import ColumnBinding, FilterSpec, TagRule


def column(spark, rows, make, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize("dialect,term,text,hit", [
    ("word", "saber_(fate)", "x saber_(fate) y", False), ("token", "saber_(fate)", "x saber_(fate) y", True),
    ("word", "cat", "cat_ears", False), ("word", "cat", "cat-girl", True), ("token", "cat", "cat-girl", False),
    ("token", "CAT", "a cat", True), ("token", "cat*", "cat-girl", True), ("token", "*girl", "cat-girl", True),
    ("token", "*t-g*", "cat-girl", True), ("token", "a*b", "x a*b", True), ("token", "jpeg artifacts", "jpeg artifacts", True),
    ("token", "écat", "x écat", True), ("word", "cat", "écat", False), ("token", "*", "anything", True),
])
def test_patterns(spark, dialect, term, text, hit):
    assert column(spark, [text], lambda c: tags.any_of(c, [term], dialect)) == [hit]


def test_empty_exclude_term_is_an_error():
    with pytest.raises(ValueError):
        tags.none_of(F.lit("x"), ["**"])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab_(*) ", max_size=6), min_size=1, max_size=4), st.text("ab_() ", max_size=8))
def test_pattern_model(terms, text):
    for term in terms:
        body = term.strip("*").lower()
        parts = re.split(r"\s", text)
        if " " not in body and body:
            want = {(0, 0): body in parts, (1, 1): body in text, (0, 1): any(p.startswith(body) for p in parts), (1, 0): any(p.endswith(body) for p in parts)}[term.startswith("*"), term.endswith("*")]
            assert bool(re.search(tags.pattern(term).replace(r"\z", r"\Z"), text)) == want


def test_numbers_and_names(spark):
    texts = ["12.7", " 12 ", "abc", "NaN", "1e3", None]
    assert column(spark, texts, values.lenient_int) == [12, 12, 0, 0, 1000, 0]
    assert column(spark, ["5", "12.7", None], lambda c: values.strict_int(c, -1)) == [5, None, -1]
    assert column(spark, ["a.PNG", "a.png?x=1", "h/.gif", None, "x.webp"], values.extension) == [".png", ".jpg", ".jpg", ".jpg", ".webp"]
    assert column(spark, ["a/B.jpg ", "", None, "a/b/"], values.base_name) == ["b.jpg", "", "", "b"]
    assert column(spark, ["a/12.x.jpg", "b.jpg"], values.id_from_key) == [12, None]
    assert column(spark, ["a/12.jpg", "p_12345_9.jpg", "x.jpg"], values.id_from_name) == [12, 12345, None]
    assert column(spark, [0, 4999, 5000, -1], lambda c: values.shard_name(c, 5000), "bigint") == ["shard_00000", "shard_00000", "shard_00001", "shard_-0001"]
    assert column(spark, [" S", "nsfw", None], values.rating4) == ["safe", "unknown", "unknown"]
    assert column(spark, ["General", "nsfw", "Odd ", None], values.rating3) == ["safe", "explicit", "odd", ""]
    assert column(spark, ["b, a  B", None], lambda c: tags.sorted_tokens(tags.token_set(c))) == ["a b", ""]
    with pytest.raises(ValueError):
        values.rating_words(["odd"])


def test_lists_and_doubles(spark):
    assert tags.parse_list("a, b  c") == ["a", "b", "c"] and tags.parse_list(None) == [] and tags.parse_list(["x y"]) == ["x y"]
    assert column(spark, [12.0, 640.9, None, float("nan")], lambda c: values.strict_int(c, -1), "double") == [12, 640, -1, None]
    assert column(spark, [2**53 + 1, -1], lambda c: values.shard_name(c, 1), "bigint") == [f"shard_{2**53 + 1}", "shard_-0001"]
    df = spark.createDataFrame([(1, "u.mp4"), (2, "u.zip"), (3, "u.png"), (4, None)], "id long, url string")
    assert sorted(r.id for r in FilterSpec().apply(df).collect()) == [3, 4]
    assert FilterSpec(exclude_video=False).apply(df).count() == 4


def test_validity_order_and_required_columns(spark):
    df = spark.createDataFrame([(None, 1, 1, None, "denied", None), (2000, 70, 70, None, None, "SyntaxError"), (2000, 7, 70, None, None, "SyntaxError"), (2000, None, None, "decompression_bomb", None, None)], "s long, w int, h int, e string, st string, d string")
    reason = audit.invalid_reason(F.col("s"), F.col("w"), F.col("h"), F.col("e"), stat_error=F.col("st"), damage=F.col("d"))
    assert [r.r for r in df.select(reason.alias("r")).collect()] == ["stat_error_denied", "invalid_image_SyntaxError", "dimensions_7x70", "decompression_bomb"]
    with pytest.raises(ValueError, match="score"):
        ColumnBinding("s", score="nowhere").canonical(df, required=("id", "score"))
    assert column(spark, ["\u00a0 a,\t b \n", None, ",,"], tags.clean_spaces) == ["a b", "", ""]


def test_ranks_with_outliers_and_ties(spark):
    ids = [5, 5, -(2**60), 2**60, *range(100, 160)]
    ranked = shards.global_rank(spark.createDataFrame([(i,) for i in ids], "id long"), "id").collect()
    assert sorted(r["rank"] for r in ranked) == list(range(len(ids)))
    assert [r.id for r in sorted(ranked, key=lambda r: r["rank"])] == sorted(ids)


def test_filter_spec(spark):
    rows = [(1, "cat dog", 5, "s", 10, 10, "a.GIF"), (2, None, None, "E", 10, 20, None), (3, "dog", 9, "q", 5, 5, "b.gif")]
    df = spark.createDataFrame(rows, "id long, tag_string string, score long, rating string, image_width long, image_height long, file_url string")
    c = ColumnBinding().canonical(df)
    ids = lambda **k: sorted(r.id for r in FilterSpec(**k).apply(c).collect())
    assert ids() == [1, 2, 3]
    assert ids(min_score=0) == [1, 2, 3] and ids(min_score=6) == [3]
    assert ids(exclude_gif=True) == [1, 2] and ids(exclude_gif=True, keep_null_url=False) == [1]
    assert ids(square=True, min_square=6) == [1] and ids(min_height=11) == [2] and ids(max_width=9) == [3]
    assert ids(tags=TagRule(("dog",), exclude=("cat",))) == [3] and ids(ratings=("explicit",)) == [2]
    with pytest.raises(ValueError):
        FilterSpec(artist=TagRule(("x",))).apply(c)


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 4000), st.integers(1, 4000))
def test_crop_model(w, h):
    side, long = min(w, h), max(w, h)
    step = max(1, int(side * (1 - 0.18)))
    n = 1 if long < side * 1.3 else max(1, -(-(long - side) // step))
    assert n >= 1 and (long < side * 1.3 or (n - 1) * step < long - side or n == 1)


def test_crops(spark):
    df = spark.createDataFrame([(1, 2000, 1024), (2, 1100, 1024), (3, 100, 300)], "id int, w int, h int")
    got = sorted((r.id, r.crop, r.x, r.y, r.side) for r in geometry.explode_crops(df).collect())
    assert got == [(1, 1, 0, 0, 1024), (1, 2, 839, 0, 1024), (2, 1, 38, 0, 1024), (3, 1, 0, 0, 100), (3, 2, 0, 82, 100), (3, 3, 0, 164, 100)]
    edge = geometry.explode_crops(df.where("id = 1"), cover_edge=True).collect()
    assert max(r.x for r in edge) == 976


def test_shards_by_count(spark):
    ids = spark.createDataFrame([(i,) for i in (5, 1, 9, 7, 3)], "id long")
    known = spark.createDataFrame([(9, 0)], "id long, shard long")
    got = {r.id: r.shard for r in shards.by_count(ids, known, 2, 0, 3).collect()}
    assert got == {9: 0, 1: 1, 3: 1, 5: 2, 7: 2}
    again = spark.createDataFrame(list(got.items()), "id long, shard long")
    assert {r.id: r.shard for r in shards.by_count(ids, again, 2, 3, 0).collect()} == got
    assert shards.by_count(ids.where("id < 0"), known, 2).count() == 0


def test_reconcile(spark):
    t = lambda *i: spark.createDataFrame([(x,) for x in i], "id long")
    states = reconcile.reconcile(t(1, 2), t(3, 4), t(1, 3, 5))
    assert {r.id: r.state for r in states.collect()} == {1: "verified", 2: "missing", 3: "recovered", 4: "still_missing", 5: "untracked"}
    assert {r.id: r.status for r in reconcile.next_progress(states).collect()} == {1: "completed", 2: "missing", 3: "completed", 4: "missing"}
    assert reconcile.pending(t(1, 2), t(2)).collect()[0].id == 1


def test_delta(spark):
    a = spark.createDataFrame([(1, "d/A.jpg", "x y"), (2, "a.jpg", "z"), (3, "q.jpg", "k")], "n int, file_name string, tags string")
    b = spark.createDataFrame([(1, "a.jpg", "y, w"), (2, "new.jpg", "t")], "n int, file_name string, tag string")
    got = [(r.file_name, r.original_tags, r.added, r.removed) for r in delta.review_sheet(delta.tag_delta(a, b, "n")).collect()]
    assert got == [("d/A.jpg", "x y z", "w", "x z"), ("new.jpg", "", "t", ""), ("q.jpg", "k", "", "k")]


def test_json(spark):
    texts = ['{"a": ["x", {"b": " Cat "}]}', '{"cat": 1}', '{"a": "cat dog"}', '{"a": "cat",', None, '["CAT"]']
    assert column(spark, texts, lambda c: jsonops.contains_keyword(c, "cat")) == [True, False, False, True, False, True]
    assert column(spark, texts[2:3], lambda c: jsonops.contains_keyword(c, "cat", "token")) == [True]
    df = spark.createDataFrame([("f", '﻿{"a": 1, "b": {"c": 2}}'), ("g", '[{"a": "x"}]'), ("h", "bad")], "file string, text string")
    flat = jsonops.flatten_objects(df, "text")
    assert sorted((r.file, r.key, r.value) for r in flat.collect()) == [("f", "a", "1"), ("f", "b", '{"c":2}'), ("g", "a", "x")]
    assert {r.file: (r.a, r.b) for r in jsonops.to_table(flat, ["file", "item"], ["a", "b"]).collect()} == {"f": ("1", '{"c":2}'), "g": ("x", "")}


def test_archive(spark):
    items = spark.createDataFrame([(1, "u"), (2, "h/x.tar/in/2.png"), (3, None)], "id long, url string")
    index = spark.createDataFrame([(1, "b.tar", "1.png", 1), (1, "a.tar", "1.jpg", 2)], "image_id long, archive string, inner_path string, archive_rank int")
    assert {r.id: (r.archive, r.inner_path) for r in archive.resolve(items, index).collect()} == {1: ("a.tar", "1.jpg"), 2: ("x.tar", "in/2.png"), 3: (None, None)}
    named = spark.createDataFrame([("d123.tar",), ("e7.tar",)], "archive string")
    ids = spark.createDataFrame([(1234,), (7,), (99,)], "id long")
    assert {r.id: r.archive for r in archive.resolve_by_name(ids, named).collect()} == {1234: "d123.tar", 7: "e7.tar", 99: None}


def test_audit_and_records(spark):
    df = spark.createDataFrame([(None, 1, 1, None), (5, 1, 1, None), (2000, 70, 70, "bad"), (2000, 10, 70, None), (2000, 70, 70, None)], "s long, w int, h int, e string")
    got = [r.r for r in df.select(audit.invalid_reason(F.col("s"), F.col("w"), F.col("h"), F.col("e")).alias("r")).collect()]
    assert got == ["file_not_found", "too_small_5bytes", "bad", "dimensions_10x70", None]
    one = spark.range(1).select(project.joined_tags(F.lit("a"), F.lit(None).cast("string"), F.lit(""), F.lit("b")).alias("t")).first().t
    assert one == "a  b"
    record = spark.range(1).select(*project.training_record(F.lit("f"), F.lit("a_b c"), F.lit(" x  y "))).first()
    assert record.tags == "a b c, x, y"
