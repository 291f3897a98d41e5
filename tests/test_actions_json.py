"""File actions with a journal, image verification, JSON texts, pushed-down bounds."""

import io
import json
import struct
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomset.functions import jsontext
from loomset.operators import jsonops
from loomset.plans.filters import ColumnBinding, FilterSpec
from loomset.queries_io import _store
from loomset.sinks import actions, outputs
from loomset.sources import verify


# -------------------------------------------------------------------------- actions
class Lost(Exception):
    """The executor is gone: nothing is undone."""


class Failing(actions.Store):
    """Raises an error at the n-th change of a file, of those whose path has ``only`` in it."""

    def __init__(self, at: int, error: type[Exception], only: str = ""):
        super().__init__()
        self.left, self.error, self.only = at, error, only

    def _count(self, path: str) -> None:
        self.left -= self.only in path
        if self.left < 0:
            raise self.error("injected")

    def move(self, uri, target):
        self._count(uri + target)
        super().move(uri, target)

    def write(self, uri, content):
        self._count(uri)
        if self.error is Lost and self.left == 0:
            super().write(uri, content[: len(content) // 2])
            raise Lost
        super().write(uri, content)

    def remove(self, uri):
        self._count(uri)
        super().remove(uri)


def step(op, path, target=None, content=None):
    return {"op": op, "path": str(path), "target": None if target is None else str(target), "content": content}


def pair(folder):
    folder.mkdir(parents=True)
    (folder / "a.png").write_bytes(b"picture")
    (folder / "a.json").write_bytes(b"{}")
    (folder / "gone.txt").write_bytes(b"gone")
    steps = [step("rename", folder / "a.json", folder / "b.json"), step("rename", folder / "a.png", folder / "b.png"), step("write", folder / "b.json", content=b'{"f": 1}'), step("delete", folder / "gone.txt"), step("delete", folder / "none.txt"), step("write", folder / "new.txt", content=b"new")]
    return steps, tree(folder), {"b.png": b"picture", "b.json": b'{"f": 1}', "new.txt": b"new"}


def tree(folder):
    return {p.name: p.read_bytes() for p in folder.iterdir() if not p.name.startswith(".")}


def hidden(folder):
    return [p.name for p in folder.iterdir() if p.name.startswith(".")]


@pytest.mark.parametrize("overwrite", [False, True])
def test_an_error_at_any_change_leaves_the_old_files(tmp_path, overwrite):
    reached = 0
    for n in range(60):
        folder = tmp_path / str(n)
        steps, before, after = pair(folder)
        found = actions.take(Failing(n, OSError, f"/{n}/"), "x", steps, str(tmp_path / f"j{n}"), overwrite)
        if found == "done":
            assert tree(folder) == after
            reached += 1
        elif found.startswith("failed"):
            assert tree(folder) == before and not hidden(folder)
        else:  # the store fails for good, undoing too: a working store takes it on from there
            assert found.startswith("stuck at move")
            assert actions.take(actions.Store(), "x", steps, str(tmp_path / f"j{n}"), overwrite) == "done"
            assert tree(folder) == after
    assert 0 < reached < 60


class Once(Failing):
    def _count(self, path):
        if self.only in path:
            self.left -= 1
            if self.left == -1:
                raise self.error("injected")


@pytest.mark.parametrize("overwrite", [False, True])
def test_one_failing_change_is_undone_whole(tmp_path, overwrite):
    for n in range(40):
        folder = tmp_path / str(n)
        steps, before, after = pair(folder)
        found = actions.take(Once(n, OSError, f"/{n}/"), "x", steps, str(tmp_path / f"j{n}"), overwrite)
        assert tree(folder) == (after if found == "done" else before)
        assert found == "done" or not hidden(folder)


def test_after_a_lost_executor_at_any_change_the_next_attempt_starts_over(tmp_path):
    for n in range(60):
        for m in range(n % 5, 60, 19):
            folder = tmp_path / f"{n}-{m}"
            steps, before, after = pair(folder)
            journal = str(tmp_path / f"j{n}-{m}")
            for k in (n, m):  # lost twice, the second time perhaps while undoing
                try:
                    actions.take(Failing(k, Lost), "x", steps, journal, False)
                    break
                except Lost:
                    continue
            assert actions.take(actions.Store(), "x", steps, journal, False) in ("done", f"failed: no file {folder}/a.json")
            assert tree(folder) == after


def test_checks_before_the_first_move(tmp_path):
    steps, before, after = pair(tmp_path / "d")
    (tmp_path / "d" / "b.png").write_bytes(b"other")
    take = lambda s, over=False: actions.take(actions.Store(), "x", s, str(tmp_path / "j"), over)
    assert take(steps).startswith("failed") and (tmp_path / "d" / "a.json").exists()
    assert take([step("rename", tmp_path / "none", tmp_path / "b")]).startswith("failed: no file")
    assert take([step("rename", tmp_path / "d" / "a.png")]).startswith("failed: no target")
    assert take([step("write", tmp_path / "d" / "a.png")]).startswith("failed: no content")
    assert take([step("copy", tmp_path / "d" / "a.png")]).startswith("failed: unknown action")
    assert take([]) == "done" and take(steps, True) == "done"
    assert tree(tmp_path / "d") == after


def test_journal_of_a_plan(spark, tmp_path):
    d = tmp_path / "data"
    d.mkdir()
    for k in range(30):
        (d / f"{k}.png").write_bytes(b"p%d" % k)
        (d / f"{k}.json").write_bytes(b"{}")
    rows = spark.range(30).select(F.col("id").cast("string").alias("item"), *[F.concat(F.lit(f"{d}/"), F.col("id").cast("string"), F.lit(e)).alias(n) for n, e in (("p", ".png"), ("q", "_x.png"), ("j", ".json"), ("k", "_x.json"))], F.when(F.col("id") % 7 != 0, "{1}").alias("t"))
    journal, before = f"{tmp_path}/journal", tree(d)
    plan = rows.select("item", actions.rename_steps("p", "q", "j", "k", "t").alias("steps"))
    actions.stage(plan, journal)
    assert actions.rehearse(spark, journal).count() == 90 and tree(d) == before
    found = {r.item: r.outcome for r in actions.commit(spark, journal).collect()}
    assert {i for i, o in found.items() if o == "done"} == {str(k) for k in range(30) if k % 7}
    assert all(o.startswith("failed: no content") for o in found.values() if o != "done")
    now = tree(d)
    assert now["1_x.json"] == b"{1}" and now["7.json"] == b"{}" and len(now) == 60
    assert {r.outcome for r in actions.commit(spark, journal).collect()} == set(found.values()) and tree(d) == now  # nothing is left to do
    assert {r.outcome.split(":")[0] for r in actions.roll_back(spark, journal).collect()} == {"undone", "failed"}
    assert tree(d) == before and not hidden(d)
    actions.purge(spark, journal)
    assert tree(d) == before
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        actions.stage(plan, journal)
    with pytest.raises(ValueError, match="planned twice"):
        actions.stage(plan.unionByName(plan), f"{tmp_path}/twice")
    actions.stage(plan.limit(0), f"{tmp_path}/none")
    assert actions.commit(spark, f"{tmp_path}/none").count() == 0


def many(folder, n):
    """Renames with their sidecars as rows of one task; where the files are before and after."""
    folder.mkdir(parents=True)
    rows = []
    for k in range(n):
        (folder / f"{k}.png").write_bytes(b"p%d" % k)
        (folder / f"{k}.json").write_bytes(b"j%d" % k)
        rows.append((str(k), [step("rename", folder / f"{k}.json", folder / f"{k}_x.json"), step("rename", folder / f"{k}.png", folder / f"{k}_x.png"), step("write", folder / f"{k}_x.json", content=b"n%d" % k)], False))
    after = {f"{k}_x.png": b"p%d" % k for k in range(n)} | {f"{k}_x.json": b"n%d" % k for k in range(n)}
    return rows, tree(folder), after


def all_of(store, rows, journal):
    return actions.take_all(store, rows, journal, actions.Log(store, journal, "0"))


def test_items_of_a_task_after_a_lost_executor(tmp_path):
    for n in range(0, 50):
        for m in range(n % 3, 50, 13):
            folder = tmp_path / f"{n}-{m}"
            rows, before, after = many(folder, 3)
            journal, found = str(tmp_path / f"j{n}-{m}"), None
            for k in (n, m):
                try:
                    found = all_of(Failing(k, Lost), rows, journal)
                    break
                except Lost:
                    continue
            # what ended is not taken again by a commit
            assert (found or all_of(actions.Store(), rows, journal)) == ["done"] * 3 and tree(folder) == after


def test_an_item_that_fails_leaves_the_others_of_its_task(tmp_path):
    for n in range(12):
        folder = tmp_path / str(n)
        rows, before, after = many(folder, 4)
        found = all_of(Once(n, OSError, f"/{n}/2"), rows, str(tmp_path / f"j{n}"))
        mine = lambda files: {name: text for name, text in files.items() if name.startswith("2")}
        assert [o for k, o in enumerate(found) if k != 2] == ["done"] * 3
        assert mine(tree(folder)) == mine(after if found[2] == "done" else before)
        assert {**tree(folder), **mine(after)}.keys() >= after.keys()
        assert found[2] == "done" or found[2].startswith("failed")


def test_items_of_a_task_that_meet_on_a_path(tmp_path):
    for k in "abc":
        (tmp_path / k).write_bytes(k.encode())
    rows = [("1", [step("rename", tmp_path / "a", tmp_path / "z")], False), ("2", [step("rename", tmp_path / "b", tmp_path / "z")], False), ("3", [step("rename", tmp_path / "c", tmp_path / "a")], False)]
    assert [o.split(":")[0] for o in all_of(actions.Store(), rows, str(tmp_path / "j"))] == ["done", "failed", "done"]
    assert {p.name: p.read_bytes() for p in tmp_path.iterdir() if p.is_file()} == {"z": b"a", "b": b"b", "a": b"c"}


def test_a_log_of_a_task_not_of_an_item(spark, tmp_path):
    d, journal = tmp_path / "data", f"{tmp_path}/journal"
    d.mkdir()
    for k in range(600):
        (d / f"{k}.png").write_bytes(b"p")
    path = F.concat(F.lit(f"{d}/"), F.col("id").cast("string"), F.lit(".png"))
    plan = spark.range(600).select(F.col("id").alias("item"), path.alias("p"), F.regexp_replace(path, "data", "to").alias("q"), F.lit(None).cast("string").alias("n"))
    actions.stage(plan.select("item", actions.move_steps("p", "q", "n", "n").alias("steps")), journal)
    assert {r.outcome for r in actions.commit(spark, journal).collect()} == {"done"} and len(tree(tmp_path / "to")) == 600
    logs = [p for p in (tmp_path / "journal" / "begun").rglob("*") if p.is_file()]
    assert len(logs) <= 600 // actions.ITEMS_A_TASK + 1
    assert {r.outcome for r in actions.roll_back(spark, journal).collect()} == {"undone"} and len(tree(d)) == 600


def test_small_contents_that_a_write_replaces_are_no_files(spark, tmp_path, monkeypatch):
    d, journal = tmp_path / "data", f"{tmp_path}/journal"
    rows, before, after = many(d, 40)
    (d / "7.json").write_bytes(b"7" * (actions.KEPT_BYTES + 1))  # too large for the log
    before = tree(d)
    plan = spark.createDataFrame([(i, [(s["op"], s["path"], s["target"], s["content"]) for s in steps]) for i, steps, _ in rows], f"item string, steps {actions.STEPS}")
    actions.stage(plan, journal)
    assert {r.outcome for r in actions.commit(spark, journal).collect()} == {"done"} and tree(d) == after
    assert [name.split(".")[1] for name in hidden(d)] == ["7_x"]
    assert {r.outcome for r in actions.roll_back(spark, journal).collect()} == {"undone"} and tree(d) == before and not hidden(d)
    actions.stage(plan, f"{journal}2")
    actions.commit(spark, f"{journal}2")
    kept = lambda: [json.loads(p.read_bytes())[1] for p in (tmp_path / "journal2" / "begun").iterdir() if not p.name.startswith(".")]
    assert sum(map(len, kept())) == 39
    actions.purge(spark, f"{journal}2")
    assert tree(d) == after and not hidden(d) and not any(kept())
    monkeypatch.setattr(actions, "KEPT_A_TASK", 8)  # room for two
    again, before, after = many(tmp_path / "full", 5)
    assert all_of(actions.Store(), again, str(tmp_path / "j")) == ["done"] * 5 and tree(tmp_path / "full") == after
    assert len(hidden(tmp_path / "full")) in (3, 4)


def test_removals_add_few_files(spark, tmp_path):
    d = tmp_path / "data"
    rows, before, _ = many(d, 300)
    plan = spark.createDataFrame([(i, str(d / f"{i}.png"), str(d / f"{i}.json")) for i, _, _ in rows], "item string, p string, j string").select("item", actions.removal_steps("p", "j").alias("steps"))
    own = lambda journal: sum(p.is_file() for p in (tmp_path / journal).rglob("*"))
    for journal, then in (("back", actions.roll_back), ("gone", actions.purge)):
        actions.stage(plan, f"{tmp_path}/{journal}")
        actions.commit(spark, f"{tmp_path}/{journal}")
        assert tree(d) == {} and len(hidden(d)) == len(before)
        then(spark, f"{tmp_path}/{journal}")
        assert tree(d) == (before if journal == "back" else {}) and not hidden(d)
        assert own(journal) < 60  # intents and outcomes, a log a task


def test_pairs_of_a_shard_that_many_tasks_write(spark, tmp_path):
    rows = spark.range(40).repartition(4).select(F.lit("in").alias("shard"), "id", F.lit(".png").alias("ext"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"), F.lit("{}").alias("json"))
    assert outputs.write_pairs(rows, _store, f"file://{tmp_path}", shared=True).count() == 40
    assert tree(tmp_path / "in") == {f"{k}.png": b"%d" % k for k in range(40)} | {f"{k}.json": b"{}" for k in range(40)}
    assert [p.name for p in tmp_path.iterdir()] == ["in"]


# ---------------------------------------------------------------------------- pictures
def chunk(name, data):
    return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))


def png(w=70, h=65, interlaced=0, parts=2):
    if interlaced:
        raw = b"".join(b"\0" * (1 + -(-(w - x) // dx)) for x, dx, y, dy in verify._PASSES for _ in range(-(-(h - y) // dy)))
    else:
        raw = (b"\0" + bytes(range(w))) * h
    data = zlib.compress(raw)
    step_ = -(-len(data) // parts)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, interlaced)) + chunk(b"tEXt", b"k\0v") + b"".join(chunk(b"IDAT", data[i : i + step_]) for i in range(0, len(data), step_)) + chunk(b"IEND", b"")


def look(data):
    return verify.verify(io.BytesIO(data))


def test_png_cut_at_every_place():
    whole = png()
    assert look(whole) == (70, 65, None, None, None) and look(png(interlaced=1)) == (70, 65, None, None, None)
    text_at, first = 33, whole.index(b"IDAT") - 4
    for n in range(len(whole)):
        w, h, error, damage, unreadable = look(whole[:n])
        if n < first + 8:
            inside = 16 <= n < 29 or text_at + 8 <= n < text_at + 11  # in a chunk's data, the library's other error
            assert error == ("invalid_image_OSError" if inside else "not_an_image"), n
        elif n < len(whole) - 4:  # the last chunk's sum is not looked at
            assert (w, h, error) == (70, 65, None) and damage in ("OSError", "SyntaxError"), n
        else:
            assert damage is None and unreadable is None
    assert look(whole[: first + 20])[4] == "OSError"


def test_png_sums_and_rows():
    whole = bytearray(png())
    at = bytes(whole).index(b"IDAT") + 6
    whole[at] ^= 1
    assert look(bytes(whole))[3] == "SyntaxError"
    short = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 70, 65, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0" * 71 * 64)) + chunk(b"IEND", b"")
    assert look(short) == (70, 65, None, None, "OSError")  # a row is missing: verifying doesn't see it, loading does
    big = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 60000, 60000, 8, 0, 0, 0, 0)) + chunk(b"IDAT", b"") + chunk(b"IEND", b"")
    assert look(big)[2] == "decompression_bomb"


def test_jpeg_gif_and_webp():
    jpeg = b"\xff\xd8" + b"\xff\xe0\x00\x04ab" + b"\xff\xff\xc0\x00\x0b\x08\x00\x50\x00\x60\x01\x01\x11\x00" + b"\xff\xda\x00\x03x" + b"data\xff\x00" + b"\xff\xd9"
    assert look(jpeg) == (96, 80, None, None, None)
    scan = jpeg.index(b"\xff\xda") + 5
    for n in range(len(jpeg)):
        _, _, error, damage, unreadable = look(jpeg[:n])
        if n < scan:
            assert error in ("not_an_image", "invalid_image_OSError"), n
        else:
            assert (error, damage, unreadable) == (None, None, "OSError"), n
    gif = b"GIF89a" + struct.pack("<HHBBB", 9, 8, 0x80, 0, 0) + b"\0" * 6 + b"!\xf9\x02ab\0" + b"," + b"\0" * 9 + b"\x02" + b"\x03abc\x01d\0" + b";"
    assert look(gif) == (9, 8, None, None, None)
    picture = gif.index(b",") + 11
    for n in range(len(gif) - 1):
        _, _, error, _, unreadable = look(gif[:n])
        assert (error == "not_an_image") if n < picture else (error, unreadable) == (None, "OSError"), n
    body = b"VP8X" + struct.pack("<I", 10) + b"\0\0\0\0" + (99).to_bytes(3, "little") + (49).to_bytes(3, "little") + b"EXIF" + struct.pack("<I", 3) + b"abc\0"
    webp = b"RIFF" + struct.pack("<I", len(body) + 4) + b"WEBP" + body
    assert look(webp) == (100, 50, None, None, None)
    assert all(look(webp[:n])[2] == "not_an_image" for n in range(len(webp) - 1))
    assert look(b"")[2] == look(b"text")[2] == "not_an_image"


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60), st.sampled_from([b"", b"\xff\xd8\xff", b"GIF89a", b"\x89PNG\r\n\x1a\n", b"RIFF\x20\0\0\0WEBP"]))
def test_any_bytes_get_an_answer(data, head):
    assert len(look(head + data)) == 5


def test_verified_files_and_content(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(png())
    (tmp_path / "b c%.png").write_bytes(png()[:-20])
    rows = spark.createDataFrame([(f"file:{tmp_path}/a.png", 1), (f"file:{tmp_path}/b c%.png", 2), (f"file:{tmp_path}/none.png", 3), (None, 4)], "path string, width_hint int")
    got = {r.width_hint: (r.width, r.error, r.damage is not None) for r in verify.verified_files(rows).collect()}
    assert got == {1: (70, None, False), 2: (70, None, True), 3: (None, "file_not_found", False), 4: (None, "file_not_found", False)}
    seen = spark.createDataFrame([(bytearray(png()),), (None,)], "c binary").select(verify.verified_content("c").alias("v")).select("v.*").collect()
    assert [(r.width, r.error) for r in seen] == [(70, None), (None, "file_not_found")]


# -------------------------------------------------------------------------------- JSON
TEXTS = ['{"a": 1.50, "file_name": [1, {"x": "}"}], "z": null}', "{}", " { } ", '{"a":1}\n', '{"a":1} x', "[1]", "1,2", "1], [2", '{"f":1,"file_name":2,"file_name":3}', '{"file\\u005fname":"o\\"ld"}',
         '{"n":{"file_name":1}}', '{"a":' * 200 + "1" + "}" * 200, '{"a":"' + "y\\n" * 100_000 + '"}', '{"a": tru}', "", None, "{'a':1}", '"x"', "null", '{"a":1,}', '{"file_name":1 , "b":[1,2]}', '{"b":"file_name"}']


def test_set_member(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = {r.i: r.e for r in rows.select("i", jsonops.patch_file_name(F.col("text"), F.lit('né"w\\.png')).alias("e")).collect()}
    for i, text in enumerate(TEXTS):
        try:
            want = json.loads(text)
            ok = isinstance(want, dict)
        except (TypeError, ValueError):
            ok = False
        if not ok:
            assert got[i] is None, text
            continue
        want["file_name"] = 'né"w\\.png'
        assert json.loads(got[i]) == want and (len(text) > 1000 or list(json.loads(got[i])) == list(want)), text
    assert got[0] == '{"a": 1.50, "file_name": "né\\"w\\\\.png", "z": null}'


JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.text("cat \\\"é\n{}[]:,", max_size=8), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("cat\"\\:", max_size=4), x, max_size=3), max_leaves=8)


def strings(x):
    return [x] if isinstance(x, str) else [s for v in (x.values() if isinstance(x, dict) else x) for s in strings(v)] if isinstance(x, (list, dict)) else []


@settings(max_examples=5, deadline=None)
@given(st.lists(JSON, min_size=40, max_size=40), st.booleans())
def test_string_values_and_keyword(spark, values, ascii_only):
    texts = [json.dumps(v, ensure_ascii=ascii_only) for v in values]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = rows.select("i", jsontext.is_json(F.col("text")).alias("ok"), jsontext.string_values(F.col("text")).alias("s"), jsonops.contains_keyword(F.col("text"), "CAT ").alias("k"), jsonops.contains_keyword(F.col("text"), "cat", "token").alias("w"))
    for r in got.collect():
        mine = strings(values[r.i])
        assert r.ok and r.s == mine, texts[r.i]
        assert r.k == any(s.strip().lower() == "cat" for s in mine) and r.w == any("cat" in s.lower().split() for s in mine)


def test_keyword_needs_no_python_worker(spark):
    rows = spark.createDataFrame([('{"a": ["x", " CAT "}',), ('{"a": "cat" ',), ('﻿["\\u0063at"]',), ('{"cat": 1}',), (None,), ("",)], "text string")
    found = rows.select("text", jsonops.contains_keyword(F.col("text"), "cat").alias("k"))
    assert [r.k for r in found.collect()] == [True, False, True, False, False, False]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_flatten_mixed_lists(spark):
    rows = spark.createDataFrame([(1, '[{"a":1},"str",{"b":2.5},null,["c"],"{\\"d\\":1}"]'), (2, '{"a":{"k":[1,2]},"n":null}'), (3, '[{"a":1,"a":2}]'), (4, '{"a":1} {}'), (5, None), (6, "[]"), (7, "3"), (8, '﻿{"q":"r"}')], "i int, text string")
    got = sorted((r.i, r.item, r.key, r.value) for r in jsonops.flatten_objects(rows, "text").where("i <> 3").collect())
    assert got == [(1, 0, "a", "1"), (1, 1, "b", "2.5"), (2, 0, "a", '{"k":[1,2]}'), (2, 0, "n", None), (8, 0, "q", "r")]
    assert jsonops.flatten_objects(rows.where("i = 3"), "text").count() > 0


# ------------------------------------------------------------------------------ bounds
def test_bounds_reach_the_scan_and_change_nothing(spark, tmp_path):
    rows = [(1, None, 3, 4), (2, 7, None, 4), (3, 2**53 + 1, 10, 10), (4, -5, 10, 9), (5, 0, 0, 0), (6, 7, 12, 12)]
    spark.createDataFrame(rows, "id long, score long, image_width int, image_height int").write.parquet(f"{tmp_path}/t")
    stored, bound = spark.read.parquet(f"{tmp_path}/t"), ColumnBinding()
    for spec in (FilterSpec(min_score=5), FilterSpec(min_score=0), FilterSpec(min_score=-3), FilterSpec(square=True), FilterSpec(square=True, min_square=5), FilterSpec(min_width=5, max_height=11), FilterSpec(max_width=11)):
        for policy in ("zero", "strict"):
            plain = spec.apply(bound.canonical(stored, policy)).collect()
            assert spec.apply_raw(stored, bound, policy).collect() == plain
    for spec, pushed in ((FilterSpec(min_score=5), "GreaterThanOrEqual(score,5)"), (FilterSpec(max_width=9), "LessThanOrEqual(image_width,9)")):
        assert pushed in spec.apply_raw(stored, bound)._jdf.queryExecution().executedPlan().toString()
    assert [r.score for r in FilterSpec(min_score=100).apply_raw(stored, bound).collect()] == [2**53 + 1]
