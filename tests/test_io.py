import io
import json
import os
import shutil
import struct
import subprocess
import sys
import tarfile

import duckdb
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from loomset.plans.filters import ColumnBinding
from loomset.queries_io import QUERIES, SQL
from loomset.sinks import outputs
from loomset.sources import files, tables
from loomset.streaming import progress_stream

SF = "/root/testdata/sf0.001"


def test_inventory_json_and_progress(spark, tmp_path):
    shard = tmp_path / "shard_00001"
    shard.mkdir()
    (shard / "12.JPG").write_bytes(b"x" * 5)
    (shard / "13.json").write_text('﻿{"a": 1}')
    (shard / "note.txt").write_text("n")
    inv = files.inventory(spark, str(tmp_path), True)
    assert sorted((r.stem, r.ext, r.size) for r in inv.collect()) == [("12", ".jpg", 5), ("13", ".json", 11), ("note", ".txt", 1)]
    assert [r.id for r in files.shard_ids(inv).collect()] == [12]
    assert [r.id for r in files.shard_ids(inv, "json").collect()] == [13]
    assert files.json_texts(spark, str(tmp_path)).first().text == '{"a": 1}'
    (tmp_path / "p.json").write_text('{"completed_ids": [1, 2], "total": 2}')
    assert sorted((r.id, r.status) for r in files.progress(spark, str(tmp_path / "p.json")).collect()) == [(1, "completed"), (2, "completed")]


def test_executors_list_what_spark_lists(spark, tmp_path):
    names = ["top.json", "a b/c%20d.json", "a b/x.PNG", "a b/deep/er/y", "_no/z.json", ".no/z.json", "k=_/_metadata", "k=_/_w=1", "k=_/.h", "k=_/_h", "k=_/p._COPYING_", "k=_/p.json"]
    for k, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"{}"[: k % 3])
    (tmp_path / "empty").mkdir()
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    for at in (f"{tmp_path}", f"file://{tmp_path}/"):
        found = files.inventory(spark, at, True)
        # Spark's listing has all files in the driver's memory
        assert "binaryFile" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.path, r.size) for r in found.collect() if r.size) == sorted((r.path, r.length) for r in reader.load(at).collect())
        assert sorted(r.name for r in found.collect() if not r.size) == ["_metadata", "top.json", "y"]  # Spark leaves out empty files
        assert sorted(r.name for r in files.inventory(spark, at, True, "*.{json,PNG}").collect()) == ["c%20d.json", "p.json", "top.json", "x.PNG"]
        assert [r.name for r in files.inventory(spark, at).collect()] == ["top.json"]
        assert sorted(r.path for r in files.json_texts(spark, at).collect()) == sorted(r.path for r in found.collect() if r.ext == ".json")
    assert files.inventory(spark, f"{tmp_path}/empty", True).count() == 0
    assert [r.name for r in files.inventory(spark, f"{tmp_path}/*/x*").collect()] == ["x.PNG"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.inventory(spark, f"{tmp_path}/none")


def test_texts_are_handed_over_in_pieces(spark, tmp_path, monkeypatch):
    for k in range(7):
        (tmp_path / f"{k}.json").write_text(f"[{k}]")
    monkeypatch.setattr(files, "_BYTES", 4)
    got = files.texts_of(files.inventory(spark, str(tmp_path)).coalesce(1)).collect()
    assert sorted((r.name, r.text) for r in got) == [(f"{k}.json", f"[{k}]") for k in range(7)]


def test_tar_manifest_probe(spark, tmp_path):
    with tarfile.open(tmp_path / "a.tar", "w") as tar:
        for name in ("d/12.jpg", "x_34567.png"):
            info = tarfile.TarInfo(name)
            info.size = 3
            tar.addfile(info, io.BytesIO(b"abc"))
    got = sorted((r.archive, r.member, r.size, r.pos, r.image_id) for r in files.tar_members(spark, str(tmp_path)).collect())
    assert got == [("a.tar", "d/12.jpg", 3, 0, 12), ("a.tar", "x_34567.png", 3, 1, 34567)]
    shapes = [{"files": {"d/0.jpg": {}}}, {"files": ["2.jpg"]}, {"3.png": {}}, {"4": "in/4.jpg"}, ["5.jpg"]]
    texts = spark.createDataFrame([(json.dumps(s),) for s in shapes], "text string")
    rows = files.manifest_entries(texts, F.lit("a.tar")).collect()
    assert sorted((r.image_id, r.inner_path) for r in rows) == [(0, "d/0.jpg"), (2, "2.jpg"), (3, "3.png"), (4, "in/4.jpg"), (5, "5.jpg")]
    png = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 7, 9)
    huge = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 40000, 40000)
    assert spark.createDataFrame([(bytearray(huge),)], "c binary").select(files.image_probe("c").alias("p")).first().p.error == "decompression_bomb"
    gif, jpeg = b"GIF89a" + struct.pack("<HH", 3, 4), b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08" + struct.pack(">HH", 6, 5) + b"\0" * 8
    webp = b"RIFF\0\0\0\0WEBPVP8X\n\0\0\0\0\0\0\0" + (8).to_bytes(3, "little") + (9).to_bytes(3, "little")
    shapes = spark.createDataFrame([(bytearray(x),) for x in (gif, jpeg, webp, png[:12])], "c binary").select(files.image_probe("c").alias("p"))
    assert [tuple(r.p) for r in shapes.collect()] == [(3, 4, None), (5, 6, None), (9, 10, None), (None, None, "not_an_image")]
    df = spark.createDataFrame([(bytearray(png),), (bytearray(b"zz"),), (None,)], "c binary")
    assert [tuple(r.p) for r in df.select(files.image_probe("c").alias("p")).collect()] == [(7, 9, None), (None, None, "not_an_image"), (None, None, "file_not_found")]


def test_tar_names_as_they_are(spark, tmp_path):
    for name in ("a b.tar", "c%20d#e.tar"):
        with tarfile.open(tmp_path / name, "w") as tar:
            tar.addfile(tarfile.TarInfo("7.jpg"))
    for stream in (True, False):
        assert sorted(r.archive for r in files.tar_members(spark, str(tmp_path), stream=stream).collect()) == ["a b.tar", "c%20d#e.tar"]


def test_tables(spark, tmp_path):
    spark.createDataFrame([(1, "12.7")], "id int, score string").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(2, 5)], "id long, score int").write.parquet(str(tmp_path / "b"))
    paths = [str(tmp_path / x) for x in ("a", "missing", "b")]
    got = tables.parquet_union(spark, paths, ColumnBinding())
    assert sorted((r.id, r.score) for r in got.collect()) == [(1, 12), (2, 5)]
    with pytest.raises(FileNotFoundError):
        tables.parquet_union(spark, paths[1:2], ColumnBinding())
    (tmp_path / "c.csv").write_text('file_name,tags\na.jpg,"x, y"\nNA,\n')
    assert [tuple(r) for r in tables.csv_strings(spark, str(tmp_path / "c.csv")).collect()] == [("a.jpg", "x, y"), ("NA", "")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s1", 1, '{"a":1}'), ("s2", 2, "{}")], "shard string, id long, json string")
    for _ in range(2):
        assert outputs.write_sidecars(df, lambda _: fs.LocalFileSystem(), str(tmp_path / "o")).count() == 2
    assert (tmp_path / "o/s1/1.json").read_text() == '{"a":1}' and not list(tmp_path.rglob("*.tmp"))
    plan = spark.createDataFrame([("delete", str(tmp_path / "o/s1/1.json"), None)], "action string, path string, target string")

    def act(action, path, target):
        fs.LocalFileSystem().delete_file(path)

    assert outputs.run_plan(plan, act).first().outcome == "planned" and (tmp_path / "o/s1/1.json").exists()
    assert outputs.run_plan(plan, act, commit=True).first().outcome == "done" and not (tmp_path / "o/s1/1.json").exists()
    got = outputs.fetch_items(spark.createDataFrame([(1,), (2,)], "id long"), lambda i: b"x" if i == 1 else None)
    assert {r.id: r.status for r in got.collect()} == {1: "completed", 2: "not_found"}


def test_stream_counts_a_replay_once(spark, tmp_path):
    rows = spark.sql("SELECT 1L AS id, 'failed' AS status, timestamp'2024-01-01' AS at UNION ALL SELECT 1L, 'completed', timestamp'2024-01-02'")
    rows.write.parquet(str(tmp_path / "in"))
    for k in range(2):
        progress_stream.maintain(progress_stream.status_events(spark, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / f"c{k}")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "t")).collect()
    assert [(r.id, r.status) for r in got] == [(1, "completed")]


def test_status_counts_of_a_stream(spark, tmp_path):
    spark.sql("SELECT 1L AS id, 'failed' AS status, timestamp'2024-01-01 00:10:00' AS at UNION ALL SELECT 2L, 'failed', timestamp'2024-01-01 00:20:00'").write.parquet(str(tmp_path / "in"))
    counts = progress_stream.status_counts(progress_stream.status_events(spark, str(tmp_path / "in")))
    counts.writeStream.format("memory").queryName("status_counts_test").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert [(r.status, r.n) for r in spark.table("status_counts_test").collect()] == [("failed", 2)]


def test_entry_without_the_training_data_operators(tmp_path):
    """The reference queries are listed with the subpackage deleted, the pipeline file still there or not."""
    for name in ("__spark_entry__.py", "loomset", "corpus_pipeline.py"):
        source = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif os.path.exists(source):
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sum(k.startswith('op') or k == 'pipeline' for k in e.queries()))"
    for _ in range(2):
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout.split()
        assert out[-3:] == [str(len(QUERIES)), str(len(QUERIES)), "0"]
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in "part orders lineitem events documents pages labels".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    order = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(order)} FROM ({SQL[name]})").fetchall()
    norm = lambda rows: sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in rows)
    assert norm(tuple(r) for r in df.select(*order).collect()) == norm(want)
