"""Manifests, shards in order of arrival, snapshots and compaction."""

import json
import random
import tarfile
import threading
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loomset.operators import shards
from loomset.plans.filters import ColumnBinding
from loomset.queries_io import QUERIES
from loomset.sinks import compaction, outputs, snapshots
from loomset.sources import files, tables
from loomset.streaming import shard_stream


# -------------------------------------------------------------------------- manifests
def test_manifest_shapes(spark):
    texts = [
        ('{"files": {"12345.jpg": "x/9.png", "a_6789.png": {"s": 1}, "none.png": {}}}', {(12345, "12345.jpg"), (6789, "a_6789.png")}),
        ('{"files": ["d/1.jpg", "x", 5, null]}', {(1, "d/1.jpg")}),
        ('{"2.jpg": {"s": 1}, "3": "in/3.png", "123.x.jpg": null}', {(2, "2.jpg"), (3, "in/3.png")}),
        ('["4.jpg", "0.png"]', {(4, "4.jpg"), (0, "0.png")}),
        ("{}", set()), ("[", set()), ("5", set()), (None, set()), ('{"files": []}', set()), ('{"files": {}, "7.jpg": 1}', set()),
    ]
    rows = spark.createDataFrame([(str(k), t) for k, (t, _) in enumerate(texts)], "a string, text string")
    got = {(r.archive, r.image_id, r.inner_path) for r in files.manifest_entries(rows, F.col("a")).collect()}
    assert got == {(str(k), *e) for k, (_, found) in enumerate(texts) for e in found}


def test_only_archives_without_a_usable_manifest_are_opened(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)

    for name in ("a.tar", "b.tar", "c.tar"):
        put(name, "no tar at all")
    with tarfile.open(tmp_path / "d.tar", "w") as tar:
        put("member", "x")
        tar.add(tmp_path / "member", "in/77.jpg")
        tar.add(tmp_path / "member", "noid.jpg")
    put("a.json", json.dumps(["1.jpg"]))
    put("a_files.json", json.dumps(["2.jpg"]))
    put("b.json", "[]")
    put("b_manifest.json", json.dumps({"3.jpg": {}}))
    put("c.json", "{broken")
    put("c_manifest.json", json.dumps({"files": []}))
    put("c_files.json", json.dumps({"files": ["4.jpg"]}))
    put("d.json", "null")
    put("unrelated.json", json.dumps(["9.jpg"]))
    want = [("a.tar", 1, "1.jpg"), ("b.tar", 3, "3.jpg"), ("c.tar", 4, "4.jpg")]
    assert sorted(map(tuple, files.archive_index(spark, str(tmp_path), scan=False).collect())) == want
    assert sorted(map(tuple, files.archive_index(spark, str(tmp_path)).collect())) == [*want, ("d.tar", 77, "in/77.jpg")]


# ------------------------------------------------------------------- order of arrival
def test_shards_by_arrival(spark):
    rows = spark.createDataFrame([(30, 1), (10, 2), (20, 3), (5, 3)], "id long, at long")
    none = spark.createDataFrame([], "id long, shard long")
    by = lambda **more: {r.id: r.shard for r in shards.by_count(rows, none, 1, **more).collect()}
    assert by(arrival="at") == {30: 0, 10: 1, 5: 2, 20: 3}
    assert by() == {5: 0, 10: 1, 20: 2, 30: 3}


def reference(batches, size):
    found, index, count = {}, 0, 0
    for batch in batches:
        for i in batch:
            if i in found:
                continue
            if count >= size:
                index, count = index + 1, 0
            found[i] = index
            count += 1
    return found


def test_arrival_stream_and_replay(spark, tmp_path):
    batches = [[9, 2, 7, 2], [], [7, 1, 8, 3], [2, 4, 6, 5, 11, 10]]
    table = f"{tmp_path}/t"
    frame = lambda b: spark.createDataFrame([(i, k) for k, i in enumerate(b)], "id long, at long")
    for epoch, batch in enumerate(batches):
        for _ in range(2):  # every epoch runs twice
            shard_stream.assign_batch(frame(batch), epoch, table, 2, "at")
        assert {r.id: r.shard for r in shard_stream.manifest(spark, table).collect()} == reference(batches[: epoch + 1], 2)
    for go in range(2):  # the second start finds new files only
        spark.createDataFrame([(100 - k - 10 * go, k) for k in range(15)] + [(None, 3)], "id long, arrival long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("id long, arrival long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        shard_stream.assign(stream, f"{tmp_path}/s", f"{tmp_path}/c", 4).awaitTermination()
    want = reference([[100 - k for k in range(15)], [90 - k for k in range(15)]], 4)
    assert {r.id: r.shard for r in shard_stream.manifest(spark, f"{tmp_path}/s").collect()} == want


# -------------------------------------------------------------------------- snapshots
def state(log):
    return {r.id: r.status for r in snapshots.last_status(log.read()).collect()}


def test_snapshots(spark, tmp_path):
    log = snapshots.status_log(spark, str(tmp_path / "log"))
    rows = lambda *r: spark.createDataFrame(list(r), snapshots.STATUS)
    assert state(log) == {} and not log.compact(snapshots.last_status)
    assert log.append(rows((1, "completed", 1), (2, "completed", 1)), "a")
    held = snapshots.last_status(log.read())
    assert log.append(rows((2, "missing", 2), (None, "missing", 2)), "b") and not log.append(rows((3, "x", 3)), "b")
    assert state(log) == {1: "completed", 2: "missing", None: "missing"}
    other = snapshots.status_log(spark, str(tmp_path / "log"))
    folds = []

    def fold(df):  # a batch and another compaction come in between
        folds.append(1)
        if len(folds) == 1:
            assert other.append(rows((3, "missing", 3)), "c")
        return snapshots.last_status(df)

    assert log.compact(fold) and len(log.snapshot()["parts"]) == 2
    whole = {1: "completed", 2: "missing", None: "missing", 3: "missing"}
    assert state(log) == whole
    assert not log.append(rows((9, "x", 9)), "a")  # a folded batch is known
    assert sorted(tuple(r) for r in held.collect()) == [(1, "completed", 1), (2, "completed", 1)]

    def overtaken(df):
        if len(folds) == 1:
            folds.append(1)
            assert other.compact(snapshots.last_status)
        return snapshots.last_status(df)

    assert not log.compact(overtaken)
    assert state(log) == whole
    assert log.vacuum() >= 4 and state(log) == whole


def test_writers_at_once_both_count(spark, tmp_path):
    log = snapshots.status_log(spark, str(tmp_path / "log"))
    put = lambda k: log.append(spark.createDataFrame([(k, "completed", k)], snapshots.STATUS), str(k % 6))
    threads = [threading.Thread(target=put, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(log.snapshot()["keys"]) == [str(k) for k in range(6)]
    assert log.read().count() == 6 and log.versions() == list(range(6))


# ------------------------------------------------------------------------- compaction
def test_skewed_files_become_even_ones(spark, tmp_path):
    (tmp_path / "in x+%").mkdir()
    noise, start = random.Random(1), 0
    for k in range(16):
        size = 40 * 2 ** (k // 2)
        table = pa.table({"id": range(start, start + size), "text": [noise.randbytes(40).hex() for _ in range(size)], "_row": [1] * size})
        pq.write_table(table, tmp_path / "in x+%" / f"f {k}.parquet", compression="zstd")
        start += size
    pq.write_table(table.slice(0, 0), tmp_path / "in x+%" / "empty.parquet")
    found = compaction.footers(spark, f"{tmp_path}/in x+%").collect()
    total = sum(r["bytes"] for r in found)
    assert len(found) == 17 and sum(r["rows"] for r in found) == start
    bins = compaction.compact_files(spark, f"{tmp_path}/in x+%", f"{tmp_path}/out", total // 5)
    sizes = [r["bytes"] for r in compaction.footers(spark, f"{tmp_path}/out").collect()]
    assert bins == len(sizes) == 5 and max(abs(s - total / 5) for s in sizes) < 0.1 * total / 5
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.columns == ["id", "text", "_row"] and out.agg(F.count("*"), F.countDistinct("id"), F.sum("id")).first() == (start, start, start * (start - 1) // 2)
    spark.range(0).write.parquet(f"{tmp_path}/none")
    assert compaction.compact_files(spark, f"{tmp_path}/none", f"{tmp_path}/none_out") == 0
    assert spark.read.parquet(f"{tmp_path}/none_out").count() == 0


def test_compaction_shuffles_rows_once(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 4).withColumn("h", F.sha2(F.col("id").cast("string"), 256))
    rows.write.parquet(f"{tmp_path}/in")
    store = spark.sparkContext._jsc.sc().statusStore()
    before = store.executorSummary("driver").totalShuffleWrite()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        compaction.compact_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", 300_000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # a row is 100 bytes or so, of which some 80 can't be compressed away by the shuffle's codec
    assert store.executorSummary("driver").totalShuffleWrite() - before < 20_000 * 120
    assert spark.read.parquet(f"{tmp_path}/out").distinct().count() == 20_000


def test_compact_by_size_is_not_many_times_its_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("loomset.sources.state.scratch", lambda spark, name: f"{tmp_path}/{name}")
    assert QUERIES["compact_by_size"](spark, "/root/testdata/sf0.01").first()["even"]
    assert sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) < 15_000 * 2 * 60  # 0.5 kB a row and copy before


def test_required_columns_reads_its_table(spark):
    got = QUERIES["required_columns"](spark, "/root/testdata/sf0.001")
    assert "ReadSchema: struct<p_partkey:bigint" in got._jdf.queryExecution().executedPlan().toString()


def test_compact_parquet_without_a_size(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 16).withColumn("h", F.sha2(F.col("id").cast("string"), 256))
    outputs.compact_parquet(rows, f"{tmp_path}/out", target_bytes=400_000)
    assert 4 <= compaction.footers(spark, f"{tmp_path}/out").count() <= 10 and spark.read.parquet(f"{tmp_path}/out").count() == 40_000
    assert not (tmp_path / "out.draft").exists()


# --------------------------------------------------------------- schemas and counters
def test_one_scan_a_schema(spark, tmp_path):
    for k in range(30):
        pq.write_table(pa.table([{"id": [k]}, {"id": [str(k)], "score": ["7.5"]}, {"id": pa.array([k], pa.int32()), "score": [k]}][k % 3]), tmp_path / f"f {k}.parquet")
    paths = [f"{tmp_path}/f {k}.parquet" for k in range(30)] + [f"{tmp_path}/none"]
    assert sorted(map(len, tables.schema_groups(spark, paths))) == [10, 10, 10]
    bound = ColumnBinding("id", None, None, None, None, None, "score", None, None, None, None)
    both = tables.parquet_union(spark, paths, bound)
    assert both._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 3
    assert sorted((r.id, r.score) for r in both.collect()) == [(k, (None, 7, k)[k % 3]) for k in range(30)]
    with pytest.raises(FileNotFoundError):
        tables.parquet_union(spark, [f"{tmp_path}/none"], bound)


def test_a_counted_write_is_one_job(spark, tmp_path):
    rows = spark.createDataFrame([("completed", 5), ("failed", 1), ("completed", 7), ("odd", 3), (None, 1), ("skipped", None)], "status string, bytes long")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    got = outputs.write_counted(rows, f"{tmp_path}/out")
    jobs = len(tracker.getJobIdsForGroup("counted"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs == 1 and spark.read.parquet(f"{tmp_path}/out").count() == 6
    assert got["completed"] == 2 and got["completed_bytes"] == 12 and got["failed"] == 1 and got["skipped"] == 1 and got["skipped_bytes"] == 0 and got["not_found"] == 0
    again = spark.read.parquet(f"{tmp_path}/out").groupBy("status").count().where("status = 'completed'").first()["count"]
    assert again == got["completed"]


def test_tries_wait_longer_each_time(spark):
    def fetch(item, tried=[]):  # noqa: B006
        tried.append(time.time())
        if len(tried) < 3:
            raise OSError
        return b"%.2f %.2f" % (tried[1] - tried[0], tried[2] - tried[1])

    row = outputs.fetch_items(spark.range(1).coalesce(1), fetch, wait=0.1).first()
    first, second = map(float, bytes(row.content).split())
    assert row.status == "completed" and first >= 0.1 and second >= 0.2
