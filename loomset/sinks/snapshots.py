"""Tables of immutable parts behind a numbered snapshot.

A snapshot is a small file that lists the parts making up the table: a base and
what was added since. Writers put new parts beside the others and then claim the next
number; who finds it taken reads the new state and tries again, so of two writers both
count. Readers take the highest number once and read its parts, whatever happens
meanwhile: a compaction adds a snapshot with one base and removes nothing. Parts that
no kept snapshot lists go by :meth:`SnapshotTable.vacuum`.

Claiming a number is a rename that fails if the name is taken: atomic on HDFS; on a
local file system a check comes before it. On object stores without such a rename one
writer at a time is safe.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SnapshotTable:
    """A table of ``schema`` (names and types) at ``path``, a folder that executors share."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _path(self, *names: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, at = self._fs(), self._path("snapshots")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def snapshot(self, version: int | None = None) -> dict:
        """{"version", "parts", "keys"} of a version, the latest by default; version -1 is the empty table."""
        if version is None:
            version = max(self.versions(), default=-1)
        if version < 0:
            return {"version": -1, "parts": [], "keys": []}
        stream = self._fs().open(self._path("snapshots", f"{version:010d}.json"))
        try:
            raw = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        return json.loads(raw) | {"version": version}

    def _claim(self, version: int, parts: list[str], keys: list[str]) -> bool:
        """Make a snapshot of that number; False if there is one."""
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        draft, place = self._path("drafts", uuid.uuid4().hex), self._path("snapshots", f"{version:010d}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps({"parts": parts, "keys": keys}).encode()))
        finally:
            out.close()
        fs.mkdirs(place.getParent())
        if fs.exists(place):
            fs.delete(draft, False)
            return False
        none = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        kinds = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        kinds[0] = none
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(draft, place, kinds)
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def _write(self, rows: DataFrame) -> str:
        part = f"parts/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{part}")
        return part

    def append(self, rows: DataFrame, key: str | None = None) -> bool:
        """Add a part. A ``key`` that was added before, also by another writer at the same
        time, changes nothing: False."""
        if key is not None and key in self.snapshot()["keys"]:
            return False
        part = self._write(rows)
        while True:
            now = self.snapshot()
            if key is not None and key in now["keys"]:
                return False  # the part isn't listed and goes by a vacuum
            if self._claim(now["version"] + 1, [*now["parts"], part], [*now["keys"], *([key] if key is not None else [])]):
                return True

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a snapshot, pinned: later commits and compactions don't change what it returns."""
        return self._rows(self.snapshot(version)["parts"])

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in parts])

    def compact(self, fold: Callable[[DataFrame], DataFrame]) -> bool:
        """Replace the parts so far by one base, ``fold`` of their rows; parts added meanwhile
        stay beside it. False if there is nothing to fold or another compaction came first."""
        seen = self.snapshot()
        if len(seen["parts"]) < 2:
            return False
        base = self._write(fold(self._rows(seen["parts"])))
        while True:
            now = self.snapshot()
            if now["parts"][: len(seen["parts"])] != seen["parts"]:
                return False
            if self._claim(now["version"] + 1, [base, *now["parts"][len(seen["parts"]) :]], now["keys"]):
                return True

    def vacuum(self, keep: int = 1) -> int:
        """Remove all but the last ``keep`` snapshots and the parts that none of these lists; how
        many parts went. Readers pinned to what goes fail, and so would a commit of this moment:
        run it when none is under way."""
        fs, versions = self._fs(), self.versions()
        kept = versions[-keep:]
        wanted = {p.removeprefix("parts/") for v in kept for p in self.snapshot(v)["parts"]}
        for v in versions[:-keep]:
            fs.delete(self._path("snapshots", f"{v:010d}.json"), False)
        gone = [s.getPath() for s in fs.listStatus(self._path("parts")) if s.getPath().getName() not in wanted] if fs.exists(self._path("parts")) else []
        for part in gone:
            fs.delete(part, True)
        return len(gone)


STATUS = "id long, status string, batch long"


def status_log(spark: SparkSession, path: str) -> SnapshotTable:
    """A table of (id, status, batch): what happened to items, batch by batch."""
    return SnapshotTable(spark, path, STATUS)


def last_status(rows: DataFrame) -> DataFrame:
    """One row per id, of its last batch: the fold of a status log, and its current state."""
    last = rows.groupBy("id").agg(F.max(F.struct("batch", "status")).alias("s"))
    return last.select("id", F.col("s.status").alias("status"), F.col("s.batch").alias("batch"))
