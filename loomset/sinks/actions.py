"""File actions by item, all or none, behind a journal that is written first.

A plan is a table of items, each with the steps that belong together: renames,
writes and removals of, say, an image and its sidecar. :func:`stage` writes it below
the journal's folder before anything is touched. :func:`commit` then takes each item
through its moves, undoing them backwards when one fails, and writes an outcome per
item. Whatever is replaced or removed goes to a name of the journal's own first, so
an item can be undone until :func:`purge` removes those files. Small contents that a
write replaces go into the task's log instead, as a file each would double the files of
a large plan; brought back, they are files of a new date.

An item is checked whole before its first move, and a log, a small file of the journal
for each task, says before every move which one is begun. So after a lost executor all
moves before that one are known to be done, and whether the last was follows from its
source: the task that runs again undoes them and starts over. The items of a task whose
paths have nothing in common take the same move together, so the log is written once a
move, not once a move and item; the others wait for them. :func:`commit` after a lost
driver goes on with items that have no outcome. Two attempts at once would meet on the
same files: speculation is refused.

Defined cases: a failed item leaves its files as they were and the others alone; an
item whose undoing fails is ``stuck`` at a move; removing what isn't there is no
failure; a null path, target or content fails its item; an empty plan does nothing.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STEPS = "array<struct<op:string,path:string,target:string,content:binary>>"
#: Items of a task: each is some round trips to a store, so tasks are dealt by number, not by
#: bytes. The tasks of a journal, and so the names of its logs, follow from it.
ITEMS_A_TASK = 500
#: Bytes of a replaced content, and of all of a task, that a log holds; others stay files.
KEPT_BYTES, KEPT_A_TASK = 16 << 10, 1 << 20


class Store:
    """Files by URI, on any store that ``pyarrow.fs`` opens."""

    def __init__(self) -> None:
        self._open: dict[str, tuple[fs.FileSystem, str]] = {}
        self._made: str | None = None

    def _at(self, uri: str) -> tuple[fs.FileSystem, str]:
        scheme = uri.split("://", 1)[0] + "://" + uri.split("://", 1)[1].split("/", 1)[0] if "://" in uri else "file://"
        if uri.startswith(("/", "file:")):
            self._open.setdefault("file://", (fs.LocalFileSystem(), ""))
            return self._open["file://"][0], "/" + uri.removeprefix("file:").lstrip("/")
        if scheme not in self._open:
            store, inner = fs.FileSystem.from_uri(scheme)
            self._open[scheme] = store, inner
        store, inner = self._open[scheme]
        return store, f"{inner.rstrip('/')}/{uri[len(scheme) :].lstrip('/')}"

    def exists(self, uri: str) -> bool:
        store, at = self._at(uri)
        return store.get_file_info(at).type != fs.FileType.NotFound

    def _folder(self, store: fs.FileSystem, at: str) -> None:
        folder = at.rsplit("/", 1)[0]
        if store.type_name in ("local", "hdfs") and folder != self._made:  # object stores have none
            store.create_dir(folder, recursive=True)
            self._made = folder

    def move(self, uri: str, target: str) -> None:
        store, at = self._at(uri)
        self._folder(store, self._at(target)[1])
        store.move(at, self._at(target)[1])

    def write(self, uri: str, content: bytes) -> None:
        store, at = self._at(uri)
        self._folder(store, at)
        with store.open_output_stream(at) as out:
            out.write(content)

    def read(self, uri: str) -> bytes:
        store, at = self._at(uri)
        with store.open_input_stream(at) as source:
            return source.read()

    def small(self, uri: str, most: int) -> bytes | None:
        """What a file of at most that size holds; None for a larger one or none."""
        store, at = self._at(uri)
        info = store.get_file_info(at)
        return self.read(uri) if info.type == fs.FileType.File and info.size <= most else None

    def remove(self, uri: str) -> None:
        store, at = self._at(uri)
        store.delete_file(at)


class Move:
    """One rename of an item's transaction; ``content`` is written to its source before.

    ``optional``: nothing is moved where there is no source; the target is then a name
    of the journal's own, and being there it tells that the move is done. ``replaced``:
    another content follows at the source, and the log may hold the old one instead."""

    def __init__(self, source: str, target: str, optional: bool = False, content: bytes | None = None, replaced: bool = False):
        self.source, self.target, self.optional, self.content, self.replaced = source, target, optional, content, replaced

    def done(self, store: Store) -> bool:
        """Whether a begun move is done, those after it being undone."""
        return store.exists(self.target) if self.optional else not store.exists(self.source)


class Log:
    """The numbers of the moves that a task's items are at (-1: none) and the small contents
    that these moves replaced, replaced as a whole each time."""

    def __init__(self, store: Store, journal: str, name: str):
        self.store, self.path = store, f"{journal}/begun/{name}"
        self._held: tuple[dict[str, int], dict[str, str]] | None = None

    @staticmethod
    def _key(item: str) -> str:
        return hashlib.sha256(item.encode()).hexdigest()[:32]

    def load(self) -> tuple[dict[str, int], dict[str, str]]:
        if self._held is None:
            at, kept = json.loads(self.store.read(self.path)) if self.store.exists(self.path) else ({}, {})
            self._held = at, kept
        return self._held

    def at(self, item: str) -> int:
        return self.load()[0].get(self._key(item), -1)

    def kept(self, item: str, k: int) -> bytes | None:
        """The content that an item's k-th move replaced, if the log holds it."""
        text = self.load()[1].get(f"{self._key(item)}.{k}")
        return None if text is None else base64.b64decode(text)

    def room(self) -> int:
        return KEPT_A_TASK - sum(map(len, self.load()[1].values()))

    def write(self, moves: dict[str, int], keep: dict[str, bytes] | None = None) -> None:
        """Set the numbers of some items, with what those moves replace; an error leaves those that were."""
        if not moves:
            return
        at, kept = self.load()
        at = at | {self._key(item): k for item, k in moves.items()}
        kept = kept | {f"{self._key(item)}.{moves[item]}": base64.b64encode(data).decode() for item, data in (keep or {}).items()}
        # what an item replaced is of no use before that move
        self._put({i: k for i, k in at.items() if k >= 0}, {i: text for i, text in kept.items() if int(i.split(".")[1]) <= at.get(i.split(".")[0], -1)})

    def forget(self, items: list[str]) -> None:
        """Drop the contents that these items replaced."""
        at, kept = self.load()
        gone = {self._key(item) for item in items}
        left = {i: text for i, text in kept.items() if i.split(".")[0] not in gone}
        if len(left) < len(kept):
            self._put(at, left)

    def _put(self, at: dict[str, int], kept: dict[str, str]) -> None:
        self.store.write(self.path + ".tmp", json.dumps([at, kept]).encode())
        self.store.move(self.path + ".tmp", self.path)
        self._held = at, kept


def moves_of(item: str, steps: list[dict], journal: str, overwrite: bool) -> list[Move]:
    """The renames of an item's steps, in order; names beside a file are the journal's and the item's own."""

    def aside(path: str, k: int, kind: str) -> str:
        folder, name = path.rsplit("/", 1)
        mark = hashlib.sha256(f"{journal}\0{item}\0{k}".encode()).hexdigest()[:16]
        return f"{folder}/.{name}.{mark}.{kind}"

    out = []
    for k, step in enumerate(steps):
        op, path, target = step["op"], step["path"], step["target"]
        if path is None:
            raise ValueError(f"no path to {op}")
        if op == "rename":
            if target is None:
                raise ValueError(f"no target for {path}")
            if overwrite:
                out.append(Move(target, aside(target, k, "old"), optional=True))
            out.append(Move(path, target))
        elif op == "write":
            if step["content"] is None:
                raise ValueError(f"no content for {path}")
            out.append(Move(path, aside(path, k, "old"), optional=True, replaced=True))
            out.append(Move(aside(path, k, "new"), path, content=bytes(step["content"])))
        elif op == "delete":
            out.append(Move(path, aside(path, k, "old"), optional=True))
        else:
            raise ValueError(f"unknown action {op!r}")
    return out


def take_back(store: Store, m: Move, kept: bytes | None) -> None:
    if m.done(store):
        store.move(m.target, m.source)
    elif kept is not None and not store.exists(m.source):
        store.write(m.target + ".back", kept)
        store.move(m.target + ".back", m.source)


def undo(store: Store, items: dict[str, list[Move]], log: Log) -> dict[str, OSError]:
    """Take back the moves of items up to those begun last, the last first; the errors of items that couldn't be."""
    errors: dict[str, OSError] = {}
    for k in range(max(map(log.at, items), default=-1), -1, -1):
        back = {}
        for item, moves in items.items():
            if item in errors or log.at(item) != k:
                continue
            try:
                take_back(store, moves[k], log.kept(item, k))
                back[item] = k - 1
            except OSError as e:
                errors[item] = e
        try:
            log.write(back)
        except OSError as e:
            errors |= dict.fromkeys(back, e)
    for item, moves in items.items():
        try:
            for m in moves if item not in errors else []:
                if m.content is not None and store.exists(m.source):
                    store.remove(m.source)
        except OSError as e:
            errors[item] = e
    return errors


def perform(store: Store, items: dict[str, list[Move]], log: Log) -> dict[str, OSError]:
    """Make the first move of all items, then the second; an item stops at an error, which is returned."""
    errors: dict[str, OSError] = {}
    for k in range(max(map(len, items.values()), default=0)):
        now = {item: moves[k] for item, moves in items.items() if k < len(moves) and item not in errors}
        keep: dict[str, bytes] = {}
        room = log.room() if any(m.replaced for m in now.values()) else 0
        for item, m in now.items():
            try:
                if m.content is not None:
                    store.write(m.source, m.content)
                old = store.small(m.source, min(KEPT_BYTES, room * 3 // 4 - 3)) if m.replaced else None
                if old is not None:
                    keep[item] = old
                    room -= -(-len(old) // 3) * 4
            except OSError as e:
                errors[item] = e
        now = {item: m for item, m in now.items() if item not in errors}
        keep = {item: old for item, old in keep.items() if item in now}
        try:
            log.write(dict.fromkeys(now, k), keep)
        except OSError as e:
            errors |= dict.fromkeys(now, e)
            continue
        for item, m in now.items():
            try:
                if item in keep:
                    store.remove(m.source)
                elif not m.optional or store.exists(m.source):
                    store.move(m.source, m.target)
            except OSError as e:
                errors[item] = e
    return errors


def check(store: Store, moves: list[Move]) -> None:
    """Raise an error if the moves can't all be made from the present state."""
    there: dict[str, bool] = {}
    have = lambda path: there[path] if path in there else store.exists(path)
    for m in moves:
        present = m.content is not None or have(m.source)
        if not present and not m.optional:
            raise FileNotFoundError(f"no file {m.source}")
        if present and have(m.target):
            raise FileExistsError(f"{m.target} exists")
        if present:
            there |= {m.source: False, m.target: True}


def apart(items: dict[str, list[Move]]) -> Iterator[dict[str, list[Move]]]:
    """Items in their order, in groups of which no two have a path in common."""
    group: dict[str, list[Move]] = {}
    seen: set[str] = set()
    for item, moves in items.items():
        paths = {p for m in moves for p in (m.source, m.target)}
        if not seen.isdisjoint(paths):
            yield group
            group, seen = {}, set()
        group[item] = moves
        seen |= paths
    if group:
        yield group


def take_all(store: Store, rows: list[tuple[str, list[dict], bool]], journal: str, log: Log) -> list[str]:
    """Bring the files of (item, steps, overwrite) from any state in between to after all
    steps of the item or before them; the outcomes."""
    found: dict[str, str] = {}
    items: dict[str, list[Move]] = {}
    for item, steps, overwrite in rows:
        try:
            items[item] = moves_of(item, steps, journal, overwrite)
        except ValueError as e:
            found[item] = _outcome(log, item, e)
    try:
        log.load()
    except (ValueError, OSError) as e:
        return [_outcome(log, item, e) for item, _, _ in rows]
    for group in apart(items):
        errors: dict[str, Exception] = dict(undo(store, group, log))  # what an attempt that didn't end has done
        for item in group.keys() - errors.keys():
            try:
                check(store, group[item])
            except OSError as e:
                errors[item] = e
        found |= {item: _outcome(log, item, e) for item, e in errors.items()}
        begun = {item: moves for item, moves in group.items() if item not in errors}
        failed = perform(store, begun, log)
        again = undo(store, {item: begun[item] for item in failed}, log)
        for item in begun:
            found[item] = "done" if item not in failed else _outcome(log, item, again[item]) if item in again else f"failed: {failed[item]}"
    return [found[item] for item, _, _ in rows]


def take(store: Store, item: str, steps: list[dict], journal: str, overwrite: bool) -> str:
    """The same for one item, with a log of its own."""
    return take_all(store, [(item, steps, overwrite)], journal, Log(store, journal, Log._key(item)))[0]


def _outcome(log: Log, item: str, error: Exception) -> str:
    """Stuck at a move if one is begun and can't be undone, else failed."""
    try:
        at = log.at(item)
    except (ValueError, OSError):
        at = None
    return f"failed: {error}" if at == -1 else f"stuck at move {at}: {error}"


# ----------------------------------------------------------------------- the journal
def stage(plan: DataFrame, journal: str, key: str = "item", overwrite: bool = False) -> DataFrame:
    """Write a plan of (item, steps) as the journal's intents; returns them as stored.

    Repeated items are an error: their steps would not be one transaction."""
    spark = plan.sparkSession
    rows = plan.select(F.col(key).cast("string").alias("item"), F.col("steps").cast(STEPS).alias("steps"), F.lit(overwrite).alias("overwrite"))
    rows.write.mode("error").parquet(f"{journal}/intents")
    found = _intents(spark, journal)
    twice = found.groupBy("item").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"item {twice[0]['item']!r} is planned twice")
    return found


def _intents(spark: SparkSession, journal: str) -> DataFrame:
    return spark.read.schema(f"item string, steps {STEPS}, overwrite boolean").parquet(f"{journal}/intents")


def _runs(spark: SparkSession, journal: str) -> list[int]:
    """Numbers of the runs so far, also of those that had nothing to do or didn't end."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{journal}/outcomes")
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [int(f.getPath().getName().removeprefix("run=")) for f in store.listStatus(at)] if store.exists(at) else []


def outcomes(spark: SparkSession, journal: str) -> DataFrame:
    """(item, outcome, run) of all runs so far."""
    if not _runs(spark, journal):
        return spark.createDataFrame([], "item string, outcome string, run int")
    return spark.read.schema("item string, outcome string, run int").parquet(f"{journal}/outcomes")


def latest(spark: SparkSession, journal: str) -> DataFrame:
    """(item, outcome) of each item's last run."""
    return outcomes(spark, journal).groupBy("item").agg(F.max_by("outcome", "run").alias("outcome"))


def rehearse(spark: SparkSession, journal: str) -> DataFrame:
    """(item, op, path, target) of what :func:`commit` would do; nothing is touched."""
    return _intents(spark, journal).select("item", F.posexplode("steps").alias("step", "s")).select("item", "step", "s.op", "s.path", "s.target")


_Rows = list[tuple[str, list[dict], bool]]


def _run(spark: SparkSession, journal: str, rows: DataFrame, act: Callable[[Store, _Rows, Log], list[str]], store: Callable[[], Store]) -> DataFrame:
    if spark.conf.get("spark.speculation", "false") == "true":
        raise RuntimeError("two attempts of a task must not act on the same files: turn spark.speculation off")
    run = max(_runs(spark, journal), default=-1) + 1

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, log, at = store(), None, None
        for batch in batches:
            for task, part in batch.groupby("task"):
                if task != at:
                    log, at = Log(files, journal, str(task)), task
                found = act(files, [(item, list(steps), bool(over)) for item, steps, over in zip(part["item"], part["steps"], part["overwrite"])], log)
                yield pd.DataFrame({"item": part["item"], "outcome": found})

    # all runs deal the items alike, so that a run finds what another has logged
    tasks = max(1, -(-_intents(spark, journal).count() // ITEMS_A_TASK))
    dealt = rows.select("item", "steps", "overwrite", F.pmod(F.hash("item"), F.lit(tasks)).alias("task")).repartitionById(tasks, "task")
    acted = dealt.mapInPandas(each, "item string, outcome string")
    acted.write.parquet(f"{journal}/outcomes/run={run}")
    return latest(spark, journal)


def commit(spark: SparkSession, journal: str, store: Callable[[], Store] = Store) -> DataFrame:
    """Act on the items that have no outcome yet; (item, outcome) of all."""
    left = _intents(spark, journal).join(outcomes(spark, journal), "item", "left_anti")
    return _run(spark, journal, left, lambda files, rows, log: take_all(files, rows, journal, log), store)


def roll_back(spark: SparkSession, journal: str, store: Callable[[], Store] = Store) -> DataFrame:
    """Undo every item that is done, its moves backwards; (item, outcome) of all."""
    done = _intents(spark, journal).join(latest(spark, journal).where("outcome = 'done'"), "item", "left_semi")

    def back(files: Store, rows: _Rows, log: Log) -> list[str]:
        try:
            log.load()
        except (ValueError, OSError) as e:
            return [_outcome(log, item, e) for item, _, _ in rows]
        errors: dict[str, OSError] = {}
        for group in apart({item: moves_of(item, steps, journal, over) for item, steps, over in rows}):
            errors |= undo(files, group, log)
        return [_outcome(log, item, errors[item]) if item in errors else "undone" for item, _, _ in rows]

    return _run(spark, journal, done, back, store)


def purge(spark: SparkSession, journal: str, store: Callable[[], Store] = Store) -> DataFrame:
    """Remove what done items replaced or deleted; from then on they can't be undone."""
    done = _intents(spark, journal).join(latest(spark, journal).where("outcome = 'done'"), "item", "left_semi")

    def drop(files: Store, rows: _Rows, log: Log) -> list[str]:
        for item, steps, over in rows:
            for m in moves_of(item, steps, journal, over):
                if m.optional and files.exists(m.target):
                    files.remove(m.target)
        log.forget([item for item, _, _ in rows])
        return ["purged"] * len(rows)

    return _run(spark, journal, done, drop, store)


# -------------------------------------------------------------------------- the plans
def _step(op: str, path, target=None, content=None):
    null = F.lit(None)
    return F.struct(
        F.lit(op).alias("op"), path.alias("path"), (null if target is None else target).cast("string").alias("target"),
        (null if content is None else content).cast("binary").alias("content"),
    )


def rename_steps(old: str, new: str, json_old: str, json_new: str, patched: str) -> Column:
    """Sidecar, then image, then the sidecar's text: columns of paths and of the patched JSON (null fails the item)."""
    c = F.col
    return F.array(_step("rename", c(json_old), c(json_new)), _step("rename", c(old), c(new)), _step("write", c(json_new), content=c(patched)))


def move_steps(path: str, target: str, json_path: str, json_target: str) -> Column:
    """Image, then its sidecar where there is one (a null path has none)."""
    c = F.col
    both = F.array(_step("rename", c(path), c(target)), _step("rename", c(json_path), c(json_target)))
    return F.filter(both, lambda s: s["path"].isNotNull())


def removal_steps(*paths: str) -> Column:
    """An image and its sidecar; null paths are left out."""
    return F.filter(F.array(*[_step("delete", F.col(p)) for p in paths]), lambda s: s["path"].isNotNull())
