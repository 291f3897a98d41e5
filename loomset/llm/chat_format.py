"""Conversations as training texts with a loss mask, assembled by columns.

Turns are dealt by a range-partitioned sort, so a conversation with very many turns
is split between tasks. In a task a block of turns becomes text by array operations:
the lengths of all segments (mark, role, mark, content, mark), their cumulative
offsets, and scatter indices by which contents and marks are copied into one
preallocated Arrow buffer. A conversation is one part, or several in order where it
is longer than ``PART_BYTES`` or spans tasks; ``whole`` tells that a part is all of it.

Control strings inside texts are escaped by a backslash after their first character
(one more, if some are there already), which is undone by taking one away. So marks
are found by plain search, and the mask, spans of code points, holds the contents of
the roles to learn and no mark.

Defined cases: null text and null role are empty; any other role is named in its
marks; turns go by number, ties by role, then text, nulls first; repeated rows are
turns of their own; a null id is a conversation; an empty content has an empty span;
an empty table stays empty; other columns are ignored. :func:`read_back` raises an
error on parts that it can't parse.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, text_buffer, text_slices

#: Bytes of contents from which a conversation is continued in another part.
PART_BYTES = 1 << 22


@dataclass(frozen=True)
class Template:
    """Marks around the contents of known roles, and around name and content of others."""

    roles: dict[str, tuple[str, str]] = field(default_factory=lambda: {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")})
    other: tuple[str, str, str] = ("[ROLE]", "[/ROLE]", "</s>")
    learn: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self) -> None:
        if not all(m.strip(" ") for m in self.marks):
            raise ValueError("a mark must not be blank")
        controls = self.controls
        firsts = {c[0] for c in controls}
        for c in controls:
            if set(c[1:]) & (firsts | {"\\", " "}) or c[0] == "\\" or len(c) < 2:
                raise ValueError(f"mark {c!r}: its first character and backslashes must not occur further on")
        openings = [*(a for a, _ in self.roles.values()), self.other[0]]
        if any(a != b and a.startswith(b) for a in openings for b in openings) or len(set(openings)) < len(openings):
            raise ValueError("no opening mark may begin with another one")

    @property
    def marks(self) -> list[str]:
        return [m for pair in self.roles.values() for m in pair] + list(self.other)

    @property
    def controls(self) -> list[str]:
        """The marks without the blanks around them: what must not occur in a content."""
        return sorted({m.strip(" ") for m in self.marks})

    def patterns(self) -> list[tuple[str, str]]:
        """(first character, pattern of the backslashes and the rest) of the control strings."""
        return [
            (c, r"(\\*(?:" + "|".join(re.escape(x[1:]) for x in self.controls if x[0] == c) + "))") for c in sorted({x[0] for x in self.controls})
        ]

    def escape(self, texts: pa.Array) -> pa.Array:
        for first, rest in self.patterns():
            texts = pc.replace_substring_regex(texts, re.escape(first) + rest, first + r"\\\1")
        return texts

    def unescape(self, text: str) -> str:
        if "\\" in text:
            for first, rest in self.patterns():
                text = re.sub(re.escape(first) + r"\\" + rest, lambda m, c=first: c + m.group(1), text)
        return text

    def turns(self, text: str) -> Iterator[tuple[str, int, int]]:
        """(role, start, stop of its content) of the turns of a formatted text."""
        at = 0
        while at < len(text):
            for name, (opening, closing) in self.roles.items():
                if text.startswith(opening, at):
                    start, role = at + len(opening), name
                    break
            else:
                opening, between, closing = self.other
                if not text.startswith(opening, at):
                    raise ValueError(f"no turn begins at character {at}")
                start = text.index(between, at) + len(between)
                role = self.unescape(text[at + len(opening) : start - len(between)])
            stop = text.index(closing, start)
            yield role, start, stop
            at = stop + len(closing)


LLAMA_LIKE = Template()


def scatter(out: np.ndarray, source: np.ndarray, bounds: np.ndarray, target: np.ndarray, block: int = CHUNK_BYTES) -> None:
    """Copy piece i, source[bounds[i]:bounds[i + 1]], to out[target[i]:], a block of pieces at a time."""
    shift, i = target - bounds[:-1], 0
    while i < len(target):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + block, "right")) - 1)
        a, b = int(bounds[i]), int(bounds[j])
        if j == i + 1:  # one piece needs no indices
            out[target[i] : target[i] + b - a] = source[a:b]
        else:
            out[np.arange(a, b) + np.repeat(shift[i:j], np.diff(bounds[i : j + 1]))] = source[a:b]
        i = j


def assemble(roles: pa.Array, texts: pa.Array, template: Template) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, end of each turn in them; code points up to each content's start, its end and its turn's end) of turns in order."""
    coded = pc.fill_null(roles, "").dictionary_encode()
    names, role = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    contents = template.escape(pc.fill_null(texts, ""))
    offsets, data = text_buffer(contents)
    # what stands before and after the content, per distinct role
    between = {x: template.roles.get(x) or (template.other[0] + template.escape(pa.array([x]))[0].as_py() + template.other[1], template.other[2]) for x in names}
    marks = [between[x][side] for side in (0, 1) for x in names]
    raw = [m.encode() for m in marks]
    pool = np.frombuffer(b"".join(raw), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(m) for m in raw])]).astype(np.int64)
    width, chars = np.diff(starts), np.array([len(m) for m in marks], np.int64)
    lead, tail, k = role, role + len(names), len(role)
    # lengths of the segments, turn by turn, and their cumulative offsets
    lengths = np.stack([width[lead], np.diff(offsets), width[tail]], 1).astype(np.int64)
    ends = np.cumsum(lengths.ravel()).reshape(k, 3)
    begin = ends - lengths
    out = np.empty(int(ends[-1, 2]) if k else 0, np.uint8)
    scatter(out, data, offsets, begin[:, 1])
    for side, which in ((0, lead), (2, tail)):
        size = width[which]
        bounds = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(bounds, size)
        out[np.repeat(begin[:, side], size) + inner] = pool[np.repeat(starts[which], size) + inner]
    content = pc.utf8_length(contents).to_numpy(zero_copy_only=False).astype(np.int64)
    after = np.cumsum(chars[lead] + content + chars[tail])
    closed = after - chars[tail]
    return out, ends[:, 2] if k else np.zeros(0, np.int64), closed - content, closed, after


PARTS = "partition int, part long, whole boolean, n_turns long, formatted string, loss_spans array<struct<start:long,stop:long>>"


def format_conversations(
    turns: DataFrame, template: Template = LLAMA_LIKE, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", part_bytes: int = PART_BYTES,
) -> DataFrame:
    """(conv_id, partition, part, whole, n_turns, formatted, loss_spans): the parts of a
    conversation in the order of (partition, part); spans are code points of the part."""
    picked = turns.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    # a piece of the text is a key as well, so that turns of one number may be split
    dealt = picked.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 16))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    id_type = ordered.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([
        ("partition", pa.int32()), ("part", pa.int64()), ("whole", pa.bool_()), ("n_turns", pa.int64()), ("formatted", pa.string()),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []  # turns of the last conversation, not written yet
        size, edge = 0, True  # edge: it began in another part or maybe another task

        def parts(rows: pa.Table, bounds: np.ndarray, whole: np.ndarray) -> pa.RecordBatch:
            """Turns bounds[i]:bounds[i + 1] as one part each."""
            nonlocal number
            role, text = (rows.column(k).combine_chunks() for k in (1, 2))
            out, ends, opened, closed, after = assemble(role, text, template)
            cut = np.concatenate([[0], ends])[bounds]
            made = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(out))
            base = np.repeat(np.concatenate([[0], after])[bounds[:-1]], np.diff(bounds))
            learned = pc.is_in(role, pa.array(sorted(template.learn))).to_numpy(zero_copy_only=False)
            spans = pa.StructArray.from_arrays([pa.array((opened - base)[learned]), pa.array((closed - base)[learned])], ["start", "stop"])
            starts = np.concatenate([[0], np.cumsum(learned)])[bounds]
            columns = [
                rows.column(0).combine_chunks().take(pa.array(bounds[:-1])), np.full(len(whole), partition, np.int32), np.arange(number, number + len(whole)),
                whole, np.diff(bounds), made, pa.ListArray.from_arrays(pa.array(starts, pa.int32()), spans),
            ]
            number += len(whole)
            names = ["conv_id", *schema.names]
            return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

        for whole_batch in batches:
            for batch in text_slices(whole_batch, 2, min(CHUNK_BYTES, part_bytes)):
                held.append(batch)
                size += batch.column(2).nbytes
                rows = pa.Table.from_batches(held)
                ids = rows.column(0).combine_chunks()
                same = pc.fill_null(pc.equal(ids[1:], ids[:-1]), False).to_numpy(zero_copy_only=False)
                same |= (pc.is_null(ids[1:]).to_numpy(zero_copy_only=False)) & (pc.is_null(ids[:-1]).to_numpy(zero_copy_only=False))
                bounds = np.concatenate([[0], np.flatnonzero(~same) + 1]).astype(np.int64)
                if len(bounds) > 1:  # all but the last conversation are complete
                    whole = np.ones(len(bounds) - 1, bool)
                    whole[0] = not edge
                    yield parts(rows.slice(0, bounds[-1]), bounds, whole)
                    edge = False
                rest = rows.slice(bounds[-1])
                size = rest.column(2).nbytes
                held = rest.combine_chunks().to_batches()
                if size >= part_bytes:
                    yield parts(rest, np.array([0, rest.num_rows]), np.zeros(1, bool))
                    held, size, edge = [], 0, True
        if held:
            rows = pa.Table.from_batches(held)
            yield parts(rows, np.array([0, rows.num_rows]), np.zeros(1, bool))

    return ordered.mapInArrow(run, f"conv_id {id_type}, {PARTS}")


class _Digest:
    """What is read back of one conversation, part by part."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, template: Template, text: str, spans: list[dict]) -> None:
        for role, start, stop in template.turns(text):
            self.turns.update(f"{role}\n{template.unescape(text[start:stop])}\n".encode())
            self.n_turns += 1
        for span in spans:
            learned = template.unescape(text[span["start"] : span["stop"]])
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


_FOUND = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
FOUND = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(parts: DataFrame, template: Template = LLAMA_LIKE) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) by parsing
    formatted texts and masks.

    Whole conversations are read where they are. Parts of others, the first and last of
    a task and long ones, meet in one task, as a hash over a conversation needs them
    in order; there one part is held at a time."""
    id_type = parts.schema["conv_id"].dataType.simpleString()
    raw = "partition int, part long, formatted string, loss_spans array<struct<start:long,stop:long>>"
    picked = parts.select("conv_id", "partition", "part", "whole", "formatted", "loss_spans")

    def rows(ids: pa.Array, found: list[tuple]) -> dict[str, pa.Array]:
        return {"conv_id": ids} | {n: pa.array([r[k] for r in found], t) for k, (n, t) in enumerate(zip(_FOUND, _TYPES))}

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, 4):
                alone = batch.column(3)
                here, there = batch.filter(alone), batch.filter(pc.invert(alone))
                found = []
                for text, spans in zip(here.column(4).to_pylist(), here.column(5).to_pylist()):
                    digest = _Digest()
                    digest.add(template, text, spans)
                    found.append(digest.row())
                done = rows(pa.concat_arrays([here.column(0), there.column(0)]), found + [(None,) * 5] * there.num_rows)
                for k, name in ((1, "partition"), (2, "part"), (4, "formatted"), (5, "loss_spans")):
                    done[name] = pa.concat_arrays([pa.nulls(here.num_rows, batch.column(k).type), there.column(k)])
                yield pa.RecordBatch.from_pydict(done)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, digest = None, None
        for whole in batches:
            for batch in text_slices(whole, 8):
                ids, found = [], []
                for k, (key, text, spans) in enumerate(zip(batch.column(0).to_pylist(), batch.column(8).to_pylist(), batch.column(9).to_pylist())):
                    if digest is not None and (text is None or key != last):
                        ids.append(last)
                        found.append(digest.row())
                        digest = None
                    if text is None:
                        ids.append(key)
                        found.append(tuple(batch.column(c)[k].as_py() for c in range(1, 6)))
                    else:
                        digest = digest or _Digest()
                        digest.add(template, text, spans)
                        last = key
                yield pa.RecordBatch.from_pydict(rows(pa.array(ids, batch.column(0).type), found))
                kind = batch.column(0).type
        if digest is not None:
            yield pa.RecordBatch.from_pydict(rows(pa.array([last], kind), [digest.row()]))

    first = picked.mapInArrow(local, f"conv_id {id_type}, {FOUND}, {raw}")
    dealt = first.repartition("conv_id").sortWithinPartitions("conv_id", "partition", "part")
    return dealt.mapInArrow(finish, f"conv_id {id_type}, {FOUND}")
