"""Fill-in-the-middle: texts cut at two ranks of their units and reordered.

A unit is a code point, a word with the blanks after it, or a line; where one
begins is a predicate over two adjacent bytes. Texts are decomposed into chunks
of ``CHUNK`` bytes that see the last byte before them as well, so every chunk
counts its boundaries by itself, whole blocks of chunks at a time. Prefix sums of
the counts give each text's number of units and route both cut ranks to the chunk
that owns them; only those chunks are looked at again, for the byte of the cut.

A document stays in its task, as its row does in Spark, and nothing is shuffled;
memory follows blocks of ``BLOCK`` bytes and the output, not units.

The choice of a form is by hashes of the id: the same in every run and attempt.

Defined cases: null text is empty; empty texts and those that hold a sentinel stay
plain; a cut at rank 0 or n leaves empty pieces; null ids hash as an empty id;
rows are neither dropped nor reordered, repeated ids and rows included; an empty
table stays empty; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, text_buffer, text_slices

CHUNK, BLOCK = 1 << 12, 1 << 20
SENTINELS = ("<P>", "<S>", "<M>")
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS.encode())] = True

#: Does a unit begin at a byte, given the byte before it? A text's first byte always begins one.
UNITS = {
    "char": lambda before, byte: (byte & 0xC0) != 0x80,
    "word": lambda before, byte: _BLANK[before] & ~_BLANK[byte],
    "line": lambda before, byte: before == 0x0A,
}


class Decomposition:
    """The chunks of a column of texts, their boundary counts and the prefix sums."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, unit: str = "char", chunk: int = CHUNK, block: int = BLOCK):
        self.offsets, self.data, self.begins = offsets, data, UNITS[unit]
        chunks = -(-np.diff(offsets) // chunk)
        #: Chunks before each text.
        self.first = np.concatenate([[0], np.cumsum(chunks)])
        text = np.repeat(np.arange(len(chunks)), chunks)
        self.start = offsets[text] + (np.arange(len(text)) - self.first[text]) * chunk
        self.stop = np.minimum(self.start + chunk, offsets[text + 1])
        self.opens = self.start == offsets[text]
        self.rescanned = 0
        counts, a = [np.zeros(1, np.int64)], 0
        while a < len(text):  # chunks lie side by side in the buffer, those of empty texts excepted
            b = max(a + 1, int(np.searchsorted(self.stop, self.start[a] + block, "right")))
            flags = self._flags(int(self.start[a]), int(self.stop[b - 1]), self.start[a:b][self.opens[a:b]])
            counts.append(np.add.reduceat(flags, self.start[a:b] - self.start[a], dtype=np.int64))
            a = b
        #: Boundaries before each chunk, over all texts.
        self.before = np.cumsum(np.concatenate(counts))
        self.n_units = self.before[self.first[1:]] - self.before[self.first[:-1]]

    def _flags(self, start: int, stop: int, openings: np.ndarray) -> np.ndarray:
        """Which bytes of [start, stop) begin a unit; the byte before is the overlap."""
        byte = self.data[start:stop]
        before = self.data[start - 1 : stop - 1] if start else np.concatenate([[0x0A], byte[:-1]]).astype(np.uint8)
        flags = self.begins(before, byte)
        flags[openings - start] = True
        return flags

    def cuts(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Byte at which the unit of each rank begins in its text; the text's end for rank n."""
        whole = self.before[self.first[text]] + rank
        inside = rank < self.n_units[text]
        owner = np.searchsorted(self.before, whole, "right") - 1
        out = self.offsets[text + 1].copy()
        for i in np.flatnonzero(inside).tolist():
            c = int(owner[i])
            start = int(self.start[c])
            flags = self._flags(start, int(self.stop[c]), self.start[c : c + 1][self.opens[c : c + 1]])
            out[i] = start + np.flatnonzero(flags)[whole[i] - self.before[c]]
        self.rescanned += int(inside.sum())
        return out


def _h(group: int, key: Column) -> Column:
    """The group-th eight hexadecimal digits of a key's SHA-256."""
    return F.conv(F.substring(F.sha2(key, 256), 8 * group - 7, 8), 16, 10).cast("long")


def transform(
    docs: DataFrame, seed: int = 1, rate: int = 90, spm: int = 20, unit: str = "char", id_col: str = "doc_id", text_col: str = "text",
    sentinels: tuple[str, str, str] = SENTINELS, chunk: int = CHUNK,
) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, output) per row, without a shuffle.

    ``rate`` of 100 documents are cut, ``spm`` of 100 of these with the suffix first.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")
    plain = (F.col("text") == "") | (F.col("h3") % 100 >= rate)
    for s in sentinels:
        plain |= F.col("text").contains(s)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm, "spm").otherwise("psm")
    picked = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *[_h(g, key).alias(f"h{g}") for g in (1, 2, 3, 4)])
    picked = picked.select("doc_id", "text", "h1", "h2", form.alias("form"))
    id_type = picked.schema["doc_id"].dataType.simpleString()
    p, s, m = (x.encode() for x in sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, 1):
                offsets, data = text_buffer(batch.column(1))
                units = Decomposition(offsets, data, unit, chunk)
                n, forms = units.n_units, np.array(batch.column(4).to_pylist(), object)
                h1, h2 = (batch.column(k).to_numpy() % (n + 1) for k in (2, 3))
                low, high = np.minimum(h1, h2), np.maximum(h1, h2)
                moved = np.flatnonzero(forms != "plain")
                first, second = units.cuts(moved, low[moved]), units.cuts(moved, high[moved])
                out = [None] * batch.num_rows
                for i, a, b in zip(moved.tolist(), first.tolist(), second.tolist()):
                    prefix, middle, suffix = data[offsets[i] : a].tobytes(), data[a:b].tobytes(), data[b : offsets[i + 1]].tobytes()
                    out[i] = b"".join((p, prefix, s, suffix, m, middle) if forms[i] == "psm" else (s, suffix, p, prefix, m, middle))
                cut = forms == "plain"
                output = pa.array(out, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0), "n": pa.array(n, pa.int64()), "form": batch.column(4),
                    "prefix_units": pa.array(low, pa.int64(), mask=cut), "middle_units": pa.array(high - low, pa.int64(), mask=cut),
                    "output": pc.coalesce(output, batch.column(1)),
                })

    return picked.mapInArrow(run, f"doc_id {id_type}, n long, form string, prefix_units long, middle_units long, output string")


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text as it was, from an output and its form; built-in functions only."""
    p, s, m = sentinels

    def quoted(*marks: str) -> str:
        return "|".join(f"\\Q{x}\\E" for x in marks)

    psm = F.split(F.substring(output, len(p) + 1, 2**31 - 1), quoted(s, m), -1)
    spm = F.split(F.substring(output, len(s) + 1, 2**31 - 1), quoted(p, m), -1)
    return F.when(form == "psm", F.concat(psm[0], psm[2], psm[1])).when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output)
