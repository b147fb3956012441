"""The span scan over Arrow batches: outermost function spans of many texts at once.

Braces, line ends and markers are found over the bytes of a whole batch; only lines that hold a brace or a marker are stepped over.
This replaces a fold in the row, whose every step is interpreted; lines, signatures and bodies stay columns.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passtrail.functions import ir

SLICE_BYTES = 1 << 20
SPANS = "array<struct<start:int,end:int>>"
_KIND = pa.struct([("start", pa.int32()), ("end", pa.int32())])
# Single bytes that end a line, and the bytes before the last one of those characters that take several.
_BREAKS = np.isin(np.arange(256), [0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E])


def _places(data: np.ndarray, word: bytes) -> np.ndarray:
    """Where a word begins."""
    at = np.flatnonzero(data[: max(0, len(data) - len(word) + 1)] == word[0])
    for k, byte in enumerate(word[1:], 1):
        at = at[data[at + k] == byte]
    return at


def _line_ends(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The last byte of each line end; a carriage return before a line feed of the same text is no end of its own."""
    ends = np.flatnonzero(_BREAKS[data])
    follows = ends[(data[ends] == 0x0D) & (ends + 1 < len(data))]
    follows = follows[data[follows + 1] == 0x0A]
    ends = np.setdiff1d(ends, follows[~np.isin(follows + 1, begins)], assume_unique=True)
    wide = [_places(data, c.encode()) + len(c.encode()) - 1 for c in "\x85  "]
    return np.sort(np.concatenate([ends, *wide]))


def _inside(at: np.ndarray, begins: np.ndarray, width: int) -> np.ndarray:
    """Places whose word does not run over the end of its text."""
    return at[np.searchsorted(begins, at, side="right") == np.searchsorted(begins, at + width - 1, side="right")]


class Lines:
    """The lines of some texts that hold a brace or a marker: text, number, brace delta, marker; and each text's number of lines."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"".join(texts), np.uint8)
        limits = np.cumsum([0, *map(len, texts)])
        begins = limits[:-1][np.diff(limits) > 0]
        ends = _line_ends(data, begins)
        before = np.searchsorted(ends, limits)  # line ends before each text
        braces = np.flatnonzero((data == 0x7B) | (data == 0x7D))
        marks = np.concatenate([_inside(_places(data, m.encode()), begins, len(m)) for m in ir.FUNCTION_MARKERS])
        at = np.concatenate([braces, marks])
        change = np.concatenate([np.where(data[braces] == 0x7B, 1, -1), np.zeros(len(marks), np.int64)])
        # Lines are numbered over the whole batch, with one more at each text, as a text need not end its last line.
        owner = np.searchsorted(limits, at, side="right") - 1
        line, group = np.unique(np.searchsorted(ends, at) + owner, return_inverse=True)
        self.delta = np.bincount(group, change, len(line)).astype(np.int64)
        self.marked = np.bincount(group[len(braces) :], minlength=len(line)) > 0
        self.text = np.zeros(len(line), np.int64)
        self.text[group] = owner
        self.number = line - self.text - before[self.text]
        # A text that ends with a line end has no further line, and an empty one has none at all.
        finished = np.append(ends, -1)[np.maximum(before[1:] - 1, 0)] == limits[1:] - 1
        self.count = np.diff(before) + (~finished & (np.diff(limits) > 0))

    def __iter__(self) -> Iterator[tuple[int, int, int, bool]]:
        return zip(self.text.tolist(), self.number.tolist(), self.delta.tolist(), self.marked.tolist())


def spans_of(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """(first line, last line) of the outermost functions of each text; one that is never closed ends with the text."""
    lines = Lines(texts)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    text, start, depth = -1, -1, 0
    for t, n, d, f in lines:
        if t != text:
            if start >= 0:
                out[text].append((start, int(lines.count[text]) - 1))
            text, start = t, -1
        if start < 0:
            if not f:
                continue
            start, depth = n, 0
        depth += d
        if depth <= 0:
            out[t].append((start, n))
            start = -1
    if start >= 0:
        out[text].append((start, int(lines.count[text]) - 1))
    return out


def slices(texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """A batch's texts as slices of about ``most_bytes`` or one text, null as empty: what a scan needs beside a text is many times as much."""
    at = 0
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most_bytes, side="right")))
        yield [t or b"" for t in texts.slice(at, stop - at).cast(pa.binary()).to_pylist()]
        at = stop


def give_back() -> None:
    """Return freed memory to the system: a worker process stays when its task is done, for tasks of other kinds."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # the C library of Linux
        trim(0)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let the session hand texts to Python in batches of so many rows; the default of ten times as many is made for narrow rows.

    Both sides hold whole batches outside the heap, so this bounds what a task needs there. A smaller setting stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def _arrays(texts: pa.Array) -> pa.Array:
    counts, parts = [0], [np.zeros((0, 2), np.int32)]
    for part in slices(texts):
        found = spans_of(part)
        counts += map(len, found)
        parts.append(np.array([s for spans in found for s in spans], np.int32).reshape(-1, 2))
    sizes, flat = np.cumsum(counts), np.concatenate(parts)
    give_back()
    items = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(_KIND))
    missing = np.append(texts.is_null().to_numpy(zero_copy_only=False), False)
    return pa.ListArray.from_arrays(pa.array(sizes.astype(np.int32), mask=missing if texts.null_count else None), items)


def span_column(text: Column) -> Column:
    """Outermost function spans of a text as (start, end) line numbers; null for null. It cannot be used inside a lambda."""

    @F.arrow_udf(SPANS)
    def scanned(texts: pa.Array) -> pa.Array:
        return _arrays(texts)

    return scanned(text)


def with_spans(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with the spans of their texts. A batch holds 1,000 texts, and 64 MB of them by Spark's default, or one text."""
    small_batches(rows.sparkSession)
    return rows.withColumn(out, span_column(F.col(text)))
