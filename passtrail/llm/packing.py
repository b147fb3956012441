"""Sum-of-squares online packing of token sequences into windows of a fixed size.

Each scan partition packs its own documents as they come, so no text and no id is shuffled. What is left of a document after
its full windows goes into the fill level that makes the sum of squared level counts smallest; ``Levels`` holds the counts in an
array. When a partition ends (or holds too many partial windows), the emptiest windows are cut up to fill the fullest, and the
last rest is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passtrail.llm import common, vocab

PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint,"
    " ids binary"
)
_TYPES = [pa.int64()] * 7 + [pa.binary()]
_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_SHIFT = 36


class Levels:
    """Partial windows by fill, and the choice of one."""

    def __init__(self, size: int):
        self.size, self.open = size, 0
        self.windows: list[list] = [[] for _ in range(size + 1)]
        #: What leaving a level, or reaching one, adds to the sum of squares. A new window leaves nothing.
        self.leave = np.full(size + 1, np.inf)
        self.leave[0] = 0.0
        self.reach = np.ones(size + 1)
        self.reach[size] = 0.0

    def _count(self, level: int) -> None:
        if 0 < level < self.size:
            n = len(self.windows[level])
            self.leave[level] = 1.0 - 2.0 * n if n else np.inf
            self.reach[level] = 2.0 * n + 1.0

    def place(self, length: int, piece: tuple) -> list | None:
        """Put a piece into a window; the window's pieces if it is full now. Of equal choices the fullest level is taken."""
        costs = (self.leave[: self.size - length + 1] + self.reach[length:])[::-1]
        level = self.size - length - int(np.argmin(costs))
        window = self.windows[level].pop() if level else []
        window.append(piece)
        self._count(level)
        self.open += not level
        if level + length == self.size:
            self.open -= 1
            return window
        self.windows[level + length].append(window)
        self._count(level + length)
        return None

    def settled(self) -> Iterator[list]:
        """All partial windows, merged by cutting; ends with none open."""
        rest = deque(w for level in range(self.size - 1, 0, -1) for w in self.windows[level])
        self.__init__(self.size)
        while rest:
            window = rest.popleft()
            free = self.size - sum(p[1] for p in window)
            while free and rest:
                last = rest[-1]
                head, tail = cut(last.pop(), free)
                window.append(tail)
                free -= tail[1]
                if head:
                    last.append(head)
                if not last:
                    rest.pop()
            yield from [window] if not free else powers(window)


def cut(piece: tuple, most: int) -> tuple[tuple | None, tuple]:
    """A piece as what stays and its end of at most ``most`` ids."""
    doc, length, start, total, ids = piece
    if length <= most:
        return None, piece
    stay = length - most
    at = stay * (len(ids) // length)
    return (doc, stay, start, total, ids[:at]), (doc, most, start + stay, total, ids[at:])


def powers(window: list) -> Iterator[list]:
    """Cut a window's pieces into sequences whose lengths are powers of two."""
    left = deque(window)
    total = sum(p[1] for p in window)
    while total:
        want = 1 << (total.bit_length() - 1)
        total -= want
        out = []
        while want:
            doc, length, start, doc_tokens, ids = left.popleft()
            take = min(want, length)
            at = take * (len(ids) // length)
            out.append((doc, take, start, doc_tokens, ids[:at]))
            if take < length:
                left.appendleft((doc, length - take, start + take, doc_tokens, ids[at:]))
            want -= take
        yield out


def packed(parts: Iterator[pa.RecordBatch], path: str, size: int, end: int, most_open: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    words = vocab.words(path, True)
    closing = np.array([end], np.uint32).tobytes()
    levels = Levels(size)
    sequence = TaskContext.get().partitionId() << _SHIFT
    rows: list[tuple] = []

    def emit(window: list) -> None:
        nonlocal sequence
        offset = 0
        for doc, length, start, total, ids in window:
            rows.append((doc, start, length, zlib.crc32(ids), total, sequence, offset, ids if with_ids else None))
            offset += length
        sequence += 1

    def batch() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(_NAMES)
        rows.clear()
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)

    for part in common.batches(parts):
        for doc, text in zip(part.column(0).to_pylist(), common.octets(part.column(1))):
            ids = words.of_bytes(text) + closing
            total = len(ids) // 4
            whole = total - total % size
            for start in range(0, whole, size):
                emit([(doc, size, start, total, ids[start * 4 : (start + size) * 4])])
            if whole < total:
                full = levels.place(total - whole, (doc, total - whole, whole, total, ids[whole * 4 :]))
                if full:
                    emit(full)
            if levels.open > most_open:
                for window in levels.settled():
                    emit(window)
            if len(rows) >= 10_000:
                yield batch()
    for window in levels.settled():
        emit(window)
    yield batch()


def pack(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", size: int = 2048, end: int = 1,
    most_open: int = 8192, with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` ids.

    A document is the ids of its whole text, without special tokens, and then ``end``. Each id is in exactly one piece: ``start``
    ids of its document come before it, ``offset`` ids of its sequence. Sequences are full, or their length is a power of two, so
    none needs padding. ``ids`` are little-endian unsigned 32-bit integers.

    A null or empty text is its end id alone. Rows that repeat an id are documents of their own. Other columns are not looked
    at. An empty table gives no pieces. Sequence numbers are unique but not consecutive: the partition number comes first. They
    follow from the partitioning of ``docs``, as does the packing.
    """
    mine = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"))
    pieces = mine.mapInArrow(lambda parts: packed(parts, tokenizer_path, size, end, most_open, with_ids), PIECES)
    pieces = pieces if with_ids else pieces.drop("ids")
    return pieces.withColumnRenamed("doc_id", id_column)
