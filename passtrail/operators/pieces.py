"""Texts that come as ordered pieces, folded one after the other: size, lines, hash and a bounded beginning, never a whole text.

SHA-256 has to see a text in order, so a text is folded by one task; but that task holds a digest, not the text. Pieces are sorted on the
way to it, and one task folds many texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: How the end of a text is treated. Snapshot bodies lose their trailing white space and end with one line feed; streams that
#: were put together from records lose the line feed that was added to the last one.
WHOLE, BODY, RECORDS = "whole", "body", "records"


class _Fold:
    """The state of one text: what is sure to belong to it, and what does only if more follows."""

    def __init__(self, end: str, cap_bytes: int | None):
        self.end, self.cap_bytes = end, cap_bytes
        self.sure, self.sure_bytes, self.sure_lines = hashlib.sha256(), 0, 0
        self.ahead, self.ahead_bytes, self.ahead_lines = hashlib.sha256(), 0, 0
        self.head = bytearray()

    def add(self, text: str) -> None:
        if self.end == BODY:
            solid = text.rstrip()
        elif self.end == RECORDS:
            solid = text.removesuffix("\n")
        else:
            solid = text
        data = text.encode()
        # Three bytes more than the cap show whether the cut would be inside a character.
        if self.cap_bytes is None or len(self.head) <= self.cap_bytes + 3:
            self.head += data if self.cap_bytes is None else data[: self.cap_bytes + 4 - len(self.head)]
        if solid or self.end != BODY:
            certain = solid.encode()
            self.ahead.update(certain)
            self.sure, self.sure_bytes = self.ahead.copy(), self.ahead_bytes + len(certain)
            self.sure_lines = self.ahead_lines + solid.count("\n")
            tail = data[len(certain) :]
        else:
            tail = data
        self.ahead.update(tail)
        self.ahead_bytes += len(data)
        self.ahead_lines += text.count("\n")

    def finish(self) -> tuple[int, int, str, bytes, bool]:
        """Bytes, lines, hash, the text up to the cap, and whether it was cut."""
        digest, size, lines, head = self.sure.copy(), self.sure_bytes, self.sure_lines, bytes(self.head[: self.sure_bytes])
        if self.end == BODY:
            digest.update(b"\n")
            size, lines, head = size + 1, lines + 1, head + b"\n" if len(head) == size else head
        cut = self.cap_bytes is not None and size > self.cap_bytes
        if cut:
            at = self.cap_bytes
            while at > 0 and at < len(head) and head[at] & 0xC0 == 0x80:
                at -= 1
            head = head[:at]
        return size, lines, digest.hexdigest(), head, cut


def fold_pieces(
    pieces: DataFrame, keys: Sequence[str], order: Sequence[str], text: str = "text", end: str = WHOLE, cap_bytes: int | None = 0,
    first: Sequence[str] = (),
) -> DataFrame:
    """One row per key: keys, the ``first`` columns of its first piece, ``bytes``, ``lines``, ``sha256``, ``head`` and ``cut``.

    ``head`` is the text up to ``cap_bytes`` bytes, never cutting a character, and ``cut`` tells whether there is more; without a cap it is
    the whole text. A null piece is empty. Pieces that are equal in ``keys`` and ``order`` come in no certain order. The pieces are
    shuffled once.
    """
    keys, order, first = list(keys), list(order), list(first)
    carried = [*keys, *first]
    rows = pieces.select(*carried, *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order)], F.col(text).alias("_text"))
    sorted_rows = rows.repartition(*keys).sortWithinPartitions(*keys, *[f"_o{k}" for k in range(len(order))]).select(*carried, "_text")
    found = [("bytes", T.LongType()), ("lines", T.IntegerType()), ("sha256", T.StringType()), ("head", T.BinaryType()), ("cut", T.BooleanType())]
    schema = T.StructType([*sorted_rows.schema.fields[:-1], *[T.StructField(n, t) for n, t in found]])

    def of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, head = None, None, None
        done: list[tuple[pa.RecordBatch, tuple]] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*[values for _, values in done]))
            kinds = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.bool_()]
            carried_rows = pa.Table.from_batches([row for row, _ in done]).combine_chunks().to_batches()[0]
            return pa.record_batch([*carried_rows.columns, *[pa.array(c, k) for c, k in zip(columns, kinds)]], names=schema.names)

        held = 0
        for part in parts:
            values = list(zip(*[part.column(c).to_pylist() for c in keys]))
            for k, (here, text) in enumerate(zip(values, part.column("_text").to_pylist())):
                if state is None or here != key:
                    if state is not None:
                        done.append((head, state.finish()))
                        held += len(done[-1][1][3])
                        if len(done) >= 1000 or held > 16 << 20:
                            yield out()
                            done, held = [], 0
                    key, state, head = here, _Fold(end, cap_bytes), part.slice(k, 1).select(carried)
                state.add(text or "")
        if state is not None:
            done.append((head, state.finish()))
            yield out()

    folded = sorted_rows.mapInArrow(of, schema)
    return folded.withColumn("head", F.col("head").cast("string"))
